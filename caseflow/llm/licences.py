"""Licence scans: a positional index of template words, looked up by each file's rarest ones.

A licence is known by templates (a notice and the phrases it must contain). The documents' licence
words are stored once with their positions; document frequencies over the whole corpus rank the
words. Of every template, a file looks up the words it has that are rarest in the corpus; their
postings vote for the place where the template would begin (position in the file less position in
the template). A place on which most of the looked-up postings agree is a candidate, and stands if
every mandatory phrase is found, word by word, where the template has it. DataFrame functions only.

The four base phrases are templates of their own: one looked-up word, the phrase mandatory.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm.common import settle

RARE = 6  # words that a file looks up of one template
SLACK = 2  # words by which a mandatory phrase may stand off its place
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KELVIN = "\u212a"  # the one code point beyond ASCII whose lower case is an ASCII letter
NO_LETTER = "\ufffd"


class Template(NamedTuple):
    """A licence notice: its label, its words, the phrases that must be there."""

    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False


# The phrases and labels of the contract.
BASE = [
    Template("gpl", "gnu general public license", ("gnu general public license",), True),
    Template("apache", "apache license", ("apache license",), True),
    Template("cc-by", "cc by", ("cc by",), True),
    Template("mit", "mit license", ("mit license",), True),
]

# The words of public licence notices, lower-cased, and their short names.
NOTICES = [
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0",
        ("apache license version 2 0",),
    ),
    Template(
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer redistributions in binary form must reproduce "
        "the above copyright notice this list of conditions and the following disclaimer",
        ("redistributions of source code must retain", "redistributions in binary form must reproduce"),
    ),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template(
        "cc-by-4.0",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0 international",),
    ),
    Template(
        "gpl-2.0",
        "licensed under the gnu general public license version 2",
        ("gnu general public license", "version 2"),
    ),
    Template(
        "gpl-3.0",
        "licensed under the gnu general public license version 3",
        ("gnu general public license", "version 3"),
    ),
    Template(
        "gpl-3.0-or-later",
        "redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your "
        "option any later version",
        ("gnu general public license", "free software foundation", "either version 3"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies",
        ("for any purpose with or without fee", "appear in all copies"),
    ),
    Template(
        "lgpl",
        "under the terms of the gnu lesser general public license as published by the free "
        "software foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
]
TEMPLATES = [*BASE, *NOTICES]


def _words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased, in order."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit(NO_LETTER)))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def template_words(text: str) -> list[str]:
    """The words of a template, as those of a document; none holds a quote or a blank."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in re.split(BETWEEN, lowered) if w]


def _offset(words: list[str], phrase: tuple[str, ...]) -> int:
    """Where a phrase first stands in its template."""
    return next(i for i in range(len(words)) if tuple(words[i : i + len(phrase)]) == phrase)


def _known(rows: list[tuple], fields: str) -> Column:
    """What the templates say, as one literal array of structs."""
    names = [field.split(":")[0] for field in fields.split(", ")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    return F.from_json(F.lit(text), f"array<struct<{fields}>>")


def _rows(spark: SparkSession, rows: list[tuple], fields: str) -> DataFrame:
    """The same as a frame of one partition, as small as the templates."""
    return spark.range(0, 1, 1, 1).select(F.inline(_known(rows, fields)))


def _have(words: Column) -> Column:
    """How many of the words the file has."""
    return F.size(F.array_intersect(words, F.col("has")))


def scan(
    docs: DataFrame,
    templates: list[Template] = TEMPLATES,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``row`` (the input row, or its columns ``keep``), ``n_words``,
    ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` (sorted arrays),
    ``score``.

    ``n_base`` counts the places of base phrases, ``first_word`` and ``last_word`` are the smallest
    and the largest of them (words from 0), null without any. ``score`` is the best share of
    looked-up postings that agree on the place of a template that stands, 0 without one. A null
    text is empty, an empty text has no words, labels or score. Texts are scanned whole; equal
    rows are judged alike and all kept. Ties in rarity go by the word. An empty table gives no rows.
    """
    spark = docs.sparkSession
    lists = [template_words(template.text) for template in templates]
    musts = [sorted({tuple(template_words(p)) for p in template.phrases}) for template in templates]
    phrases = sorted({p for must in musts for p in must})
    vocabulary = sorted({w for words in [*lists, *phrases] for w in words})

    found = docs.select(
        F.struct(*(keep or ["*"])).alias("row"), _words_of(docs[text].cast("string")).alias("_words")
    ).select(
        "row",
        F.size("_words").cast("long").alias("n_words"),
        F.filter(
            F.transform("_words", lambda w, at: F.struct(w.alias("word"), at.alias("at"))),
            lambda h: h["word"].isin(vocabulary),
        ).alias("hits"),
    )
    stored = settle(found.withColumn("uid", F.monotonically_increasing_id()), "licence-words")

    # Document frequencies over all documents; one row per licence word reaches the driver.
    seen = stored.select(F.explode(F.array_distinct("hits.word")).alias("word"))
    counts = {r.word: r.n for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}
    rarest_first = [sorted(set(words), key=lambda w: (counts.get(w, 0), w)) for words in lists]

    some = stored.filter(F.size("hits") > 0).select(
        "uid", "hits", F.array_distinct("hits.word").alias("has")
    )
    of_template = _known(
        [
            (t, words, rare, sorted({w for p in must for w in p}), 1 if own.base else min(RARE, len(rare)))
            for t, (own, words, rare, must) in enumerate(
                zip(templates, lists, rarest_first, musts, strict=True)
            )
        ],
        "template:int, words:array<string>, rare:array<string>, must:array<string>, need:int",
    )
    able = F.filter(
        of_template,
        lambda t: (_have(t["must"]) == F.size(t["must"])) & (_have(t["rare"]) >= t["need"]),
    )
    lookups = some.select("uid", "hits", "has", F.explode(able).alias("t")).select(
        "uid",
        "hits",
        "t",
        F.slice(F.array_intersect("t.rare", "has"), 1, F.col("t.need")).alias("chosen"),
    )
    votes = (
        lookups.select(
            "uid",
            "t.template",
            F.size(F.filter("t.words", lambda w: F.array_contains("chosen", w))).alias("total"),
            F.inline(F.filter("hits", lambda h: F.array_contains("chosen", h["word"]))),
        )
        .join(
            _rows(
                spark,
                [(t, w, n) for t, words in enumerate(lists) for n, w in enumerate(words)],
                "template:int, word:string, offset:int",
            ),
            ["template", "word"],
        )
        .groupBy("uid", "template", "total", (F.col("at") - F.col("offset")).alias("start"))
        .agg(F.count("*").alias("agree"))
        .filter(F.col("agree") * 2 >= F.col("total"))
    )

    # Places of the mandatory phrases: all their words agree on one start.
    of_phrase = _known(
        [(p, sorted(set(words)), len(words)) for p, words in enumerate(phrases)],
        "phrase:int, words:array<string>, size:int",
    )
    said = F.filter(of_phrase, lambda p: _have(p["words"]) == F.size(p["words"]))
    places = (
        some.select("uid", "hits", "has", F.explode(said).alias("p"))
        .select(
            "uid",
            "p.phrase",
            "p.size",
            F.inline(F.filter("hits", lambda h: F.array_contains("p.words", h["word"]))),
        )
        .join(
            _rows(
                spark,
                [(p, w, n) for p, words in enumerate(phrases) for n, w in enumerate(words)],
                "phrase:int, word:string, offset:int",
            ),
            ["phrase", "word"],
        )
        .groupBy("uid", "phrase", "size", (F.col("at") - F.col("offset")).alias("place"))
        .agg(F.count("*").alias("n"))
        .filter("n = size")
        .select("uid", "phrase", "place")
    )

    # Where a template asks for its phrases: a place within the slack will do.
    asked = _rows(
        spark,
        [
            (t, phrases.index(p), _offset(lists[t], p), 0 if templates[t].base else SLACK, len(must),
             templates[t].label, templates[t].base)
            for t, must in enumerate(musts)
            for p in must
        ],
        "template:int, phrase:int, offset:int, slack:int, must:int, label:string, base:boolean",
    )
    near = F.expr("sequence(start + offset - slack, start + offset + slack)")
    stands = (
        votes.join(asked, "template")
        .withColumn("place", F.explode(near))
        .join(places, ["uid", "phrase", "place"])
        .groupBy("uid", "template", "label", "base", "must", "start", "agree", "total")
        .agg(F.count_distinct("phrase").alias("there"))
        .filter("there = must")
    )
    base_start = F.when(F.col("base"), F.col("start")).cast("long")
    verdicts = stands.groupBy("uid").agg(
        F.count(base_start).alias("n_base"),
        F.min(base_start).alias("first_word"),
        F.max(base_start).alias("last_word"),
        # As many labels as there are templates at most.
        F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"),
        F.max(F.col("agree") / F.col("total")).alias("score"),
    )
    none = F.array().cast("array<string>")
    return (
        stored.select("uid", "row", "n_words")
        .join(verdicts, "uid", "left")
        .select(
            "row",
            "n_words",
            F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
            "first_word",
            "last_word",
            F.coalesce("base_labels", none).alias("base_labels"),
            F.coalesce("labels", none).alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )
