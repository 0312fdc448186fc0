"""Licence scans: base phrases, notices of the method, odd documents."""

import pytest
from brute import edge_docs, item_words

from caseflow.llm import licences

MIT = licences.NOTICES[[t.label for t in licences.NOTICES].index("mit")].text
FILLER = "void main of the file and other things that are no licence at all"


def scanned(spark, texts, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r.row.doc_id: r for r in licences.scan(docs, **more).collect()}


def base_places(text):
    words = item_words(text)
    return sorted(
        (at, t.label)
        for t in licences.BASE
        for at in range(len(words))
        if words[at : at + len(t.text.split())] == t.text.split()
    )


def test_base_phrases_against_brute_force(spark):
    texts = [
        "Under the MIT License, or the mit-license. MIT\nLICENSE",
        "cc by by cc cc by/cc by",
        "gnu gnu general public license license; apache license, general public license",
        "mit licenses, smit license, mit licénse, mit. license",
        "Apache\x7flicense Apache_License apache0license",
        "cc by " * 300 + "apache license " * 200,
        "gnu general public",
        FILLER,
    ]
    for i, r in scanned(spark, texts).items():
        places = base_places(texts[i])
        assert r.n_words == len(item_words(texts[i]))
        assert r.n_base == len(places), texts[i]
        starts = [at for at, _ in places]
        assert (r.first_word, r.last_word) == ((starts[0], starts[-1]) if starts else (None, None))
        assert r.base_labels == sorted({label for _, label in places})
        assert set(r.base_labels) <= set(r.labels)
        assert (r.score > 0) == bool(r.labels) and 0 <= r.score <= 1


def test_notices_are_found_by_their_rare_words(spark):
    cut = MIT.split()
    texts = [
        f"{FILLER} {MIT.upper()} {FILLER}",
        " ".join([*cut[:20], "new", "words", *cut[20:]]),  # a phrase two words off its place
        " ".join([*cut[:20], "new", "words", "three", *cut[20:]]),  # too far off
        MIT.replace("without restriction", "without limit"),  # a mandatory phrase is missing
        " ".join(reversed(cut)) + " permission is hereby granted free of charge without restriction",
        f"{MIT} {FILLER} Licensed under the Apache License, Version 2.0.",
        "Licensed under CC BY-NC 4.0.",
        "the GNU General Public License, see over there; version 3",
    ]
    found = scanned(spark, texts)
    labels = [found[i].labels for i in range(len(texts))]
    assert labels[0] == ["mit"] and found[0].score == 1.0
    assert labels[1] == ["mit"] and found[1].score < 1.0
    assert labels[2] == labels[3] == labels[4] == []
    assert labels[5] == ["apache", "apache-2.0", "mit"]
    assert labels[6] == ["cc-by", "cc-by-nc-4.0"]
    assert labels[7] == ["gpl"]
    assert [found[i].base_labels for i in (0, 1, 5, 6, 7)] == [[], [], ["apache"], ["cc-by"], ["gpl"]]


def test_only_a_to_z_are_lowered(spark):
    word = licences.Template("work", "work here", ("work here",), True)
    found = scanned(spark, ["WORK HERE", "worK here", "wor\u212a here"], templates=[word])
    assert [found[i].n_base for i in range(3)] == [1, 1, 0]
    assert [found[i].n_words for i in range(3)] == [2, 2, 2]


def test_odd_documents(spark):
    docs = edge_docs(spark, [(11, "mit license", "a"), (11, "mit license", "a"), (None, "cc by", None)])
    rows = licences.scan(docs).collect()
    assert len(rows) == docs.count()
    assert [f for f in rows[0].row.asDict()] == docs.columns
    by_text = {}
    for r in rows:
        by_text.setdefault(r.row.text, []).append((r.n_words, r.n_base, tuple(r.labels)))
    for text, results in by_text.items():
        assert len(set(results)) == 1 and results[0][0] == len(item_words(text))
    assert by_text["mit license"] == [(2, 1, ("mit",))] * 2
    assert by_text["cc by"] == [(2, 1, ("cc-by",))]
    assert licences.scan(docs.limit(0)).collect() == []


def test_very_long_text_with_a_frequent_phrase(spark):
    text = "mit license x " * 60_000
    r = scanned(spark, [text])[0]
    assert (r.n_base, r.first_word, r.last_word) == (60_000, 0, 3 * 59_999)


@pytest.mark.parametrize("keep", [None, ["doc_id"]])
def test_kept_columns(spark, keep):
    assert scanned(spark, ["x"], keep=keep)[0].row.asDict().keys() == ({"doc_id", "text"} if keep is None else {"doc_id"})
