"""Substring deduplication: winnowed anchors, join, extension both ways, maximal repeats.

A repeat is a run of ``WINDOW`` words or more that also stands in a document with a smaller id.
Winnowing picks an anchor of ``ANCHOR`` words in every window by its content alone, so equal windows
pick equal anchors. The windows of an anchor are neighbours and form a block: the widest context to
either side in which the anchor is the one picked.

1. Seed: documents that share an anchor. Anchors of one document only are dropped.
2. Extend: blocks of shared anchors that are equal over their whole extent repeat the smallest
   document of their class as a whole. Only that document's own blocks can hold windows repeated
   elsewhere; one row per class, not per occurrence, is compared window by window with the other
   classes of the anchor: where the extension ends between two words.
3. Keep: the windows found are merged into maximal runs of covered words.

Occurrences never meet in pairs: classes carry their smallest document, which is pre-aggregated,
and joins with them may split a hot anchor's rows. Hashes are 64 bits each for anchor and window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import (
    NOT_WHITE,
    as_long,
    chunks,
    find_words,
    gram_hashes,
    settle,
    word_hashes,
)

WINDOW = 13
ANCHOR = 5
# Packed removals: word position in the upper bits, one bit per window of the block below.
MASK_BITS = 16


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` values the position of its first smallest one."""

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] < values[a], b, a)

    best, span = np.arange(len(values)), 1
    while span * 2 <= width:
        best = better(best[:-span], best[span:])
        span *= 2
    return better(best[: len(best) - (width - span)], best[width - span :])


def blocks(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, ...]:
    """Row, first word, anchor hash and bounds in the list of window hashes of every block."""
    words = find_words(batch.column(text), NOT_WHITE)
    hashes = word_hashes(words)
    nothing = np.empty(0, np.int64)
    if len(hashes) < WINDOW:
        return nothing, nothing, nothing, np.zeros(1, np.int64), nothing
    grams = gram_hashes(hashes, ANCHOR)
    picked = leftmost_least(grams, WINDOW - ANCHOR + 1)
    row = np.repeat(np.arange(batch.num_rows), np.diff(words.first))
    starts = np.flatnonzero(row[: len(picked)] == row[WINDOW - 1 :])
    picked = picked[starts]
    new = np.flatnonzero(np.diff(picked, prepend=-1))
    first = starts[new]
    return (
        row[first],
        first - words.first[row[first]],
        as_long(grams[picked[new]]),
        np.append(new, len(starts)),
        as_long(gram_hashes(hashes, WINDOW)[starts]),
    )


def _anchors(source: DataFrame) -> DataFrame:
    """``anchor, _id, _key, lo`` of every block."""
    fields = source.schema
    anchor, lo = T.StructField("anchor", T.LongType()), T.StructField("lo", T.LongType())
    schema = T.StructType([anchor, fields["_id"], fields["_key"], lo])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            row, lo, anchor, _, _ = blocks(batch, "_text")
            ids, keys = batch.column("_id").take(pa.array(row)), batch.column("_key").take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), ids, keys, pa.array(lo)], ["anchor", "_id", "_key", "lo"]
            )

    return source.mapInArrow(find, schema)


def _contexts(source: DataFrame) -> DataFrame:
    """The blocks that start at the words ``shared``, with the hashes of their windows."""
    fields = source.schema
    schema = T.StructType(
        [
            T.StructField("anchor", T.LongType()),
            T.StructField("windows", T.ArrayType(T.LongType())),
            fields["_id"],
            fields["_key"],
            T.StructField("lo", T.LongType()),
        ]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            row, lo, anchor, bounds, hashes = blocks(batch, "_text")
            shared = batch.column("shared")
            wanted = np.unique(
                np.repeat(np.arange(batch.num_rows), pc.list_value_length(shared).to_numpy()) << 32
                | pc.list_flatten(shared).to_numpy()
            )
            keep = np.flatnonzero(np.isin(row << 32 | lo, wanted))
            sizes = np.diff(bounds)
            inside = np.isin(np.repeat(np.arange(len(sizes)), sizes), keep)
            offsets = np.concatenate(([0], np.cumsum(sizes[keep]))).astype(np.int32)
            windows = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[inside]))
            rows = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor[keep]),
                    windows,
                    batch.column("_id").take(rows),
                    batch.column("_key").take(rows),
                    pa.array(lo[keep]),
                ],
                schema.names,
            )

    return source.mapInArrow(find, schema)


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``_id, _key, removed``: for each document with repeats its packed windows to remove.

    ``_key`` is the text's hash, so rows that share an id but not a text stay apart.
    """
    source = docs.select(
        docs[doc_id].alias("_id"),
        docs[text].cast("string").alias("_text"),
        F.xxhash64(docs[text].cast("string")).alias("_key"),
    ).filter("_id is not null")
    found = _anchors(source)
    # Written, so that the join deals both sides anew and may split the rows of a hot anchor.
    shared = settle(
        found.groupBy("anchor")
        .agg(F.min("_id").alias("least"), F.max("_id").alias("most"))
        .filter("least < most")
        .select("anchor"),
        "anchors",
    )
    seeds = settle(
        found.join(shared, "anchor", "left_semi")
        .groupBy("_id", "_key")
        .agg(F.collect_set("lo").alias("shared")),
        "seeds",
    )
    occurrences = settle(
        _contexts(source.join(seeds, ["_id", "_key"])).withColumns(
            {"context": F.xxhash64("windows"), "size": F.size("windows")}
        ),
        "contexts",
    )
    classes = settle(
        occurrences.groupBy("anchor", "context", "windows").agg(F.min("_id").alias("least")),
        "classes",
    )
    # Classes that may share windows with another one of their anchor.
    several = classes.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    contested = settle(
        classes.join(several, "anchor", "left_semi").withColumn(
            "class", F.monotonically_increasing_id()
        ),
        "contested",
    )
    each = contested.select(
        "class", "anchor", "least", F.posexplode("windows").alias("at", "window")
    )
    across = settle(
        each.groupBy("anchor", "window")
        .agg(F.min("least").alias("before"), F.max("least").alias("most"))
        .filter("before < most")
        .drop("most"),
        "windows",
    )
    parts = (
        each.join(across, ["anchor", "window"])
        .filter("before < least")
        .groupBy("class")
        .agg(F.bit_or(F.expr("shiftleft(1, at)")).alias("part"))
    )
    shared_parts = contested.select("anchor", "context", "class").join(parts, "class").drop("class")
    # From here on a class is known by the hashes of its anchor and of its windows.
    named = settle(
        classes.drop("windows").join(shared_parts, ["anchor", "context"], "left"), "named"
    )
    whole = F.expr("shiftleft(1, size) - 1")
    hits = (
        occurrences.drop("windows")
        .join(named, ["anchor", "context"])
        .withColumn("mask", F.when(F.col("_id") > F.col("least"), whole).otherwise(F.col("part")))
        .filter("mask is not null")
    )
    packed = F.shiftleft("lo", MASK_BITS).bitwiseOR(F.col("mask").cast("long"))
    return settle(
        hits.groupBy("_id", "_key").agg(F.collect_set(packed).alias("removed")), "repeats"
    )


def covered(n_words: int, removed: np.ndarray) -> np.ndarray:
    """True for every word inside one of the packed windows."""
    change = np.zeros(n_words + 1, np.int32)
    lo, mask = removed >> MASK_BITS, removed & ((1 << MASK_BITS) - 1)
    for at in range(WINDOW - ANCHOR + 1):
        start = lo[mask >> at & 1 == 1] + at
        np.add.at(change, start, 1)
        np.add.at(change, start + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None
) -> DataFrame:
    """One row per document: ``row`` (the input row, or its columns ``keep``), ``n_words``,
    ``n_removed``, ``kept``.

    ``kept`` holds the words that no repeat covers, joined by one space. Windows are judged on the
    input. A null or empty text has no words and keeps the empty text; a text shorter than a window
    is kept; a row with a null id neither removes nor loses anything; rows with equal ids do not
    remove each other. Rows are never dropped; an empty table gives no rows.
    """
    rows = docs.select(
        F.struct(*(keep or ["*"])).alias("row"),
        docs[doc_id].alias("_id"),
        docs[text].cast("string").alias("_text"),
        F.xxhash64(docs[text].cast("string")).alias("_key"),
    )
    joined = rows.join(repeats(docs, text, doc_id), ["_id", "_key"], "left").select(
        "row", "_text", "removed"
    )
    schema = T.StructType(
        [
            joined.schema["row"],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            sizes, gone, kept = [], [], []
            for content, removed in zip(
                batch.column("_text").cast(pa.binary()), batch.column("removed"), strict=True
            ):
                words = (content.as_py() or b"").split()
                sizes.append(len(words))
                if removed.is_valid:
                    hit = covered(len(words), removed.values.to_numpy())
                    words = [w for w, h in zip(words, hit.tolist(), strict=True) if not h]
                gone.append(sizes[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(sizes, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                schema.names,
            )

    return joined.mapInArrow(cut, schema)
