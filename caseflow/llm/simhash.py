"""SimHash near-duplicates: popcount embedding, grid range-join, exact verification, components.

The 64 bits of a fingerprint are 16 segments of four; the vector of their bit counts is a point of
the lattice {0..4}^16. The Manhattan distance of two points never exceeds the bit distance of their
fingerprints, so fingerprints at two bits or fewer have points at Manhattan distance two or less,
and such points always share a lattice cell that is at most one step from either. Every distinct
fingerprint is dealt to its own cell and to those one step away (33 at most); cells that hold one
fingerprint only are dropped. What is left is verified exactly: two fingerprints are within two
bits if and only if they share a value that is at most one flipped bit from either. The shared
values lie in the shared cells, and at most 65 fingerprints share one, so no group grows with the
data and no pairs are emitted: work is linear in the number of distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import LOWER, settle
from caseflow.llm.components import connected

SEED = 42
SEGMENTS = 16
BITS_AT_ONCE = 1 << 15


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The SimHash of a text: bit set where over half of the shingle hashes have it."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), BITS_AT_ONCE):
        bounds = zip(starts[at : at + BITS_AT_ONCE], ends[at : at + BITS_AT_ONCE], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in bounds], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``docs`` with a column ``_fp``: the fingerprint as a long, bit for bit."""
    schema = T.StructType([*docs.schema.fields, T.StructField("_fp", T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            marks = [fingerprint(t.as_py(), shingle) for t in texts]
            column = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "_fp"])

    return docs.mapInArrow(add, schema)


def _cell(fp: Column) -> Column:
    """Bit counts of the 16 segments of four, one in each nibble of a long."""

    def half(x: Column) -> Column:
        pairs = x.bitwiseAND(F.lit(0x55555555)) + F.shiftright(x, 1).bitwiseAND(F.lit(0x55555555))
        return pairs.bitwiseAND(F.lit(0x33333333)) + F.shiftright(pairs, 2).bitwiseAND(
            F.lit(0x33333333)
        )

    low = half(fp.bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.shiftleft(half(F.shiftrightunsigned(fp, 32)), 32).bitwiseOR(low)


def _steps(cell: Column) -> Column:
    """The cell itself and all one step away: where, in which segment, and up or down."""

    def step(segment: int, up: bool) -> Column:
        nibble = F.shiftright(cell, 4 * segment).bitwiseAND(F.lit(0xF).cast("long"))
        one = F.lit(1 << (4 * segment)).cast("long")
        move = F.struct(
            (cell + one if up else cell - one).alias("cell"),
            F.lit(segment).alias("segment"),
            F.lit(1 if up else -1).alias("way"),
        )
        return F.when(nibble < 4 if up else nibble > 0, move)

    stay = F.struct(cell.alias("cell"), F.lit(0).alias("segment"), F.lit(0).alias("way"))
    moves = [step(s, up) for s in range(SEGMENTS) for up in (True, False)]
    return F.array_compact(F.array(stay, *moves))


def near_links(fps: DataFrame) -> DataFrame:
    """Edges ``u, v`` that connect exactly the distinct fingerprints ``_fp`` within two bits."""
    dealt = fps.withColumn("_cell", _cell(F.col("_fp"))).select(
        "_fp", F.inline(_steps(F.col("_cell")))
    )
    crowded = dealt.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1").select("cell")
    # Spark sizes the dealt rows by the fingerprints they are made of, 33 times too low: no side of
    # this join may be broadcast.
    kept = dealt.join(crowded.hint("merge"), "cell")
    # In its own cell a fingerprint can only meet itself as a shared value.
    flips = [F.expr(f"shiftleft(1L, segment * 4 + {j})") for j in range(4)]
    flipped = F.array_compact(
        F.array(
            *[
                F.when(
                    (F.col("way") > 0) == (F.col("_fp").bitwiseAND(bit) == 0),
                    F.col("_fp").bitwiseXOR(bit),
                )
                for bit in flips
            ]
        )
    )
    shared = F.when(F.col("way") == 0, F.array("_fp")).otherwise(flipped)
    meets = kept.select("_fp", F.explode(shared).alias("value"))
    # At most 65 distinct fingerprints are within one bit of a value: the list is bounded.
    groups = meets.groupBy("value").agg(F.collect_list("_fp").alias("near")).filter(F.size("near") > 1)
    least = F.array_min("near")
    return (
        groups.select(least.alias("v"), F.explode("near").alias("u")).filter("u <> v").distinct()
    )


def near_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = 3,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``row`` (the input row, or its columns ``keep``), ``uid``,
    ``fingerprint``, ``component_id``, ``leads``.

    Documents whose fingerprints differ in at most two bits are linked; ``component_id`` is the
    smallest id reachable and ``leads`` is true for one document of each component: that id's
    first row. Texts are lower-cased (A-Z) and cut at white space; fewer words than a shingle are
    one shingle, and a null or empty text has fingerprint zero, which links like any other.
    A null id is never the smallest unless its component has no other, then ``component_id`` is
    null. Equal rows are kept and share a component. An empty table gives no rows.
    """
    source = docs.select(
        F.struct(*(keep or ["*"])).alias("row"),
        docs[text].cast("string").alias("_text"),
        docs[doc_id].alias("_id"),
    )
    marked = with_fingerprints(source, "_text", shingle).drop("_text")
    stored = settle(marked.withColumn("uid", F.monotonically_increasing_id()), "fingerprints")
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), "uid")
    classes = settle(
        stored.groupBy("_fp").agg(F.min(order).alias("head")), "classes"
    )
    roots = connected(settle(near_links(classes.select("_fp")), "links"))
    named = classes.join(roots, classes["_fp"] == roots["node"], "left").select(
        "_fp", "head", F.coalesce("root", "_fp").alias("root")
    )
    heads = named.groupBy("root").agg(F.min("head").alias("first"))
    verdicts = settle(named.join(heads, "root").select("_fp", "first"), "verdicts")
    return stored.join(verdicts, "_fp").select(
        "row",
        "uid",
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        (F.col("first.uid") == F.col("uid")).alias("leads"),
    )


def drop_near_copies(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3
) -> DataFrame:
    """The documents with one row of every near-duplicate component left, columns unchanged."""
    return near_groups(docs, text, doc_id, shingle).filter("leads").select("row.*")
