"""Mixing sources to target weights by weighted sampling with exponential keys.

Every document draws the key ``-ln(u) / quality`` (Efraimidis and Spirakis): within a source the
documents in the order of their keys are a sample without replacement in which better ones come
early. A source's target is met by complete epochs of all its documents first and then by the head
of that order, cut where the prefix sum of words comes nearest to what is left. A source's prefix
sum is taken over buckets of the key, so that only the documents of the one bucket that holds the
cut are ever sorted: no source is gathered, however large. DataFrame functions only.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.llm.common import settle
from caseflow.operators.paging import number_rows

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix"
# Buckets per doubling of the key: of keys -ln(u) / q, whatever q is, at most the share
# ln(2) / e / KEY_BUCKETS falls into one.
KEY_BUCKETS = 256
RATIO_BINS = 64
LEAST_QUALITY = 0.05


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def symbol_quality(text: Column) -> Column:
    """The share of a text's characters that are no symbols, at least ``LEAST_QUALITY``."""
    clean = F.length(F.translate(text, SYMBOLS, "")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(clean, F.lit(1.0)), F.lit(LEAST_QUALITY))


def uniform(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 that depends on the key's text and the seed alone."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, most: int) -> DataFrame:
    """``target`` for each row of ``source_size, weight``: the weights' shares of all words, none above
    ``most`` times its source, the excess shared again by weight until none is.

    Sources reach their limit in the order of limit by weight. With those before one of them at
    their limits, the others share what is left; the level that no source after them exceeds is the
    largest that holds. Prefix sums go over bins of that order first, then within a bin.
    """
    limit = F.col("source_size") * most
    ranked = sizes.select("weight", limit.alias("limit"), (limit / F.col("weight")).alias("ratio"))
    ranked = ranked.withColumn("bin", F.floor(F.log2(F.col("ratio") + 1) * RATIO_BINS))
    bins = ranked.groupBy("bin").agg(F.sum("limit").alias("limits"), F.sum("weight").alias("weights"))
    # There are at most 64 times RATIO_BINS bins, however many sources.
    lower = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(
        "bin",
        F.coalesce(F.sum("limits").over(lower), F.lit(0)).alias("limits"),
        F.coalesce(F.sum("weights").over(lower), F.lit(0)).alias("weights"),
    )
    order = Window.partitionBy("bin").orderBy("ratio").rowsBetween(Window.unboundedPreceding, -1)
    held = F.col("limits") + F.coalesce(F.sum("limit").over(order), F.lit(0))
    gone = F.col("weights") + F.coalesce(F.sum("weight").over(order), F.lit(0))
    total = sizes.agg(F.sum("source_size")).scalar()
    all_weights = sizes.agg(F.sum("weight")).scalar()
    levels = ranked.join(bins, "bin").select(
        "weight", "limit", ((total - held) / (all_weights - gone)).alias("level")
    )
    level = levels.filter(F.col("weight") * F.col("level") <= F.col("limit")).agg(F.max("level")).scalar()
    target = F.least(F.col("weight") * level, limit.cast("double"))
    return sizes.withColumn("target", target)


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    quality: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: str = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``row`` (the input row, or its columns ``keep``), ``size``,
    ``source_size``, ``target``, ``epochs`` (how often it is taken) and ``taken`` in words.

    Sources in code point order, null last, have the weights in turn. Whole documents are taken;
    a source's words differ from its target by half of one document at most. A document without
    words has size 0 and is never taken in part; a source without words has target 0. Equal ids
    have equal keys and are ordered by size and text; a null id has a key as well. An empty table
    gives no rows. Reruns draw the same keys.
    """
    column = docs[text].cast("string")
    weight = symbol_quality(column) if quality is None else quality
    stored = settle(
        docs.select(
            F.struct(*(keep or ["*"])).alias("row"),
            docs[source].alias("_source"),
            word_count(column).alias("size"),
            (-F.log(uniform(docs[doc_id], seed)) / weight).alias("_key"),
            F.struct(docs[doc_id].alias("id"), F.xxhash64(column).alias("text")).alias("_tie"),
        ).withColumn(
            # Monotone in the key; its logarithm makes the shares of buckets the same for any quality.
            "_bucket",
            F.floor(F.log2("_key") * KEY_BUCKETS).cast("int"),
        ),
        "sized",
    )
    heaps = stored.groupBy("_source", "_bucket").agg(F.sum("size").alias("words"))
    sizes = heaps.groupBy("_source").agg(F.sum("words").alias("source_size"))
    ranked = settle(number_rows(sizes, ["_source"], "_rank", unique=True), "sources")
    turn = F.array(*map(F.lit, weights))[(F.col("_rank") % len(weights)).cast("int")]
    times = F.floor(F.col("target") / F.col("source_size"))
    plan = targets(ranked.withColumn("weight", turn), most).withColumn(
        "_epochs", F.when(F.col("source_size") > 0, times).otherwise(0).cast("long")
    )
    plan = plan.withColumn("_left", F.col("target") - F.col("_epochs") * F.col("source_size"))
    in_order = Window.partitionBy("_source").orderBy("_bucket")
    before = F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    heaps = heaps.withColumn("_before", F.coalesce(before, F.lit(0)))
    # The bucket in which the prefix sum passes what is left; buckets before it are taken whole.
    cut = (
        heaps.alias("h")
        .join(plan.alias("p"), F.col("h._source").eqNullSafe(F.col("p._source")))
        .filter("_before <= _left and _before + words > _left")
        .select(F.col("p._source").alias("_source"), F.col("_bucket").alias("_cut"), "_before")
    )
    plan = settle(
        plan.alias("p")
        .join(cut.alias("c"), F.col("p._source").eqNullSafe(F.col("c._source")), "left")
        .select("p.*", "_cut", "_before"),
        "targets",
    )
    joined = (
        stored.alias("d")
        .join(plan.alias("p"), F.col("d._source").eqNullSafe(F.col("p._source")))
        .select("row", "size", "_key", "_tie", "_bucket", "p.*")
    )
    is_cut = F.col("_bucket").eqNullSafe(F.col("_cut"))
    order = (
        Window.partitionBy("_source")
        .orderBy("_key", "_tie", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sorted_ = joined.filter(is_cut).withColumn(
        "_prefix", F.col("_before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    )
    # Taken where that comes nearer to the target than leaving it out.
    sorted_ = sorted_.withColumn("_part", F.col("_prefix") + F.col("size") / 2 <= F.col("_left"))
    whole = joined.filter(~is_cut).withColumn(
        "_part", F.coalesce(F.col("_bucket") < F.col("_cut"), F.lit(False))
    )
    both = sorted_.drop("_prefix").unionByName(whole)
    epochs = F.col("_epochs") + (F.col("_part") & (F.col("size") > 0)).cast("long")
    taken = (epochs * F.col("size")).alias("taken")
    return both.select("row", "size", "source_size", "target", epochs.alias("epochs"), taken)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, numbered by ``mix_epoch`` from 1,
    with ``mix_size``, ``mix_source_size``, ``mix_target``; documents not taken are gone.

    If the documents have a column of one of these names, in any case, all four get the smallest
    ending from ``_2`` on with which none clashes; the documents' own columns stay as they are.
    """
    taken = mix(docs, **options).filter("epochs > 0")
    epoch = F.explode(F.sequence(F.lit(1).cast("long"), "epochs"))
    added = {
        "mix_size": F.col("size"),
        "mix_source_size": F.col("source_size"),
        "mix_target": F.col("target"),
        "mix_epoch": epoch,
    }
    given = {c.lower() for c in docs.columns}
    endings = ("" if n == 1 else f"_{n}" for n in count(1))
    ending = next(e for e in endings if not given & {name + e for name in added})
    return taken.select("row.*", *(value.alias(name + ending) for name, value in added.items()))
