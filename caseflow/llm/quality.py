"""Quality rules: failures of every rule by domain, shrunk by an empirical beta prior.

Each document is measured once. For every rule, a domain's failures out of its documents are
shrunk towards all domains by a beta prior, so that a domain of few documents is judged by the
others' rate and a large one by its own. The prior is fitted by the moments of the beta-binomial:
of the spread of the domains' rates, what drawing so few documents per domain explains by itself is
taken off first, and only the rest speaks for real differences. Where nothing is left (domains of
one document each, or rates no further apart than chance) all domains share the common rate. A
domain is rejected if a shrunk rate passes the limit; its verdict is joined back to the documents.
Counts are pre-aggregated, so a hot domain costs one row per task. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import settle

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
MOST_RATE = 0.5

# What a rule counts against a document. The first two reject it by themselves.
BASE_RULES = {
    "short": f"n_words < {LEAST_WORDS}",
    "repeated": f"100 * n_repeat_words > {MOST_REPEATED} * n_words",
}
RULES = BASE_RULES | {
    "symbols": "10 * n_symbols > n_words",
    "copied_lines": "10 * n_dup_lines > 3 * n_lines",
    "odd_words": "word_chars < 3 * n_words or word_chars > 12 * n_words",
}


def _triples(words: Column) -> Column:
    """A hash of every window of three words; none for three words or fewer, which repeat nothing."""
    count = F.size(words)
    hashes = F.transform(
        F.sequence(F.lit(0), count - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])
    )
    return F.when(count >= 4, hashes).otherwise(F.array().cast("array<bigint>"))


def measured(docs: DataFrame, text: str, columns: list[Column]) -> DataFrame:
    """``columns`` and the measures of every text; a null text has none of anything."""
    df = docs.select(*columns, F.coalesce(docs[text].cast("string"), F.lit("")).alias("_t"))
    names = [c for c in df.columns if c != "_t"]
    df = df.withColumn("_words", F.array_remove(F.split("_t", WHITE), ""))
    df = df.withColumn("_triples", _triples(F.col("_words")))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    df = df.withColumn("_lines", F.filter(F.split("_t", "\n"), has_word))
    # Equal windows stand side by side once sorted. Most texts repeat nothing and skip that.
    placed = F.transform("_triples", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("_triples")) < F.size("_triples")
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("_sorted", F.when(repeats, F.array_sort(placed)).otherwise(nothing))

    def equals(k: Column, other: Column) -> Column:
        here, there = F.get("_sorted", k)["h"], F.get("_sorted", other)["h"]
        return F.coalesce(here == there, F.lit(False))

    twice = F.filter("_sorted", lambda x, k: equals(k, k - 1) | equals(k, k + 1))
    df = df.withColumn("_starts", F.transform(twice, lambda x: x["i"]))
    covered = F.concat(
        "_starts", F.transform("_starts", lambda i: i + 1), F.transform("_starts", lambda i: i + 2)
    )
    return df.select(
        *names,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return F.expr(" or ".join(f"({rule})" for rule in BASE_RULES.values()))


def likeness(n: int, domains: int, mean: float, spread: float) -> float:
    """How alike two documents of one domain are in a rule (0: no more than any two, 1: equal).

    ``spread`` is the variance of the domains' rates, weighted by their ``n`` documents in all. By
    the moments of the beta-binomial it is ``mean * (1 - mean) * (r + (1 - r) * domains / n)``.
    """
    if domains >= n or mean <= 0 or mean >= 1:
        return 0.0
    chance = domains / n
    return min(max((spread / (mean * (1 - mean)) - chance) / (1 - chance), 0.0), 1.0)


def domain_verdicts(stats: DataFrame, domain: str, most_rate: float = MOST_RATE) -> DataFrame:
    """``domain`` and ``rejected`` for each domain of the measured documents."""
    fails = [F.sum(F.expr(rule).cast("long")).alias(name) for name, rule in RULES.items()]
    domains = settle(stats.groupBy(domain).agg(F.count("*").alias("n"), *fails), "domains")
    moments = []
    for name in RULES:
        square = F.col(name) * F.col(name) / F.col("n")
        moments += [F.sum(name).alias(f"{name}_k"), F.sum(square).alias(f"{name}_q")]
    row = domains.agg(F.sum("n").alias("n"), F.count("*").alias("domains"), *moments).first()
    total = row["n"] or 0
    rejected = F.lit(False)
    for name in RULES if total else ():
        mean = row[f"{name}_k"] / total
        alike = likeness(total, row["domains"], mean, row[f"{name}_q"] / total - mean * mean)
        # The prior weighs as much as 1 / alike - 1 documents: both sides times alike.
        rate = (F.col(name) * alike + mean * (1 - alike)) / (F.col("n") * alike + (1 - alike))
        rejected = rejected | (rate > most_rate)
    return domains.select(domain, rejected.alias("rejected"))


def judge(
    docs: DataFrame,
    text: str = "text",
    domain: str = "source",
    keep: list[str] | None = None,
    most_rate: float = MOST_RATE,
) -> DataFrame:
    """One row per document: ``row`` (the input row, or its columns ``keep``), the measures,
    ``base_failed`` and ``kept``: neither failed itself nor of a rejected domain.

    A null or empty text has no words and fails; documents without a domain form one. Equal rows
    count as often as they occur. An empty table gives no rows.
    """
    columns = [F.struct(*(keep or ["*"])).alias("row"), docs[domain].alias("_domain")]
    stats = settle(measured(docs, text, columns), "measures")
    verdicts = domain_verdicts(stats, "_domain", most_rate)
    rejected = verdicts.filter("rejected").withColumnRenamed("_domain", "_bad")
    return (
        stats.withColumn("base_failed", base_failed())
        .join(rejected, F.col("_domain").eqNullSafe(F.col("_bad")), "left")
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected").isNull())
        .drop("_domain", "_bad", "rejected")
    )


def keep_good(docs: DataFrame, text: str = "text", domain: str = "source", **options) -> DataFrame:
    """The documents that are kept, columns unchanged."""
    return judge(docs, text, domain, **options).filter("kept").select("row.*")
