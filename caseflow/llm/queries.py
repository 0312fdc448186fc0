"""Registered queries of the training-data operators: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm import (
    alignment,
    chat,
    decontaminate,
    licences,
    mixing,
    pii,
    quality,
    simhash,
    spelling,
    substrings,
    tokens,
    urls,
    warc,
)
from caseflow.llm.oracles import ORACLES
from caseflow.session import literal_rows

OVER_LIMIT = 512
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def covered_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["size"])


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    n_hit = covered_words(F.col("spans"))
    return found.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return groups.select("row.doc_id", "fingerprint", "component_id")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return done.select("row.doc_id", "n_words", "n_removed", kept)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(tokens.VOCABULARY)
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), path, keep=["doc_id"])
    over = (F.col("n_tokens") > OVER_LIMIT).alias("over_limit")
    return counted.select("row.doc_id", "n_bytes", "n_tokens", over)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urls.rules_of(spark, URL_RULES)
    judged = urls.judge_urls(table(spark, sf_dir, "pages"), rules, keep=["page_id"])
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.pseudonymise(table(spark, sf_dir, "documents"), pii.EXAMPLE_KEY, keep=["doc_id"])
    return done.select(
        "row.doc_id",
        F.size("kinds").cast("long").alias("n_values"),
        F.array_join(F.array_sort(F.array_distinct("kinds")), ",").alias("kinds"),
        F.col("_text").alias("text"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))
    return records.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def with_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations and one whose texts are full of control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    more = [(-7, 0, "user", marks), (-7, 1, "assistant", marks)]
    return rows.unionByName(literal_rows(spark, rows.schema, more))


def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = chat.format_chats(with_marks(spark, sf_dir))
    read = windows.select(
        "conv_id",
        "window",
        F.length("formatted").cast("long").alias("chars"),
        chat.read_turns(F.col("formatted"), F.col("n_repeated")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("targets"),
    )
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    pieces = read.select(
        "conv_id",
        "chars",
        F.size("turns").cast("long").alias("n"),
        F.struct(
            "window",
            F.array_join(F.transform("turns", line), "").alias("turns"),
            F.array_join("targets", "").alias("loss"),
        ).alias("piece"),
    )
    # The digest is of a conversation's whole text, so its text meets in one row.
    whole = pieces.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("piece")).alias("pieces"),
    )
    text = lambda name: F.array_join(F.transform("pieces", lambda p: p[name]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(text("turns"), 256).alias("turns_sha256"),
        F.length(text("loss")).cast("long").alias("loss_chars"),
        F.sha2(text("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op11_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licences.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return scanned.select(
        "row.doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    done = alignment.align_tokenizers(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(alignment.VOCABULARY_A),
        public_tokenizers.path(alignment.VOCABULARY_B),
        keep=["doc_id"],
    )
    return done.select(
        "row.doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        "groups_sha256",
    )


def with_slips(runs: DataFrame) -> DataFrame:
    """The contract's slips of the pen: a letter is lost where 31 divides the hash of id and run."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    return (
        runs.withColumn("h", F.crc32(key.cast("binary")))
        .withColumn("at", F.pmod("h", F.length("run").cast("long")).cast("int"))
        .select(
            F.when(
                F.col("h") % 31 == 0,
                F.concat(
                    F.substr("run", F.lit(1), F.col("at")),
                    F.substr("run", F.col("at") + 2, F.length("run")),
                ),
            )
            .otherwise(F.col("run"))
            .alias("word")
        )
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A slip only shortens a run, so shorter ones never become words.
    runs = spelling.runs(table(spark, sf_dir, "documents"), least_letters=spelling.LEAST_LETTERS)
    return spelling.variants(with_slips(runs))


QUERIES = {
    q.__name__: q
    for q in (
        op1_mix_sources,
        op2_decontaminate,
        op3_simhash_groups,
        op4_substring_dedup,
        op5_token_counts,
        op6_url_filter,
        op7_quality_rules,
        op8_pseudonyms,
        op9_warc,
        op10_chat_windows,
        op11_licence_scan,
        op12_token_alignment,
        op13_spelling_variants,
    )
}


def all_queries() -> dict:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
