"""URL filters: rules indexed by their rarest literal token; only fetched rules run a pattern.

A rule names a host with its subdomains and a path prefix. Its literal tokens are the labels of the
host and the closed segments of the path. Every rule is filed under the one of its tokens that is
rarest in the given URLs; the distinct tokens of a URL fetch the rules filed under them by an
equi-join, and only these candidates are matched by regular expression. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import UPPER, settle
from caseflow.session import literal_rows

RULES = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("host", "path", "action")]
)
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
ANY = ""  # files a rule without tokens; every URL has it


def rules_of(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A few rules ``(action, host, path)`` as rows."""
    return literal_rows(spark, RULES, [(host, path, action) for action, host, path in rules])


def host_of(url: Column) -> Column:
    upper = UPPER.decode()
    found = F.translate(F.regexp_extract(url, PARTS, 1), upper, upper.lower())
    return F.coalesce(found, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def _host_tokens(host: Column) -> Column:
    return F.transform(F.array_remove(F.split(host, "[.]"), ""), lambda t: F.concat(F.lit("."), t))


def _path_tokens(path: Column, closed: bool) -> Column:
    """The segments of a path; ``closed``: without the last one, which may go on."""
    parts = F.split(path, "/")
    if closed:
        parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(F.array_remove(parts, ""), lambda t: F.concat(F.lit("/"), t))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per page: ``row`` (the input row, or its columns ``keep``), ``host``, ``path``,
    ``rule`` (host and path of the rule that decides, else null), ``verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest wins,
    then block before allow, then the larger text. A null URL or one without ``://`` has an empty
    host and path. Without a fitting rule the verdict is ``default``. Equal rules count once; no
    rules or an empty table are fine.
    """
    urls = settle(
        pages.select(F.coalesce(pages[url].cast("string"), F.lit("")).alias("_url")).distinct(),
        "urls",
    )
    parts = urls.select("_url", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    tokens = F.array_distinct(
        F.concat(_host_tokens(F.col("host")), _path_tokens(F.col("path"), False), F.array(F.lit(ANY)))
    )
    fetched = parts.select("*", F.explode(tokens).alias("token"))
    filed = rules.distinct().select(
        F.concat("host", "path").alias("rule"),
        "action",
        F.concat(
            F.lit(r"^(?:[^/]*\.)?"),
            _quoted(F.col("host")),
            F.when(F.col("path") == "", F.lit(r"(?=/|\z)")).otherwise(_quoted(F.col("path"))),
        ).alias("pattern"),
        F.concat(_host_tokens(F.col("host")), _path_tokens(F.col("path"), True)).alias("tokens"),
    )
    each = filed.select(
        "rule", "action", "pattern", F.explode_outer(F.array_distinct("tokens")).alias("token")
    ).withColumn("token", F.coalesce("token", F.lit(ANY)))
    seen = (
        fetched.select("token")
        .join(each.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    rarity = F.struct(F.coalesce("n", F.lit(0)), "token")
    index = settle(
        each.join(seen, "token", "left")
        .groupBy("rule", "action", "pattern")
        .agg(F.min_by("token", rarity).alias("token")),
        "rules",
    )
    fits = fetched.join(index, "token").filter("concat(host, path) rlike pattern")
    best = F.struct(F.length("rule"), F.col("action") == "block", "rule")
    verdicts = fits.groupBy("_url").agg(
        F.max_by(F.struct("rule", "action"), best).alias("winner")
    )
    rows = pages.select(
        F.struct(*(keep or ["*"])).alias("row"),
        F.coalesce(pages[url].cast("string"), F.lit("")).alias("_url"),
    )
    return rows.join(verdicts, "_url", "left").select(
        "row",
        host_of(F.col("_url")).alias("host"),
        path_of(F.col("_url")).alias("path"),
        F.col("winner.rule").alias("rule"),
        F.coalesce("winner.action", F.lit(default)).alias("verdict"),
    )
