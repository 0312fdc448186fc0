"""The append-only landing zone: JSON records in, fixed-schema text parquet out."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.functions import as_ntz, parse_ts
from caseflow.schema import (
    LANDING_SCHEMA,
    RAW_COLUMNS,
    RECORD_SCHEMA,
    landed_name,
)

Bound = Column | datetime | date | str
NO_FILES = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_landing(spark: SparkSession, root: str, merge_schema: bool = False) -> DataFrame:
    """Every landed row with its ``ingest_date``; an empty frame while nothing has landed.

    Columns are matched by name and missing ones read as null. The fixed schema spares the footer
    scan; ``merge_schema`` unions the columns of all files instead.
    """
    reader = spark.read
    reader = reader.option("mergeSchema", True) if merge_schema else reader.schema(LANDING_SCHEMA)
    try:
        return reader.parquet(root)
    except AnalysisException as e:
        if e.getCondition() in NO_FILES:
            return spark.createDataFrame([], LANDING_SCHEMA)
        raise


# Options beyond the default also keep Catalyst from splitting a parse into one per column.
STRICT_JSON = {
    "mode": "PERMISSIVE",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
END = "end of line"


def _whole_record(line: Column, schema: T.StructType) -> Column:
    """The members of the one JSON object that a line is, as text; null if it is anything else.

    The parser stops where a value ends, so the line is put into an array in front of a mark of its
    own: only if the array has just these two has the line been read to its end.
    """
    mark = F.xxhash64(line).cast("string")
    text = F.concat(F.lit("["), line, F.lit(f',{{"{END}":"'), mark, F.lit('"}]'))
    closed = T.ArrayType(T.StructType([*schema.fields, T.StructField(END, T.StringType())]))
    return F.transform(
        F.array(F.from_json(text, closed, STRICT_JSON)),
        lambda found: F.when(
            (F.size(found) == 2) & (F.get(found, F.lit(1))[END] == mark), F.get(found, F.lit(0))
        ),
    )[0]


def read_lines(
    lines: DataFrame,
    line: str = "value",
    schema: T.StructType = RECORD_SCHEMA,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every line with its record ``_r``, its drift ``_extra`` and whether it is ``_broken``.

    A line is broken if it is not one JSON object and nothing else (null is not), or if an object
    in it has two members of one name, of which only one could be kept. Nothing makes the job fail.
    Lines are parsed once; those with undeclared members or nested values once more, with types.
    """
    known = schema.fieldNames()
    c = F.col(line)
    read = lines.select(
        *(keep or []), c, _whole_record(c, schema).alias("_r"), F.json_object_keys(c).alias("_keys")
    )
    undeclared = F.exists("_keys", lambda k: ~k.isin(known))
    rest = F.substr(c, F.lit(2))
    nested = F.contains(rest, F.lit("{")) | F.contains(rest, F.lit("["))
    typed = F.when(undeclared | nested, F.from_json(c, "map<string,variant>", STRICT_JSON))
    read = read.withColumns({"_typed": typed, "_asked": undeclared | nested})
    twice = F.size(F.array_distinct("_keys")) < F.size("_keys")
    lost = F.col("_asked") & F.col("_typed").isNull()
    whole = F.col("_r").isNotNull() & F.col("_keys").isNotNull()
    broken = ~F.coalesce(whole & ~twice & ~lost, F.lit(False))
    drift = F.map_filter("_typed", lambda k, _: ~k.isin(known))
    extra = F.nullif(F.to_json(drift), F.lit("{}"))
    return read.withColumns({"_broken": broken, "_extra": extra}).drop("_keys", "_typed", "_asked")


def _fields(schema: T.StructType) -> list[Column]:
    names = schema.fieldNames()
    return [F.col("_r").getField(f).alias(landed_name(f)) for f in names] + [F.col("_extra")]


def parse_records(
    lines: DataFrame,
    line: str = "value",
    schema: T.StructType = RECORD_SCHEMA,
    keep: list[str] | None = None,
) -> DataFrame:
    """JSON object lines to text columns plus ``_extra``; absent keys become null.

    Nested values stay JSON text. For trusted lines: a broken one fails the job instead of landing
    as nulls. ``keep`` carries columns through.
    """
    read = read_lines(lines, line, schema, keep)
    message = F.concat(F.lit("malformed record: "), F.col(line))
    checked = read.withColumn("_r", F.when(F.col("_broken"), F.raise_error(message)).otherwise(F.col("_r")))
    return checked.select(*(keep or []), *_fields(schema))


def split_records(lines: DataFrame, line: str = "value") -> tuple[DataFrame, Observation]:
    """Like ``parse_records``, but broken lines are left out and counted: the observation gives
    their number as ``broken`` once the frame has been written."""
    seen = Observation()
    counted = read_lines(lines, line).observe(seen, F.count_if("_broken").alias("broken"))
    return counted.filter(~F.col("_broken")).select(*_fields(RECORD_SCHEMA)), seen


def broken_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """The lines that ``split_records`` leaves out."""
    return read_lines(lines, line).filter("_broken").select(line)


def stamp(
    df: DataFrame, run_id: str | Column, batch_id: str | Column, ingested_at: str | Column
) -> DataFrame:
    """Add the lineage columns."""
    values = {"_run_id": run_id, "_batch_id": batch_id, "_ingested_at": ingested_at}
    return df.withColumns(
        {k: (v if isinstance(v, Column) else F.lit(v)).cast("string") for k, v in values.items()}
    )


def normalise(
    lines: DataFrame, run_id: str, batch_id: str | Column, ingested_at: str, line: str = "value"
) -> DataFrame:
    """JSON lines to the fixed raw schema, stamped."""
    return stamp(parse_records(lines, line), run_id, batch_id, ingested_at).select(*RAW_COLUMNS)


def fixed_columns(df: DataFrame) -> DataFrame:
    """Complete any subset of the raw columns with nulls, in the fixed order."""
    have = set(df.columns)
    return df.select(
        *[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS]
    )


def unexpected_keys(raw: DataFrame) -> DataFrame:
    """The distinct drifted keys, one per row (``key``)."""
    drifted = raw.filter(F.col("_extra").isNotNull())
    return drifted.select(F.explode(F.json_object_keys("_extra")).alias("key")).distinct()


def unexpected_key_list(raw: DataFrame) -> DataFrame:
    """One row: the sorted list of drifted keys as the run log stores it."""
    keys = unexpected_keys(raw)
    return keys.agg(F.array_sort(F.collect_set("key")).alias("unexpected_keys"))


def local_batch_id(run_id: str, rows_per_file: int, frame: int = 0) -> Column:
    """Batch id from the frame of the run, the writing task and the file it rolls over to: no
    shuffle, stable on retry, and no two files of a run share one."""
    position = F.monotonically_increasing_id()
    in_task = position.bitwiseAND(F.lit((1 << 33) - 1))
    return F.format_string(
        f"{run_id}-{frame:04d}-%05d-%04d",
        F.shiftright(position, 33),
        F.floor(in_task / F.lit(rows_per_file)).cast("long"),
    )


def write_batch(df: DataFrame, root: str, ingest_date: date | str, rows_per_file: int) -> None:
    """Append immutable zstd files to one date partition; the commit makes them visible at once."""
    (
        df.select(*[c for c in df.columns if c != "ingest_date"])
        .write.mode("append")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(f"{root}/ingest_date={ingest_date}")
    )


def event_time(df: DataFrame, column: str) -> Column:
    """The column as naive timestamp: text is parsed, timestamps stay as they are (pushdown)."""
    c = F.col(column)
    return parse_ts(c) if isinstance(df.schema[column].dataType, T.StringType) else c


def window_slice(
    df: DataFrame, after: Bound, through: Bound, column: str = "sys_updated_at"
) -> DataFrame:
    """Rows updated in ``(after, through]``."""
    t = event_time(df, column)
    return df.filter((t > as_ntz(after)) & (t <= as_ntz(through)))


def window_count(
    df: DataFrame, after: Bound, through: Bound, column: str = "sys_updated_at"
) -> DataFrame:
    """Dry run: how many rows the window holds."""
    return window_slice(df, after, through, column).agg(F.count("*").alias("n_rows"))


def max_updated_seen(df: DataFrame, column: str = "sys_updated_at") -> DataFrame:
    return df.agg(F.max(column).alias("max_updated_seen"))


def run_summary(raw: DataFrame, run_id: str, ingest_dates: list[date]) -> dict:
    """What one run has committed: rows, files, newest update, drifted keys.

    Read back from the files, so retried tasks are not counted twice. Only the run's own date
    partitions and three narrow columns are scanned.
    """
    mine = raw.filter(F.col("ingest_date").isin(ingest_dates) & (F.col("_run_id") == run_id))
    # Not _metadata: a landing zone without any file does not have it.
    located = mine.select("sys_updated_at", F.input_file_name().alias("file"))
    row = located.agg(
        F.count("*").alias("rows"),
        F.count_distinct("file").alias("files"),
        F.max("sys_updated_at").alias("max_updated_seen"),
    ).first()
    # One run-log row holds the key list, so its size is that of the drift report itself.
    keys = unexpected_key_list(mine).first()["unexpected_keys"]
    return {**row.asDict(), "unexpected_keys": keys}
