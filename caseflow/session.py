"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, datetime
from threading import Lock
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles larger methods: wide projections then run faster in smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings that are held at present: by session and name, how often and what was set before.
_HELD: dict[tuple[int, str], tuple[int, str | None]] = {}
_HOLDING = Lock()


def local_session(cores: int | str = 8, app: str = "caseflow", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster passes its own session to the library."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the cluster's shared folder (``spark.checkpoint.dir``) for a cut in lineage.

    A temporary folder of this machine is used only where the setting is absent and the session
    is local, as in tests: on a cluster the executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="caseflow-")
    return f"{base.rstrip('/')}/caseflow/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later passes see identical rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session while something is written, also from several threads at once."""
    at = (spark._jsparkSession.hashCode(), name)
    with _HOLDING:
        times, before = _HELD.get(at) or (0, spark.conf.get(name, None))
        spark.conf.set(name, value)
        _HELD[at] = (times + 1, before)
    try:
        yield
    finally:
        with _HOLDING:
            times, before = _HELD.pop(at)
            if times > 1:
                _HELD[at] = (times - 1, before)
            else:
                spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _literal(value: Any, dtype: T.DataType) -> Column:
    if isinstance(value, (list, tuple)):
        return F.array(*map(F.lit, value)).cast(dtype)
    if isinstance(value, (datetime, date)):
        value = str(value)
    return F.lit(value).cast(dtype)


def literal_rows(
    spark: SparkSession, schema: T.StructType, rows: Sequence[Sequence[Any]]
) -> DataFrame:
    """A few driver values (log entries, check results) as one partition, without Python workers."""
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(r, schema, strict=True)])
        for r in rows
    ]
    one = spark.range(0, 1, 1, 1)
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def together(spark: SparkSession, tasks: Sequence[Callable[[], Any]], width: int = 8) -> list:
    """Run independent Spark jobs from threads, so the tail of one overlaps the next."""
    with ThreadPoolExecutor(min(width, max(len(tasks), 1))) as pool:
        run = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [f.result() for f in run]
