"""Where the tables live: immutable folders, and for every table the one that its newest build wrote."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import UTC, datetime
from threading import RLock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.operators.incremental import INGESTED, first_by, latest_per_key
from caseflow.schema import Settings
from caseflow.session import held, literal_rows
from caseflow.sources.landing import NO_FILES, read_landing
from caseflow.sources.runlog import RunLog

KEY, KEYED = "unique_key", "_key"
BUILD_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("build_no", T.LongType()),
        T.StructField("through", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("schema_json", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("built_at", T.TimestampNTZType()),
    ]
)
# With open files for two buckets a task need not sort its rows by bucket: where a table keeps its number
# of buckets a task has rows of one. Of more buckets the others are sorted.
WRITERS = ("spark.sql.maxConcurrentOutputFileWriters", "2")
MARK_FIELDS = ["build_no", "through", "buckets", "schema_json", "path"]


def documented(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column descriptions; parquet keeps them with the data."""
    for name, text in comments.items():
        df = df.withMetadata(name, {"comment": text})
    return df


class Warehouse:
    """Paths, reads and writes below one root folder.

    A build writes a table to a new folder and then appends its mark; readers follow the newest
    mark. No folder is written twice, so a build that fails or is lost half-way changes nothing,
    and a reader keeps the state it began with. One process builds at a time. ``vacuum`` removes
    the folders of older builds.

    A keyed table is a Spark table bucketed by its key. An increment is brought to the buckets and
    merged with what is stored there: the stored side is read and written once and never shuffled.
    Rows that come from the buckets of another table keep their bucketing column and stay in place.
    """

    def __init__(self, spark: SparkSession, root: str, settings: Settings = Settings()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.settings = settings
        self.raw_path = f"{self.root}/raw"
        self.quarantine = f"{self.root}/meta/quarantine"
        self.runs = RunLog(spark, f"{self.root}/meta/ingest_runs")
        self._marks: dict[str, Row] | None = None
        self._uncommitted: list[tuple] = []
        self._deferred = False
        self._expected: dict[str, int] = {}
        self._lock = RLock()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def raw(self, merge_schema: bool = False) -> DataFrame:
        """The landing zone; ``merge_schema`` gives columns beyond the declared ones as well."""
        return read_landing(self.spark, self.raw_path, merge_schema)

    def quarantined(self) -> DataFrame:
        """Lines that could not be landed, with their run."""
        schema = "value string, run_id string"
        try:
            return self.spark.read.schema(schema).parquet(self.quarantine)
        except AnalysisException as e:
            if e.getCondition() in NO_FILES:
                return self.spark.createDataFrame([], schema)
            raise

    # --- build marks -------------------------------------------------------------------

    def builds(self) -> DataFrame:
        try:
            return self.spark.read.schema(BUILD_SCHEMA).parquet(self.path("meta/builds"))
        except AnalysisException as e:
            if e.getCondition() in NO_FILES:
                return self.spark.createDataFrame([], BUILD_SCHEMA)
            raise

    def build_mark(self, name: str) -> Row | None:
        """The newest committed build of a table: read once, then kept by this one writer."""
        with self._lock:
            if self._marks is None:
                newest = F.max_by(F.struct(*MARK_FIELDS), "build_no").alias("m")
                rows = self.builds().groupBy("table").agg(newest).collect()
                self._marks = {r["table"]: r["m"] for r in rows}
            return self._marks.get(name)

    def through(self, name: str) -> str | None:
        mark = self.build_mark(name)
        return mark["through"] if mark else None

    def build_no(self, name: str) -> int:
        """Which build of the table is current: the state of whatever is made from it."""
        mark = self.build_mark(name)
        return mark["build_no"] if mark else 0

    def commit(
        self, name: str, schema: T.StructType, through: str | None, buckets: int, path: str
    ) -> None:
        with self._lock:
            values = (self.build_no(name) + 1, through, buckets, schema.json(), path)
            self._marks[name] = Row(**dict(zip(MARK_FIELDS, values, strict=True)))
            self._uncommitted.append((name, *values, datetime.now(UTC).replace(tzinfo=None)))
            if not self._deferred:
                self._flush()

    def _flush(self) -> None:
        rows, self._uncommitted = self._uncommitted, []
        if rows:
            frame = literal_rows(self.spark, BUILD_SCHEMA, rows)
            frame.write.mode("append").parquet(self.path("meta/builds"))

    @contextmanager
    def one_commit(self) -> Iterator[None]:
        """Write the marks of several tables in one file; what finished is marked even on failure."""
        self._deferred = True
        try:
            yield
        finally:
            self._deferred = False
            with self._lock:
                self._flush()

    def vacuum(self) -> list[str]:
        """Remove the folders of older builds; returns them. Run it while no build runs and no
        reader holds an older state."""
        gone = []
        for row in self.builds().select("table").distinct().collect():
            used = self.build_mark(row["table"])["path"].rsplit("/", 1)[1]
            gone += self.keep_only(row["table"], {used}, "part=")
        return gone

    def keep_only(self, name: str, used: set[str], prefix: str) -> list[str]:
        """Remove the folders below ``name`` that begin with the prefix and are not used."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = []
        for status in system.listStatus(folder):
            found = status.getPath().getName()
            if found.startswith(prefix) and found not in used:
                system.delete(status.getPath(), True)
                gone.append(f"{name}/{found}")
        return gone

    # --- reads -------------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self.build_mark(name) is not None

    def schema(self, name: str) -> T.StructType:
        mark = self.build_mark(name)
        if mark is None:
            raise LookupError(f"{name} has not been built")
        return T.StructType.fromJson(json.loads(mark["schema_json"]))

    def _catalogued(self, path: str, schema: T.StructType, buckets: int) -> str:
        """The name by which this session knows a bucketed folder; its buckets are in the catalog."""
        name = "caseflow_" + path.rsplit("=", 1)[1]
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, {KEYED} string) USING parquet "
                f"CLUSTERED BY ({KEYED}) INTO {buckets} BUCKETS LOCATION '{self.path(path)}'"
            )
        return name

    def stored(self, name: str) -> DataFrame:
        """A keyed table with its bucketing column, partitioned as it lies there."""
        mark, schema = self.build_mark(name), self.schema(name)
        return self.spark.table(self._catalogued(mark["path"], schema, mark["buckets"]))

    def read(self, name: str, keyed: bool = False) -> DataFrame:
        """A table; ``keyed`` keeps the bucketing column of a keyed one."""
        schema, mark = self.schema(name), self.build_mark(name)
        if not mark["buckets"]:
            # The recorded schema spares the footer scan.
            return self.spark.read.schema(schema).parquet(self.path(mark["path"]))
        # The catalog does not carry the descriptions of columns.
        return self.stored(name).select(
            *[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields],
            *([KEYED] if keyed else []),
        )

    # --- full rebuild ------------------------------------------------------------------

    def _new_part(self, name: str) -> str:
        return f"{name}/part={uuid.uuid4().hex}"

    def replace(self, name: str, df: DataFrame, through: str | None = None) -> None:
        path = self._new_part(name)
        df.write.option("compression", "zstd").parquet(self.path(path))
        self.commit(name, df.schema, through, 0, path)

    # --- keyed tables ------------------------------------------------------------------

    def buckets_of(self, name: str) -> int:
        """The buckets that the table's rows lie in, or will if there are none yet."""
        mark = self.build_mark(name)
        return mark["buckets"] if mark else self._expected.get(name, self.settings.buckets)

    def expect(self, name: str, rows: int | None = None, like: str | None = None) -> None:
        """Prepare a table for so many rows, or for the rows that lie in the buckets of another:
        the next build writes it with as many buckets, never with fewer than it has."""
        buckets = max(self.buckets_of(name), self.buckets_of(like) if like else 0)
        while buckets * self.settings.bucket_rows < (rows or 0):
            buckets *= 2
        self._expected[name] = buckets

    def _placed(self, name: str, df: DataFrame, parts: int | None = None) -> DataFrame:
        """Rows brought to the buckets of the table, if they do not lie in buckets already. Null is
        a key like any other."""
        if KEYED in df.columns:
            return df
        key = F.coalesce(F.concat(F.lit("="), F.col(KEY)), F.lit(""))
        return df.withColumn(KEYED, key).repartition(parts or self.buckets_of(name), KEYED)

    def place(self, name: str, df: DataFrame) -> DataFrame:
        """Rows of an increment brought to the buckets of the table, where they can be ranked, merged
        and written without another shuffle. Where nothing is known of a new table's size they are
        sorted in as many tasks as a shuffle has: a partition then holds rows of one bucket only."""
        buckets, parts = self.buckets_of(name), None
        if not self.exists(name) and name not in self._expected:
            shuffled = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            parts = buckets * max(1, -(-shuffled // buckets))
        return self._placed(name, df, parts)

    def _write(self, name: str, placed: DataFrame, through: str | None) -> None:
        """Write rows that are placed already as the table's next state: a file for every bucket that
        a task has rows of, in the order that the rows have."""
        path = self._new_part(name)
        buckets = max(self.buckets_of(name), self._expected.pop(name, 0))
        columns = [c for c in placed.columns if c != KEYED]
        writer = placed.select(*columns, KEYED).write.format("parquet").bucketBy(buckets, KEYED)
        writer = writer.option("compression", "zstd").option("path", self.path(path))
        with held(placed.sparkSession, *WRITERS):
            writer.saveAsTable("caseflow_" + path.rsplit("=", 1)[1])
        self.commit(name, placed.select(*columns).schema, through, buckets, path)

    def rows_of(self, name: str, keys: DataFrame, keyed: bool = False) -> DataFrame:
        """The stored rows of the given keys: the stored side is filtered where it lies. ``keyed``
        keeps the bucketing column."""
        wanted = self._keys(name, keys)
        mine = self.stored(name).join(wanted.hint(self._met(name)), KEYED, "left_semi")
        return mine.select(*self.schema(name).fieldNames(), *([KEYED] if keyed else []))

    def _met(self, name: str) -> str:
        """How the stored rows meet an increment's keys in the buckets, where both stay whatever their
        size: by a hash table of the keys, so that the stored rows need no order. Where the buckets
        have become too few for the increment, by a merge, which can spill."""
        buckets = self.buckets_of(name)
        return "shuffle_hash" if self._expected.get(name, 0) <= 2 * buckets else "merge"

    def _keys(self, name: str, rows: DataFrame) -> DataFrame:
        """The distinct keys of the rows in the buckets of the table."""
        column = KEYED if KEYED in rows.columns else KEY
        return self._placed(name, rows.select(column).distinct()).select(KEYED)

    def create(self, name: str, df: DataFrame, through: str | None) -> None:
        """Write a table anew."""
        self._write(name, self.place(name, df), through)

    def _with_stored(self, name: str, new: DataFrame) -> DataFrame:
        """Stored and new rows side by side in their buckets."""
        return self.stored(name).unionByName(self._placed(name, new), allowMissingColumns=True)

    def _described(self, name: str, new: DataFrame, merged: DataFrame) -> DataFrame:
        """Column descriptions: the new rows' where they have the column, else the stored ones."""
        notes = {f.name: f.metadata for f in [*self.schema(name).fields, *new.schema.fields]}
        return merged.select(*[F.col(c).alias(c, metadata=notes.get(c, {})) for c in merged.columns])

    def upsert(
        self, name: str, new: DataFrame, keys: Sequence[str], order: Sequence[str], through: str | None
    ) -> None:
        """Merge ``new`` by key, the newest version by ``order`` winning.

        Columns the table lacks are appended; old rows read them as null.
        """
        if not self.exists(name):
            return self.create(name, new, through)
        others = [k for k in keys if k != KEY]
        merged = latest_per_key(self._with_stored(name, new), [KEYED, *others], order)
        self._write(name, self._described(name, new, merged), through)

    def replace_keys(
        self, name: str, new: DataFrame, touched: DataFrame, through: str | None
    ) -> None:
        """Replace all rows of the touched keys by ``new``."""
        if not self.exists(name):
            return self.create(name, new, through)
        gone = self._keys(name, touched)
        kept = self.stored(name).join(gone.hint(self._met(name)), KEYED, "left_anti")
        merged = kept.unionByName(self._placed(name, new), allowMissingColumns=True)
        self._write(name, self._described(name, new, merged), through)

    def append_unseen(
        self, name: str, new: DataFrame, keys: Sequence[str], through: str | None
    ) -> None:
        """Add the rows whose key the table lacks. Of rows of one key the one landed first stays,
        so a row that comes again changes nothing."""
        if not self.exists(name):
            return self.create(name, new, through)
        others = [k for k in keys if k != KEY]
        rest = [c for c in new.columns if c not in {*keys, INGESTED}]
        order = [F.col(c).asc_nulls_last() for c in [*([INGESTED] if INGESTED in new.columns else []), *rest]]
        merged = first_by(self._with_stored(name, new), [KEYED, *others], order)
        self._write(name, self._described(name, new, merged), through)
