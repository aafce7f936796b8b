"""Tables: SQL and JDBC reads, loads, counts, previews and the warehouse folder."""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from premia.operators.relational import union_outer
from premia.schemas import FEED, TABLES

log = logging.getLogger(__name__)

_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}
JDBC_BATCH_ROWS = 1000


def read_query(spark: SparkSession, query: str, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """A query on registered tables, or on a database whose url and credentials come as reader options."""
    if jdbc is None:
        return spark.sql(query)
    return spark.read.format("jdbc").options(**{**jdbc, "query": query}).load()


def read_table(spark: SparkSession, name: str, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """A whole table. For a parallel JDBC read give partitionColumn, lowerBound, upperBound, numPartitions."""
    if jdbc is None:
        return spark.table(name)
    return spark.read.format("jdbc").options(**{**jdbc, "dbtable": name}).load()


def load_table(
    df: DataFrame,
    target: str,
    if_exists: str = "append",
    jdbc: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Write to a Parquet folder (a target with a slash), a table, or a database table.

    An empty frame must not replace or create a table, which is checked in those modes; to append it changes
    nothing, and the check would compute part of the frame twice.
    """
    mode = _MODES[if_exists]
    if mode != "append" and df.isEmpty():
        log.warning("nothing to load into %s", target)
        return
    writer = df.write.mode(mode)
    if jdbc is not None:
        writer.format("jdbc").options(**{"batchsize": str(JDBC_BATCH_ROWS), **jdbc, "dbtable": target}).save()
        return
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def named_tables(spark: SparkSession, names: Sequence[str]) -> dict[str, DataFrame | None]:
    """Registered tables by name; None for one that cannot be read."""
    found: dict[str, DataFrame | None] = {}
    for name in names:
        try:
            found[name] = spark.table(name)
        except AnalysisException as error:
            log.error("no table %s: %s", name, error)
            found[name] = None
    return found


def table_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """``(table_name, rows)`` for all tables; one that cannot be read is None and reports no count."""
    counts = [
        spark.range(1).select(F.lit(name).alias("table_name"), F.lit(None).cast("bigint").alias("rows"))
        if df is None
        else df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return union_outer(counts)


def preview(df: DataFrame, order_by: Sequence[str], limit: int = 5) -> DataFrame:
    """The first rows by the given columns."""
    return df.orderBy(*order_by).limit(limit)


class ConcurrentLoad(RuntimeError):
    """Another load was logged meanwhile whose tables this one should have built on."""


class Warehouse:
    """A folder with one sub-folder per table and parts ``batch_day=N/attempt=K`` in it.

    Every load of a day writes an attempt of its own, and the ``loads`` log names the attempt that counts. Readers see
    the parts of logged attempts, so a load or a reload that is cut off leaves the tables as they were, and a repeated
    one leaves no doubles. Logging a day again takes back all later days, which are then loaded anew. :meth:`clean`
    removes the parts that no longer count.

    The log has one file per load, named by its number. A load reads the log as it begins and works on that state. To end
    it writes the next number, which succeeds only if no one else has; else it looks at what was logged meanwhile. Later
    days are no obstacle, as logging an earlier day takes them back, and it tries the next number. The same or an earlier
    day is: the load fails with :class:`ConcurrentLoad` and its attempt does not count.

    Parts are never rewritten by later days. A customer batch writes the rows it expired next to all rows
    current after it, in parts by ``current_flag``; the customer table is the expired rows of all days plus the
    current rows of the last one.
    """

    LOG = "loads"
    LOG_SCHEMA = "seq int, batch_day int, as_of date, attempt string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._open: dict[int, str] = {}
        self._seen: list | None = None

    def _scan(self, folder: str, schema: T.StructType | str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _entries(self) -> list:
        """The log, a row per load, in order; during a load as it was at its begin."""
        if self._seen is not None:
            return self._seen
        try:
            return sorted(self.spark.read.schema(self.LOG_SCHEMA).json(f"{self.root}/{self.LOG}/*.json").collect())
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _logged(self) -> dict[int, str]:
        """Attempts by day, of the days with a finished load."""
        days: dict[int, str] = {}
        for row in self._entries():
            days = {**{d: a for d, a in days.items() if d < row["batch_day"]}, row["batch_day"]: row["attempt"]}
        return days

    def finished(self, before: int | None = None) -> list[int]:
        """Days with a finished load, ascending."""
        return [d for d in sorted(self._logged()) if before is None or d < before]

    def begin(self, day: int) -> None:
        """Start a load of a day; what is written for it stays out of sight until :meth:`finish`."""
        self._seen = None
        self._seen = self._entries()
        self._open = {day: f"a{uuid.uuid4().hex}"}

    def abandon(self) -> None:
        """End a load without logging it."""
        self._open, self._seen = {}, None

    def finish(self, day: int, as_of: dt.date) -> None:
        base, attempt = self._seen or [], self._open[day]
        self.abandon()
        while True:
            now = self._entries()
            meanwhile = [r for r in now if r not in base]
            if stale := [r["batch_day"] for r in meanwhile if r["batch_day"] <= day]:
                raise ConcurrentLoad(f"day {day} was built without the load of day {stale[-1]} that was logged meanwhile")
            seq = max((r["seq"] for r in now), default=0) + 1
            entry = {"seq": seq, "batch_day": day, "as_of": as_of.isoformat(), "attempt": attempt}
            if self._create(f"{self.LOG}/{seq:08d}.json", json.dumps(entry)):
                return

    def _create(self, name: str, text: str) -> bool:
        """Put a file with all of its text in place unless there is one of that name."""
        hadoop, conf = self.spark._jvm.org.apache.hadoop.fs, self.spark._jsparkSession.sessionState().newHadoopConf()
        target = hadoop.Path(f"{self.root}/{name}")
        draft = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
        files = target.getFileSystem(conf)
        out = files.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        how = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        how[0] = hadoop.Options.Rename.NONE  # a file of that name is not replaced
        try:
            hadoop.FileContext.getFileContext(files.getUri(), conf).rename(draft, target, how)
            return True
        except Py4JJavaError as error:
            if not error.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
                raise
            return False
        finally:
            files.delete(draft, False)

    def write(self, table: str, df: DataFrame, day: int) -> None:
        writer = df.write.mode("overwrite")
        if table == "dim_customer":
            writer = writer.partitionBy("current_flag")
        writer.parquet(f"{self.root}/{table}/batch_day={day}/attempt={self._open[day]}")

    def read(self, table: str, days: Sequence[int] | None = None) -> DataFrame:
        """A table after the given days, by default all finished ones; without rows if never written.

        A day whose load is under way is read from what that load has written, if it is among the given days.
        """
        schema = FEED if table == "feed" else TABLES[table]
        logged = self._logged()
        days = sorted(logged) if days is None else list(days)
        attempts = [a for a in ({**logged, **self._open}.get(d) for d in days) if a] if days else []
        parts = [T.StructField("batch_day", T.IntegerType()), T.StructField("attempt", T.StringType())]
        rows = self._scan(table, T.StructType([*schema.fields, *parts]))
        rows = rows.filter(F.col("batch_day").isin(days) & F.col("attempt").isin(attempts))
        if table == "dim_customer":
            rows = rows.filter((F.col("current_flag") == 0) | (F.col("batch_day") == F.lit(max(days, default=None))))
        return rows.select(*schema.names)

    def current_customers(self, days: Sequence[int]) -> DataFrame:
        """The current customer versions after the given days: one part of the table."""
        return self.read("dim_customer", days).filter("current_flag = 1")

    def clean(self) -> list[str]:
        """Delete the parts of attempts that do not count; their paths. Not while a load is under way elsewhere."""
        keep = {*self._logged().values(), *self._open.values()}
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(conf)
        parts = [f.getPath() for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/*/batch_day=*/attempt=*"))]
        gone = [p for p in parts if p.getName().partition("=")[2] not in keep]
        for path in gone:
            fs.delete(path, True)
        return sorted(p.toString() for p in gone)
