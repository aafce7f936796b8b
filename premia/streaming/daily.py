"""Daily loads started by arriving files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from premia.plans.daily_load import load_folder
from premia.sources.files import batch_day, day_of, scan_archives, source_name
from premia.sources.tables import Warehouse


def load_arriving_days(
    spark: SparkSession,
    folder: str,
    root: str,
    checkpoint: str,
    as_of: Callable[[int], dt.date],
    ingested_at: dt.datetime,
) -> StreamingQuery:
    """Load whatever daily files arrived since the last run, then stop.

    The stream carries file names only and says which days have news. From the first of these days on, all
    days up to the last known one are loaded from their whole files: files of a day may arrive in several
    triggers, days may arrive out of order, and a trigger may be repeated after a failure, with the same
    tables in the end. Of an archive the days of its members count; one row per archive reaches the driver.
    """

    def load(arrived: DataFrame, _batch: int) -> None:
        seen = arrived.groupBy("day").agg(F.collect_set("archive").alias("archives")).collect()  # one row per day
        news = {r["day"] for r in seen if r["day"] is not None}
        members = None  # of all archives, inflated once to be checked, for the load too
        if zipped := {a for r in seen for a in r["archives"]}:
            members = scan_archives(spark, folder)
            fresh = [m.name for m in members if m.path in zipped and m.name and "_day" in m.name]
            news |= {d for name in fresh if (d := day_of(name)) is not None}
        if news:
            known = Warehouse(spark, root).finished()
            days = sorted({*news, *(d for d in known if d > min(news))})
            load_folder(spark, folder, root, as_of, ingested_at, days, members=members)

    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .load(f"{folder.rstrip('/')}/{{*_day*.csv,*.zip}}")
        .select(
            batch_day(source_name(F.col("path"))).alias("day"),
            F.when(F.col("path").endswith(".zip"), F.col("path")).alias("archive"),
        )
        .filter("day is not null or archive is not null")
    )
    return (
        names.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
