"""The daily load: feed to staging, dimensions and fact, one batch per day."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter
from types import MappingProxyType

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from premia.functions import blank_to_null, parse_date
from premia.functions.dates import DATE_ORDERS, FEED_DATE_FORMATS
from premia.operators.history import apply_customer_batch
from premia.operators.links import late_fee_bands
from premia.operators.policies import calculate_late_fees, construct_customer_name
from premia.operators.quality import has_any, positive, required
from premia.operators.relational import marked_keys, split_dataframe, touched_rows
from premia.operators.standardize import (
    add_feed_defaults,
    clean_country,
    clean_currency,
    date_orders,
    map_values,
    normalize_ids,
    normalize_postal,
    parse_dates,
    parse_dates_in_order,
    project_to,
    region_of_state,
    rename_columns,
    standardize_columns,
    trim_strings,
)
from premia.plans.dimensions import addresses, calendar, customers, only_absent, policies, policy_types
from premia.plans.fact import build_fact
from premia.schemas import DATE_COLUMNS, FEED, FEED_COLUMNS, FEED_SPELLINGS, MONEY_COLUMNS, TABLES
from premia.sources.files import Member, day_of, find_days, read_day, read_folder, rejected_files, scan_archives
from premia.sources.tables import Warehouse

log = logging.getLogger(__name__)

STAGING = ("stg_customers", "stg_policy", "stg_address", "stg_transactions")


Formats = Sequence[str] | None
Spellings = Mapping[str, Mapping[str, Sequence[str]]]


def _cleaned(
    raw: DataFrame, ingested_at: Column, date_formats: Formats, spellings: Spellings, regions: DataFrame | None
) -> tuple[DataFrame, list[str]]:
    """The cleaned feed before it is cut to its columns, and the date columns whose text it keeps as ``_text_<name>``."""
    df = standardize_columns(raw)
    if not has_any(df, "premium_amt", "premium_amount"):
        log.warning("the feed has no premium column and gets no late fees")
    df = construct_customer_name(df)
    df = map_values(trim_strings(normalize_ids(rename_columns(df))), spellings)
    if regions is not None:
        df = region_of_state(df, regions)
    df = normalize_postal(clean_country(df))
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    dates = [c for c in DATE_COLUMNS if c in texts]
    df = df.withColumns({f"_text_{c}": blank_to_null(F.col(c)) for c in dates})
    df = parse_dates(df, formats=date_formats) if date_formats else parse_dates_in_order(df, date_orders(df))
    df = calculate_late_fees(clean_currency(df))
    return add_feed_defaults(df, ingested_at), dates


def clean_feed(
    raw: DataFrame,
    ingested_at: Column,
    date_formats: Formats = FEED_DATE_FORMATS,
    spellings: Spellings = FEED_SPELLINGS,
    regions: DataFrame | None = None,
) -> DataFrame:
    """A raw feed of text columns to the cleaned feed.

    Dates are read by the first format that fits, or, if ``date_formats`` is None, in the order of day and month that reads
    most of a file's column, which takes a pass of its own. ``spellings`` bring columns to canonical values, ``regions``
    (state_province, region) fill in the region.
    """
    return project_to(_cleaned(raw, ingested_at, date_formats, spellings, regions)[0], FEED)


def feed_rules() -> dict[str, Column]:
    """What every row of a feed should meet. Rows that do not are loaded and counted."""
    return {**required("customer_id", "policy_id"), **positive(*(c for c in MONEY_COLUMNS if c in FEED.names))}


def staging_rows(feed: DataFrame, table: str) -> DataFrame:
    """The columns of a staging table, without duplicate rows."""
    named = feed.withColumn("policy_type", F.col("policy_type_name"))
    return split_dataframe(named, TABLES[table].names)


class _Counts:
    """Counts that the write of a frame takes along, without a pass of their own."""

    def __init__(self, wanted: Mapping[tuple[str, str, str], Column] = MappingProxyType({})):
        self.wanted, self.observation = dict(wanted), Observation()

    def on(self, df: DataFrame) -> DataFrame:
        """Observe the frame. To be right the write must not shuffle it any more."""
        counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"n{i}") for i, c in enumerate(self.wanted.values())]
        return df.observe(self.observation, F.count(F.lit(1)).alias("rows"), *counts)

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]

    def found(self) -> list[tuple[str, str, str, int]]:
        """(kind, item, reason, rows) of what occurred."""
        seen = self.observation.get
        return [(*key, seen[f"n{i}"]) for i, key in enumerate(self.wanted) if seen[f"n{i}"]]


def _checks(dates: Sequence[str], in_order: bool, rules: Mapping[str, Column]) -> dict[tuple[str, str, str], Column]:
    checks = {}
    for c in dates:
        text = F.col(f"_text_{c}")
        checks["cell", c, "no date in the given formats"] = text.isNotNull() & F.col(c).isNull()
        if in_order:
            month, day = (parse_date(text, DATE_ORDERS[o]) for o in ("month first", "day first"))
            checks["cell", c, "day and month could be swapped"] = month != day
    for rule, ok in rules.items():
        checks["rule", rule, "failed"] = ~F.coalesce(ok, F.lit(False))
    return checks


def _all_of(spark: SparkSession, jobs: Mapping[str, Callable[[], None]], after: Mapping[str, Sequence[str]]) -> None:
    """Run jobs that do not wait for each other at once, each in a pool of its own; the first error stops the rest.

    Jobs share the cluster evenly if it runs with ``spark.scheduler.mode=FAIR``, else in the order they come.
    """

    def run(name: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        jobs[name]()

    order = TopologicalSorter({name: after.get(name, ()) for name in jobs})
    order.prepare()
    with ThreadPoolExecutor(len(jobs)) as threads:
        running = {}
        while order.is_active():
            for name in order.get_ready():
                running[threads.submit(inheritable_thread_target(spark)(run), name)] = name
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                done.result()
                order.done(name)


def load_day(
    warehouse: Warehouse,
    raw: DataFrame,
    day: int,
    as_of: dt.date,
    ingested_at: dt.datetime,
    date_formats: Formats = FEED_DATE_FORMATS,
    rejected: Sequence[tuple[str, str]] = (),
    spellings: Spellings = FEED_SPELLINGS,
    regions: DataFrame | None = None,
    rules: Callable[[], Mapping[str, Column]] = feed_rules,
) -> bool:
    """Load one batch; False if it has no rows. Repeating a day gives the same tables.

    The raw rows are read once: the cleaned feed is written, its cells and rows checked by that same write, and everything
    else reads the columns it needs from there. Tables that do not wait for each other are written at the same time, the
    fact after the dimensions that it links to. Of dimensions that grow from day to day only the rows whose keys the batch may
    hold are shuffled, see :func:`touched_rows`.

    What the load leaves out or warns of goes to ``rejects``: the files given as ``rejected``, columns that no feed has,
    cells that are no dates, rows that fail a rule (they are loaded all the same), and feed rows without a customer version
    on their day, which get no fact.
    """
    spark, now = warehouse.spark, F.lit(ingested_at)
    earlier = warehouse.finished(before=day)
    after = [*earlier, day]

    warehouse.begin(day)
    cleaned, dates = _cleaned(raw, now, date_formats, spellings, regions)
    checked = _Counts(_checks(dates, date_formats is None, rules()))
    with_texts = T.StructType([*FEED, *(T.StructField(f"_text_{c}", T.StringType()) for c in dates)])
    warehouse.write("feed", checked.on(project_to(cleaned, with_texts)).select(*FEED.names), day)
    if not checked.rows:
        warehouse.abandon()
        return False
    feed = warehouse.read("feed", [day])

    def written(table: str, rows: Callable[[], DataFrame]) -> Callable[[], None]:
        return lambda: warehouse.write(table, rows(), day)

    def touched(table: str, days: Sequence[int], key: str) -> DataFrame:
        """The rows of a dimension that the batch can meet, so that the rest of it is never shuffled."""
        return touched_rows(warehouse.read(table, days), [key], marked_keys(feed, [key])) if days else warehouse.read(table, days)

    def grown(table: str, rows: DataFrame, *keys: str) -> Callable[[], None]:
        known = lambda: touched(table, earlier, keys[0]) if keys[0] in feed.columns else warehouse.read(table, earlier)
        return written(table, lambda: only_absent(rows, known(), keys))

    linked = _Counts()

    def fact() -> DataFrame:
        dimensions = touched("dim_customer", after, "customer_id"), touched("dim_policy", after, "policy_id")
        return linked.on(build_fact(feed, *dimensions, None, warehouse.read("dim_late_fee", after)))

    jobs = {
        **{t: written(t, lambda t=t: staging_rows(feed, t)) for t in STAGING},
        "dim_customer": written(
            "dim_customer", lambda: apply_customer_batch(warehouse.current_customers(earlier), customers(feed), as_of, now)
        ),
        "dim_policy_type": grown("dim_policy_type", policy_types(feed), "policy_type_id"),
        "dim_policy": grown("dim_policy", policies(feed, now), "policy_id", "policy_type", "policy_start_dt"),
        "dim_address": grown("dim_address", addresses(feed, now), "customer_id", "postal_code"),
        "dim_date": grown("dim_date", calendar(feed, "txn_date"), "dt"),
        "dim_late_fee": grown("dim_late_fee", late_fee_bands(spark, now), "duration_months"),
        "fact_policy_txn": written("fact_policy_txn", fact),
    }
    _all_of(spark, jobs, {"fact_policy_txn": ["dim_customer", "dim_policy", "dim_late_fee"]})

    listed = [("file", file, reason, None) for file, reason in rejected] + unknown_columns(raw) + checked.found()
    if without_fact := checked.rows - linked.rows:
        listed.append(("row", "fact_policy_txn", "no customer version on the day", without_fact))
    for kind, item, reason, n in listed:
        log.warning("day %s: %s %s: %s (%s)", day, kind, item, reason, n)
    warehouse.write("rejects", spark.createDataFrame(listed, TABLES["rejects"]), day)
    log.info("day %s: %s feed rows, %s facts", day, checked.rows, linked.rows)
    warehouse.finish(day, as_of)
    return True


def unknown_columns(raw: DataFrame) -> list[tuple[str, str, str, None]]:
    """``rejects`` rows: columns that no feed has."""
    known = {*FEED_COLUMNS, "source_file", "txn_date", "premium_amount", "premium_paid_tilldate", "payment_amount"}
    names = rename_columns(standardize_columns(raw)).columns
    return [("column", c, "no column of the feed", None) for c in names if c not in known]


def load_folder(
    spark: SparkSession,
    folder: str,
    root: str,
    as_of: Callable[[int], dt.date],
    ingested_at: dt.datetime,
    days: list[int] | None = None,
    date_formats: Formats = FEED_DATE_FORMATS,
    on_damage: str = "skip",
    spellings: Spellings = FEED_SPELLINGS,
    regions: DataFrame | None = None,
    rules: Callable[[], Mapping[str, Column]] = feed_rules,
    members: Sequence[Member] | None = None,
    **options,
) -> Warehouse:
    """Load the daily files of a folder in the order of their days; without daily files, all files as day 0.

    Options go to the reader. ``members`` are those of the folder's archives if they were scanned before. Damaged files in archives are left out whole and listed in ``rejects``, or stop the load
    with ``on_damage='fail'``.

    ``as_of`` gives the date on which the changes of a day take effect. The order matters, since every day
    builds on the customer versions of the day before.
    """
    warehouse = Warehouse(spark, root)
    members = scan_archives(spark, folder, **options) if members is None else members
    found = find_days(spark, folder, members)
    if found:
        wanted = [d for d in found if days is None or d in days]
    else:
        wanted = [0]
    for day in wanted:
        how = {"members": members, "on_damage": on_damage, **options}
        raw = read_day(spark, folder, day, **how) if found else read_folder(spark, folder, **how)
        mine = [m for m in members if not found or m.name is None or day_of(m.name) == day]
        cleaning = {"spellings": spellings, "regions": regions, "rules": rules}
        if raw is None or not load_day(warehouse, raw, day, as_of(day), ingested_at, date_formats, rejected_files(mine), **cleaning):
            log.warning("no rows for day %s", day)
    return warehouse
