"""Standardization of raw feeds. Absent columns are passed over, as feeds differ by region and day."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from premia.functions import (
    USA_SPELLINGS,
    blank_to_null,
    canonical_value,
    country_name,
    id_text,
    parse_date,
    parse_money,
    postal_text,
    strip_space,
)
from premia.functions.dates import DATE_ORDERS, FEED_DATE_FORMATS
from premia.schemas import DATE_COLUMNS, FEED_RENAMES, ID_COLUMNS, MONEY_COLUMNS


def snake_case(name: str) -> str:
    return re.sub(r"[^a-zA-Z0-9]+", "_", name.strip()).strip("_").lower()


def _present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def _replace(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(exprs)) if exprs else df


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to snake case; of columns that then share a name the first one stays.

    Use it per file, before files are put together: header case drifts from day to day.
    """
    names = [snake_case(c) for c in df.columns]
    positional = df.toDF(*[f"c{i}" for i in range(len(names))])
    return positional.select([F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in names[:i]])


def rename_columns(df: DataFrame, renames: Mapping[str, str] = FEED_RENAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(renames))


def blank_cells(df: DataFrame) -> DataFrame:
    """Make cells that spell a missing value null, in every text column."""
    return _replace(df, {c: blank_to_null(F.col(c)) for c in _text_columns(df)})


def normalize_ids(df: DataFrame, cols: Sequence[str] = ID_COLUMNS) -> DataFrame:
    return _replace(df, {c: id_text(F.col(c)) for c in _present(df, cols)})


def normalize_postal(df: DataFrame, col: str = "postal_code") -> DataFrame:
    return _replace(df, {c: postal_text(F.col(c)) for c in _present(df, [col])})


def trim_strings(df: DataFrame) -> DataFrame:
    return _replace(df, {c: strip_space(F.col(c)) for c in _text_columns(df)})


def clean_country(df: DataFrame, col: str = "country", spellings: Sequence[str] = USA_SPELLINGS) -> DataFrame:
    return _replace(df, {c: country_name(F.col(c), spellings) for c in _present(df, [col])})


def parse_dates(
    df: DataFrame, cols: Sequence[str] = DATE_COLUMNS, formats: str | Sequence[str] = FEED_DATE_FORMATS
) -> DataFrame:
    texts = _text_columns(df)
    return _replace(
        df, {c: parse_date(F.col(c), formats) if c in texts else F.col(c).cast("date") for c in _present(df, cols)}
    )


def date_orders(df: DataFrame, cols: Sequence[str] = DATE_COLUMNS, by: str = "source_file") -> DataFrame:
    """``(by, column_name, date_order, fits, other_fits, ambiguous)``: how each file orders day and month in each column.

    Both orders compete over all cells of a column in a file; the one that reads more of them wins, month first if they
    draw. ``ambiguous`` cells are dates in either order, but not the same ones. One pass, summed up within each task.
    """
    texts = [c for c in _present(df, cols) if c in _text_columns(df)]
    if not texts:
        return df.sparkSession.createDataFrame(
            [], f"{by} string, column_name string, date_order string, fits bigint, other_fits bigint, ambiguous bigint"
        )
    month, day = ({c: parse_date(F.col(c), DATE_ORDERS[o]) for c in texts} for o in ("month first", "day first"))
    counts = df.groupBy(by).agg(
        *[
            F.struct(F.count(month[c]).alias("m"), F.count(day[c]).alias("d"), F.count_if(month[c] != day[c]).alias("ambiguous")).alias(f"c{i}")
            for i, c in enumerate(texts)
        ]
    )
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n")) for i, c in enumerate(texts)]))
    n, day_first = F.col("n"), F.col("n.d") > F.col("n.m")
    return counts.select(by, cells).select(
        by,
        "column_name",
        F.when(day_first, "day first").otherwise("month first").alias("date_order"),
        F.greatest(n["m"], n["d"]).alias("fits"),
        F.least(n["m"], n["d"]).alias("other_fits"),
        n["ambiguous"].alias("ambiguous"),
    )


def parse_dates_in_order(df: DataFrame, orders: DataFrame, cols: Sequence[str] = DATE_COLUMNS, by: str = "source_file") -> DataFrame:
    """Parse dates with one order of day and month per file and column, as :func:`date_orders` found it.

    The orders have a row per file once they are joined, and no cell is read in another order than its column.
    """
    texts = [c for c in _present(df, cols) if c in _text_columns(df)]
    found = orders.groupBy(F.col(by).alias("_by")).agg(
        F.collect_set(F.when(F.col("date_order") == "day first", F.col("column_name"))).alias("_day_first")
    )
    joined = df.join(found, F.col(by).eqNullSafe(F.col("_by")), "left")
    read = {
        c: F.when(F.array_contains("_day_first", c), parse_date(F.col(c), DATE_ORDERS["day first"])).otherwise(
            parse_date(F.col(c), DATE_ORDERS["month first"])
        )
        if c in texts
        else F.col(c).cast("date")
        for c in _present(df, cols)
    }
    return _replace(joined, read).drop("_by", "_day_first")


def clean_currency(df: DataFrame, cols: Sequence[str] = MONEY_COLUMNS) -> DataFrame:
    return _replace(df, {c: parse_money(F.col(c)) for c in _present(df, cols)})


def map_values(df: DataFrame, spellings: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Bring columns to canonical values: ``{column: {canonical: [lower-case spellings]}}``."""
    return _replace(df, {c: canonical_value(F.col(c), spellings[c]) for c in _present(df, spellings)})


def region_of_state(df: DataFrame, lookup: DataFrame, state: str = "state_province", region: str = "region") -> DataFrame:
    """Fill in the region from a ``(state, region)`` lookup with one row per state; unknown states get null."""
    pairs = lookup.select(F.col(state).alias("_state"), F.col(region).alias("_region"))
    joined = df.join(pairs, df[state] == pairs["_state"], "left")
    return joined.withColumn(region, F.col("_region")).drop("_state", "_region")


def add_feed_defaults(df: DataFrame, ingested_at: Column) -> DataFrame:
    """Lineage columns and the copies that staging tables name differently."""
    copies = {
        "txn_date": "actual_premium_paid_dt",
        "premium_amount": "premium_amt",
        "premium_paid_tilldate": "premium_amt_paid_tilldate",
    }
    exprs = {new: F.col(old) for new, old in copies.items() if old in df.columns}
    exprs["ingestion_date"] = ingested_at
    if "source_file" not in df.columns:
        exprs["source_file"] = F.lit("unknown")
    return df.withColumns(exprs)


def project_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns and types of a schema; absent columns become null."""
    have = set(df.columns)
    return df.select(
        [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
