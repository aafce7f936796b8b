"""Dimension builds from the cleaned feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from premia.functions import date_key
from premia.operators.links import address_key, policy_key
from premia.operators.relational import keep_first, same_keys
from premia.operators.standardize import project_to
from premia.schemas import TABLES


def only_absent(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a batch whose keys the dimension does not hold yet; null keys count as equal."""
    known = existing.select(*keys)
    return new.join(known, same_keys(new, known, keys, keys), "left_anti")


def policy_types(feed: DataFrame) -> DataFrame:
    cols = ["policy_type_id", "policy_type_name", "policy_type_desc"]
    return keep_first(feed.select(*cols, "source_file"), ["policy_type_id"], ["source_file"]).select(cols)


def policies(feed: DataFrame, created_at: Column) -> DataFrame:
    """One row per policy id, type and start date."""
    keys = ["policy_id", "policy_type", "policy_start_dt"]
    rest = ["policy_name", "policy_type_id", "policy_term", "policy_end_dt", "total_policy_amt"]
    named = feed.withColumn("policy_type", F.col("policy_type_name"))
    first = keep_first(named.select(*keys, *rest, "source_file"), keys, ["source_file"])
    full = first.withColumns({"policy_sk": policy_key(*[F.col(k) for k in keys]), "created_at": created_at})
    return project_to(full, TABLES["dim_policy"])


def addresses(feed: DataFrame, created_at: Column) -> DataFrame:
    """One row per customer and postal code."""
    keys = ["customer_id", "postal_code"]
    rest = ["country", "region", "state_province", "city"]
    first = keep_first(feed.select(*keys, *rest, "source_file"), keys, ["source_file"])
    full = first.withColumns({"address_sk": address_key(*[F.col(k) for k in keys]), "created_at": created_at})
    return project_to(full, TABLES["dim_address"])


def customers(feed: DataFrame) -> DataFrame:
    """One row per customer of a batch, as the customer history takes it in."""
    cols = [
        "customer_id", "customer_name", "customer_segment", "marital_status", "gender", "region",
        "effective_start_dt", "dob",
    ]
    return keep_first(feed.select(*cols, "source_file"), ["customer_id"], ["source_file"]).select(cols)


def calendar(days: DataFrame, col: str) -> DataFrame:
    """The date dimension from the first to the last day of a date column."""
    ends = days.agg(F.min(col).alias("a"), F.max(col).alias("b")).filter("a is not null")
    dt = ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("dt"))
    parts = {"year": F.year("dt"), "month": F.month("dt"), "day": F.dayofmonth("dt"), "quarter": F.quarter("dt")}
    return project_to(dt.withColumns({"date_sk": date_key(F.col("dt")), **parts}), TABLES["dim_date"])
