"""Links from transactions to dimension rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from premia.functions import hash_key
from premia.functions.money import RATE_PER_MONTH
from premia.schemas import TABLES


def link_customer_version(facts: DataFrame, dim_customer: DataFrame, closed: str = "both") -> DataFrame:
    """Add the key of the customer version valid at ``txn_date``; rows without one are dropped.

    With ``closed='both'`` a transaction on the day of a change meets both versions, with ``'left'`` only the
    newer. An equi-join with the range as a further condition: a customer has at most one version per load,
    so a hot customer is hot on the transaction side only, where adaptive execution splits it.
    """
    if closed not in ("both", "left"):
        raise ValueError(f"closed {closed!r}: use 'both' or 'left'")
    v = dim_customer.select(
        F.col("customer_id").alias("_id"), "customer_sk", F.col("eff_start_dt").alias("_from"), F.col("eff_end_dt").alias("_to")
    )
    end = F.coalesce(v["_to"], F.lit(dt.date(9999, 12, 31)))
    before_end = facts["txn_date"] <= end if closed == "both" else facts["txn_date"] < end
    on = (facts["customer_id"] == v["_id"]) & (facts["txn_date"] >= v["_from"]) & before_end
    return facts.join(v, on, "inner").drop("_id", "_from", "_to")


def link_policy(facts: DataFrame, dim_policy: DataFrame) -> DataFrame:
    """Add ``policy_sk`` by policy id alone: a row comes out once per version of its policy."""
    return facts.join(dim_policy.select("policy_id", "policy_sk"), "policy_id", "left")


def link_policy_version(facts: DataFrame, dim_policy: DataFrame) -> DataFrame:
    """Add ``policy_sk`` of the latest version started by ``txn_date``, else of the earliest version.

    The version is looked up once per policy and day that occur, not once per row. So the window below holds
    at most two rows per day of the calendar for a policy, however many transactions it has, and the join back
    is on policy and day, which spreads a hot policy over its days.
    """
    asked = facts.select("policy_id", F.col("txn_date").alias("_day")).distinct()
    versions = dim_policy.groupBy("policy_id", F.col("policy_start_dt").alias("_day")).agg(
        F.min(F.struct("policy_type", "policy_sk"))["policy_sk"].alias("_sk")
    )
    sk_type = dim_policy.schema["policy_sk"].dataType
    timeline = asked.select("*", F.lit(None).cast(sk_type).alias("_sk"), F.lit(1).alias("_asked")).unionByName(
        versions.withColumn("_asked", F.lit(0))
    )
    by_day = Window.partitionBy("policy_id").orderBy("_day", "_asked")
    # The whole partition: a frame from the current row on would be computed anew for every row.
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = F.coalesce(F.last("_sk", ignorenulls=True).over(by_day), F.first("_sk", ignorenulls=True).over(whole))
    links = timeline.withColumn("policy_sk", found).filter("_asked = 1")
    links = links.select(F.col("policy_id").alias("_policy"), "_day", "policy_sk")
    on = facts["policy_id"].eqNullSafe(links["_policy"]) & facts["txn_date"].eqNullSafe(links["_day"])
    return facts.join(links, on, "left").drop("_policy", "_day")


def link_address(facts: DataFrame, dim_address: DataFrame) -> DataFrame:
    """Add ``address_sk`` by customer and postal code, or by customer alone if the feed has no postal code.

    Addresses are a multiple of the customers, which Spark's size check does not see if they are derived from them, and would
    be broadcast whole to every task. So both sides are sorted; adaptive execution splits a hot customer's transactions.
    """
    keys = ["customer_id", "postal_code"] if "postal_code" in facts.columns else ["customer_id"]
    return facts.join(dim_address.select(*keys, "address_sk").hint("merge"), keys, "left")


def late_fee_bands(spark, created_at: Column | None = None, max_months: int = 60) -> DataFrame:
    """The penalty table: one row per month of delay."""
    months = F.col("id").cast("int")
    return spark.range(max_months + 1).select(
        months.alias("late_fee_sk"),
        months.alias("duration_months"),
        (months * F.lit(RATE_PER_MONTH)).cast(TABLES["dim_late_fee"]["penalty_percent"].dataType).alias("penalty_percent"),
        F.concat(months.cast("string"), F.lit(" Months Delay")).alias("description"),
        (F.lit(None) if created_at is None else created_at).cast("timestamp").alias("created_at"),
    )


def link_late_fee(facts: DataFrame, bands: DataFrame) -> DataFrame:
    """Add ``late_fee_sk`` by months of delay; early payers and delays beyond the table get null."""
    b = bands.select(F.col("duration_months").alias("_months"), "late_fee_sk")
    return facts.join(b, facts["late_duration_months"] == b["_months"], "left").drop("_months")


def left_join_nullable(left: DataFrame, right: DataFrame, fk: str, key: str) -> DataFrame:
    """Left join where many foreign keys may be null.

    Null keys match nothing but would all hash to one task. A second join column is 0 on the right and, for null
    keys, a positive hash of the row, which spreads them over all tasks without giving them a match.
    """
    other = [c for c in left.columns if c != fk]
    spread_null = F.shiftrightunsigned(F.xxhash64(*other), 1).bitwiseOR(F.lit(1)) if other else F.lit(1)
    lhs = left.withColumn("_spread", F.when(F.col(fk).isNull(), spread_null).otherwise(F.lit(0)).cast("bigint"))
    # Not a literal: the optimizer would fold a constant out of the join keys.
    rhs = right.withColumn("_zero", F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("bigint"))
    on = (lhs[fk] == rhs[key]) & (lhs["_spread"] == rhs["_zero"])
    return lhs.join(rhs, on, "left").drop("_spread", "_zero")


def policy_key(policy_id: Column, policy_type: Column, start: Column) -> Column:
    return hash_key(policy_id, policy_type, start)


def address_key(customer_id: Column, postal_code: Column) -> Column:
    return hash_key(customer_id, postal_code)
