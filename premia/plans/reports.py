"""Reports on the warehouse.

A report with a condition applies it to the dimensions and joins the fact with what is left; one without groups the
fact by the keys it needs before any join. So a customer or policy with a great share of all transactions is down to few
rows before it is shuffled on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from premia.functions import date_of_key, in_year
from premia.operators.links import left_join_nullable

Tables = Mapping[str, DataFrame]


def with_collation(tables: Tables, collation: str = "UTF8_LCASE") -> dict[str, DataFrame]:
    """The tables with all text under a collation, for reports that treat upper and lower case alike."""
    return {
        name: df.withColumns({c: F.collate(F.col(c), collation) for c, t in df.dtypes if t == "string"})
        for name, df in tables.items()
    }


def _links(fact: DataFrame) -> DataFrame:
    """``(customer_sk, policy_sk, txns)``: the number of facts per customer version and policy version."""
    given = F.col("customer_sk").isNotNull() & F.col("policy_sk").isNotNull()
    return fact.filter(given).groupBy("customer_sk", "policy_sk").agg(F.count("*").alias("txns"))


def _of_several(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value. Hashes the pairs, where least and greatest texts would have to be sorted."""
    pairs = rows.select(key, value).filter(F.col(value).isNotNull()).distinct()
    return pairs.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key)


def _policy_changes(tables: Tables, customers: DataFrame, details: Sequence[str]) -> DataFrame:
    """Later and earlier policy versions of one policy id with different types, for customers with facts on the later.

    Only policies that ever had two types take part, which few do, so most facts drop out at the first join. A
    report line needs only that some later version starts after some earlier one. That holds just when the
    latest start on the one side is after the earliest start on the other, so both sides shrink to one row per
    policy, type and reported detail before they meet.
    """
    policy, kept = tables["dim_policy"], ["policy_id", "policy_type", *details]
    spans = policy.groupBy(*kept).agg(F.min("policy_start_dt").alias("first_start"))
    several = _of_several(spans, "policy_id", "policy_type")
    policy = policy.join(several, "policy_id", "left_semi")
    previous = spans.join(several, "policy_id", "left_semi")
    previous = previous.toDF(*[f"previous_{c}" for c in previous.columns])
    who = ["customer_id", "customer_name"]
    current = (
        tables["fact_policy_txn"]
        .select("customer_sk", "policy_sk")
        .join(policy.select("policy_sk", "policy_start_dt", *kept), "policy_sk")
        .groupBy("customer_sk", *kept)
        .agg(F.max("policy_start_dt").alias("last_start"))
        .join(customers.select("customer_sk", *who), "customer_sk")
        .groupBy(*who, *kept)
        .agg(F.max("last_start").alias("last_start"))
    )
    return current.join(
        previous,
        (current["policy_id"] == previous["previous_policy_id"])
        & (current["last_start"] > previous["previous_first_start"])
        & (current["policy_type"] != previous["previous_policy_type"]),
    )


def changed_policy_type(tables: Tables) -> DataFrame:
    """Report b: current customers whose policy changed its type, with current and previous type."""
    customers = tables["dim_customer"].filter("current_flag = 1")
    return _policy_changes(tables, customers, []).select(
        "customer_id",
        "customer_name",
        F.col("policy_type").alias("current_policy_type"),
        "previous_policy_type",
        "policy_id",
    )


def changed_policy_details(tables: Tables) -> DataFrame:
    """Report b, revised: the same for all customer versions, with ids and names of both policies."""
    found = _policy_changes(tables, tables["dim_customer"], ["policy_name"])
    return found.select(
        "customer_id",
        "customer_name",
        F.col("policy_type").alias("current_policy_type"),
        F.col("policy_id").alias("current_policy_id"),
        F.col("policy_name").alias("current_policy_name"),
        "previous_policy_type",
        "previous_policy_id",
        "previous_policy_name",
    )


def customer_type_changes(policies: DataFrame) -> DataFrame:
    """Report b by customer: successive policies of different types, from ``stg_policy``.

    Of several policies that start on one day, the type that is first by name counts. The window therefore
    has at most one row per customer and calendar day.
    """
    daily = (
        policies.filter(F.col("policy_start_dt").isNotNull())
        .groupBy("customer_id", "policy_start_dt")
        .agg(F.min("policy_type").alias("policy_type"))
    )
    by_start = Window.partitionBy("customer_id").orderBy("policy_start_dt")
    with_previous = daily.withColumn("previous_policy_type", F.lag("policy_type").over(by_start))
    return with_previous.filter("policy_type <> previous_policy_type").select(
        "customer_id",
        "policy_start_dt",
        F.col("policy_type").alias("current_policy_type"),
        "previous_policy_type",
    )


def _policy_amounts(
    tables: Tables, who: Sequence[str], what: Sequence[str], customers: Column | None = None, policies: Column | None = None
) -> DataFrame:
    """Sum of policy amounts per customer and policy attributes; a policy counts once per transaction.

    With a condition on policies the join with them comes first and drops most transactions. Without one every
    transaction counts, and they are grouped to numbers per customer and policy before the join.
    """
    customer, policy = tables["dim_customer"], tables["dim_policy"]
    if customers is not None:
        customer = customer.filter(customers)
    if policies is not None:
        policy = policy.filter(policies)
        links, amount = tables["fact_policy_txn"].select("customer_sk", "policy_sk"), F.col("total_policy_amt")
    else:
        links, amount = _links(tables["fact_policy_txn"]), F.col("total_policy_amt") * F.col("txns")
    per_version = (
        links.join(policy.select("policy_sk", "total_policy_amt", *what), "policy_sk")
        .groupBy("customer_sk", *what)
        .agg(F.sum(amount.cast("decimal(28,2)")).alias("amount"))
    )
    return (
        per_version.join(customer.select("customer_sk", *who), "customer_sk")
        .groupBy(*who, *what)
        .agg(F.sum("amount").alias("total_policy_amt"))
    )


_WHO = ("customer_id", "customer_name", "region")


def amounts_by_customer(tables: Tables) -> DataFrame:
    """Report c: total policy amount per customer and region, all history."""
    return _policy_amounts(tables, _WHO, [])


def amounts_by_type(tables: Tables, policy_type: str = "Auto") -> DataFrame:
    """Report d: the same for one policy type."""
    return _policy_amounts(tables, _WHO, ["policy_type"], policies=F.col("policy_type") == policy_type)


def amounts_by_term(
    tables: Tables, regions: Sequence[str] = ("East", "West"), term: str = "Quarterly", year: int = 2012
) -> DataFrame:
    """Report e: the same for current customers of some regions, one policy term and start year."""
    return _policy_amounts(
        tables,
        _WHO,
        ["policy_term", "policy_start_dt"],
        customers=F.col("region").isin(*regions) & (F.col("current_flag") == 1),
        policies=(F.col("policy_term") == term) & in_year(F.col("policy_start_dt"), year),
    )


def marital_history(tables: Tables) -> DataFrame:
    """Report f: all versions of customers who had more than one marital status, by customer and start."""
    versions = tables["dim_customer"]
    changed = _of_several(versions, "customer_id", "marital_status")
    return (
        versions.join(changed, "customer_id", "left_semi")
        .select(
            "customer_id",
            F.col("customer_name").alias("customer_title"),
            F.col("customer_name").alias("customer_first_name"),
            F.col("customer_name").alias("customer_last_name"),
            "customer_segment",
            "marital_status",
            F.col("eff_start_dt").alias("start_dt"),
            F.col("eff_end_dt").alias("end_dt"),
        )
        .orderBy("customer_id", "start_dt")
    )


def full_listing(tables: Tables) -> DataFrame:
    """Report g: current customers with policy, policy type and address, a line per transaction.

    The type description joins the policies before they meet the transactions: there are few types, and a join
    on them would gather a great share of all rows on one key.
    """
    customer = tables["dim_customer"].filter("current_flag = 1")
    types = tables["dim_policy_type"].select(F.col("policy_type_id").alias("_type_id"), "policy_type_desc")
    policy = tables["dim_policy"]
    policy = policy.join(types, policy["policy_type_id"] == types["_type_id"], "left")
    where = ["city", "state_province", "postal_code"]
    address = tables["dim_address"].select(F.col("address_sk").alias("_address_sk"), *where)
    rows = (
        tables["fact_policy_txn"]
        .select("customer_sk", "policy_sk", "address_sk")
        .join(customer.drop("eff_start_dt", "eff_end_dt"), "customer_sk")
        .join(policy, "policy_sk")
    )
    return left_join_nullable(rows, address, "address_sk", "_address_sk").select(
        "region", "customer_id", "customer_name", "customer_segment", "marital_status", "gender", *where, "policy_id",
        "policy_name", "policy_type", "policy_type_desc", "policy_term", "policy_start_dt", "policy_end_dt",
        "total_policy_amt",
    )


def address_history(
    tables: Tables, start: dt.date = dt.date(2010, 1, 1), end: dt.date = dt.date(2025, 12, 31)
) -> DataFrame:
    """Report h: addresses per customer with first and last day seen in a time frame, by customer and first day."""
    key = [int(f"{d:%Y%m%d}") for d in (start, end)]
    where = ["city", "state_province", "postal_code", "country"]
    seen = (
        tables["fact_policy_txn"]
        .filter(F.col("date_sk").between(*key) & F.col("address_sk").isNotNull())
        .groupBy("customer_sk", "address_sk")
        .agg(F.min("date_sk").alias("low"), F.max("date_sk").alias("high"))
    )
    return (
        seen.join(tables["dim_customer"].select("customer_sk", "customer_id", "customer_name"), "customer_sk")
        .groupBy("customer_id", "customer_name", "address_sk")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .join(tables["dim_address"].select("address_sk", *where), "address_sk")
        .select(
            "customer_id",
            "customer_name",
            "address_sk",
            *where,
            date_of_key(F.col("low")).alias("first_seen_date"),
            date_of_key(F.col("high")).alias("last_seen_date"),
        )
        .orderBy("customer_id", "first_seen_date", "address_sk")
    )


REPORTS = {
    "b": changed_policy_type,
    "b_revised": changed_policy_details,
    "c": amounts_by_customer,
    "d": amounts_by_type,
    "e": amounts_by_term,
    "f": marital_history,
    "g": full_listing,
    "h": address_history,
}
