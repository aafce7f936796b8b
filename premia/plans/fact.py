"""The transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from premia.functions import date_key
from premia.operators.links import (
    address_key,
    link_address,
    link_customer_version,
    link_late_fee,
    link_policy,
    link_policy_version,
)
from premia.operators.standardize import normalize_postal, project_to
from premia.schemas import TABLES


def build_fact(
    feed: DataFrame,
    dim_customer: DataFrame,
    dim_policy: DataFrame,
    dim_address: DataFrame | None,
    dim_late_fee: DataFrame,
    closed: str = "left",
    policy_versions: bool = True,
) -> DataFrame:
    """Link every transaction to its dimension rows.

    By default each feed row with a customer version gives one fact. ``closed='both'`` and
    ``policy_versions=False`` give the plain links: two facts on the day of a customer change, and one per
    version of the policy. The policy comes first, because its link reads the policies and days of the rows
    once more, which is cheapest straight from the feed. Without ``dim_address`` the addresses are those of the feed
    itself, whose keys follow from customer and postal code, and nothing is joined.
    """
    linked = (link_policy_version if policy_versions else link_policy)(feed, dim_policy)
    linked = link_customer_version(linked, dim_customer, closed)
    linked = normalize_postal(linked)
    if dim_address is None:
        customer, postal = F.col("customer_id"), F.col("postal_code")
        linked = linked.withColumn("address_sk", F.when(customer.isNotNull() & postal.isNotNull(), address_key(customer, postal)))
    else:
        linked = link_address(linked, dim_address)
    linked = link_late_fee(linked, dim_late_fee)
    return project_to(
        linked.withColumnRenamed("late_fee_amount", "late_fee").withColumn("date_sk", date_key(F.col("txn_date"))),
        TABLES["fact_policy_txn"],
    )
