"""Business columns of a policy feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from premia.functions import late_fee_rate, late_months, title_case
from premia.functions.text import squeeze_space
from premia.schemas import NAME_PARTS


def construct_customer_name(df: DataFrame) -> DataFrame:
    """Build the name from title, first, middle and last name where ``customer_name`` is null."""
    parts = [c for c in NAME_PARTS if c in df.columns]
    if not parts:
        return df
    built = title_case(squeeze_space(F.concat_ws(" ", *parts)))
    name = F.coalesce(F.col("customer_name"), built) if "customer_name" in df.columns else built
    return df.withColumn("customer_name", name)


def calculate_late_fees(df: DataFrame) -> DataFrame:
    """Days and months of delay, penalty share, fee and total due; a feed without the inputs stays as it is."""
    if not {"actual_premium_paid_dt", "next_premium_dt", "premium_amt"} <= set(df.columns):
        return df
    return (
        df.withColumn("late_duration_days", F.datediff("actual_premium_paid_dt", "next_premium_dt"))
        .withColumn("late_duration_months", late_months(F.col("late_duration_days")))
        .withColumn("late_fee_pct", late_fee_rate(F.col("late_duration_months")))
        .withColumn("late_fee_amount", F.col("premium_amt") * F.col("late_fee_pct"))
        .withColumn("total_amount_to_pay", F.col("premium_amt") + F.col("late_fee_amount"))
    )


def installments(df: DataFrame) -> DataFrame:
    """Number of premiums a policy takes and the amount still open.

    The feed documents name an installment calculation but give no formula; this definition is our own.
    """
    premium = F.when(F.col("premium_amt") > 0, F.col("premium_amt"))
    return df.withColumns(
        {
            "installment_count": F.ceil(F.col("total_policy_amt") / premium).cast("bigint"),
            "remaining_amount": F.col("total_policy_amt") - F.coalesce("premium_amt_paid_tilldate", F.lit(0)),
        }
    )
