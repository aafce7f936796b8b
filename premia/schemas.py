"""Feed headers and warehouse table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from premia.functions.money import MONEY

TEXT, INT, DAY, TIME = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampType()
AMOUNT, RATE = T.DecimalType(18, 2), T.DecimalType(5, 4)
assert AMOUNT.simpleString() == MONEY


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Names the feed spells in its own way, after conversion to snake case.
FEED_RENAMES = {
    "policy_type": "policy_type_name",
    "state_or_province": "state_province",
    "maritial_status": "marital_status",
}
# Feed columns by kind, in feed order.
NAME_PARTS = ("customer_title", "customer_first_name", "customer_middle_name", "customer_last_name")
ID_COLUMNS = ("policy_id", "policy_type_id", "customer_id")
DATE_COLUMNS = (
    "dob", "effective_start_dt", "effective_end_dt", "policy_start_dt", "policy_end_dt",
    "next_premium_dt", "actual_premium_paid_dt", "txn_date",
)
MONEY_COLUMNS = ("premium_amt", "total_policy_amt", "premium_amt_paid_tilldate", "payment_amount")

# Canonical values of feed columns, and other ways to write them in lower case.
FEED_SPELLINGS = {
    "gender": {"Male": ("male", "m", "man"), "Female": ("female", "f", "woman")},
    "marital_status": {
        "Single": ("single", "unmarried", "never married"), "Married": ("married", "m"),
        "Divorced": ("divorced", "separated"), "Widowed": ("widowed", "widow", "widower"),
    },
    "policy_term": {
        "Monthly": ("monthly", "month", "per month"), "Quarterly": ("quarterly", "quarter", "per quarter"),
        "Half Yearly": ("half yearly", "half-yearly", "semi-annual", "semi annual"),
        "Yearly": ("yearly", "annual", "annually", "per year"),
    },
    "region": {"Central": ("central",), "East": ("east", "eastern"), "South": ("south", "southern"), "West": ("west", "western")},
}

# Every column a feed may bring, snake case and renamed, in feed order.
FEED_COLUMNS = (
    "customer_id", "customer_name", *NAME_PARTS, "customer_segment", "marital_status", "gender", "dob",
    "effective_start_dt", "effective_end_dt", "policy_type_id", "policy_type_name", "policy_type_desc",
    "policy_id", "policy_name", "premium_amt", "policy_term", "policy_start_dt", "policy_end_dt",
    "next_premium_dt", "actual_premium_paid_dt", "country", "region", "state_province", "city",
    "postal_code", "total_policy_amt", "premium_amt_paid_tilldate",
)

# The cleaned feed, written once per batch; all warehouse tables derive from it.
FEED = T.StructType(
    [
        T.StructField(
            name,
            DAY if name in DATE_COLUMNS else AMOUNT if name in MONEY_COLUMNS else TEXT,
        )
        for name in FEED_COLUMNS
        if name not in NAME_PARTS
    ]
    + list(
        _table(
        txn_date=DAY, premium_amount=AMOUNT, premium_paid_tilldate=AMOUNT, late_duration_days=INT,
        late_duration_months=INT, late_fee_amount=AMOUNT, total_amount_to_pay=AMOUNT, source_file=TEXT,
        ingestion_date=TIME,
    )
    )
)

# The warehouse tables. Each is a folder with parts by day and attempt, which are not listed here.
TABLES = {
    "stg_customers": _table(
        customer_id=TEXT, customer_name=TEXT, customer_segment=TEXT, marital_status=TEXT, gender=TEXT, dob=DAY,
        effective_start_dt=DAY, effective_end_dt=DAY, region=TEXT, ingestion_date=TIME, source_file=TEXT,
    ),
    "stg_policy": _table(
        policy_id=TEXT, policy_name=TEXT, policy_type_id=TEXT, policy_type=TEXT, policy_type_desc=TEXT,
        policy_term=TEXT, policy_start_dt=DAY, policy_end_dt=DAY, total_policy_amt=AMOUNT, premium_amt=AMOUNT,
        next_premium_dt=DAY, actual_premium_paid_dt=DAY, premium_amt_paid_tilldate=AMOUNT, customer_id=TEXT,
        region=TEXT, ingestion_date=TIME, source_file=TEXT,
    ),
    "stg_address": _table(
        customer_id=TEXT, country=TEXT, region=TEXT, state_province=TEXT, city=TEXT, postal_code=TEXT,
        ingestion_date=TIME, source_file=TEXT,
    ),
    "stg_transactions": _table(
        policy_id=TEXT, customer_id=TEXT, txn_date=DAY, premium_amount=AMOUNT, premium_paid_tilldate=AMOUNT,
        total_policy_amt=AMOUNT, region=TEXT, ingestion_date=TIME, source_file=TEXT,
    ),
    "dim_customer": _table(
        customer_sk=TEXT, customer_id=TEXT, customer_name=TEXT, customer_segment=TEXT, marital_status=TEXT,
        gender=TEXT, dob=DAY, eff_start_dt=DAY, eff_end_dt=DAY, current_flag=INT, region=TEXT, created_at=TIME,
    ),
    "dim_policy_type": _table(
        policy_type_id=TEXT, policy_type_name=TEXT, policy_type_desc=TEXT,
    ),
    "dim_policy": _table(
        policy_sk=TEXT, policy_id=TEXT, policy_name=TEXT, policy_type_id=TEXT, policy_type=TEXT,
        policy_term=TEXT, policy_start_dt=DAY, policy_end_dt=DAY, total_policy_amt=AMOUNT, created_at=TIME,
    ),
    "dim_address": _table(
        address_sk=TEXT, customer_id=TEXT, country=TEXT, region=TEXT, state_province=TEXT, city=TEXT,
        postal_code=TEXT, created_at=TIME,
    ),
    "dim_date": _table(
        date_sk=INT, dt=DAY, year=INT, month=INT, day=INT, quarter=INT,
    ),
    "dim_late_fee": _table(
        late_fee_sk=INT, duration_months=INT, penalty_percent=RATE, description=TEXT, created_at=TIME,
    ),
    "fact_policy_txn": _table(
        customer_sk=TEXT, policy_sk=TEXT, address_sk=TEXT, late_fee_sk=INT, date_sk=INT, premium_amt=AMOUNT,
        premium_paid_tilldate=AMOUNT, total_policy_amt=AMOUNT, late_fee=AMOUNT, region=TEXT,
        ingestion_date=TIME,
    ),
    # Per load: files, cells and rows that were left out, and why.
    "rejects": _table(kind=TEXT, item=TEXT, reason=TEXT, rows=T.LongType()),
}
