"""Warehouse views and raw feeds over the driver tables. ``oracle.py`` states the same in SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from premia.functions import date_key, late_months
from premia.functions.money import MONEY
from premia.operators.links import link_customer_version

STATUSES = ["Single", "Married", "Divorced", "Remarried"]
COUNTRIES = ["US", "usa", "U.S", "U.S.A", "United States", " united states of america ", "Canada"]
OPEN = dt.date(9999, 12, 31)


# The driver tables. A given schema spares a job that reads file footers for each table.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    """One of a few values by a 0-based number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def type_id(priority: Column) -> Column:
    return F.substring(priority, 1, 1)


def type_name(priority: Column) -> Column:
    return F.substr(priority, F.lit(3))


def term(status: Column) -> Column:
    return F.when(status == "F", "Quarterly").when(status == "O", "Half Yearly").otherwise("Yearly")


def places(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "n_name", "r_name")


def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions for customers whose key is no multiple of three, else one."""
    c = table(spark, sf, "customer")
    rows = c.join(places(spark, sf), c["c_nationkey"] == F.col("n_nationkey"))
    last = F.when(F.col("c_custkey") % 3 != 0, 1).otherwise(0)
    rows = rows.withColumn("last", last).withColumn("v", F.explode(F.sequence(F.lit(0), F.col("last"))))
    key, v, change = F.col("c_custkey"), F.col("v"), dt.date(1999, 1, 1)
    return rows.select(
        (key * 2 + v).alias("customer_sk"),
        key.cast("string").alias("customer_id"),
        F.when(v == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        pick(STATUSES, key + v).alias("marital_status"),
        pick(["Female", "Male"], key).alias("gender"),
        F.when(v == 0, F.lit(dt.date(1995, 1, 1))).otherwise(F.lit(change)).alias("eff_start_dt"),
        F.when(v < F.col("last"), F.lit(change)).otherwise(F.lit(OPEN)).alias("eff_end_dt"),
        (v == F.col("last")).cast("int").alias("current_flag"),
        F.col("r_name").alias("region"),
    )


def dim_policy(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    start = F.to_date("o_orderdate")
    kind = type_name(F.col("o_orderpriority"))
    return o.select(
        F.col("o_orderkey").alias("policy_sk"),
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("policy_id"),
        F.concat(F.lit("Plan "), kind, F.lit(" "), F.col("o_orderstatus")).alias("policy_name"),
        type_id(F.col("o_orderpriority")).alias("policy_type_id"),
        kind.alias("policy_type"),
        term(F.col("o_orderstatus")).alias("policy_term"),
        start.alias("policy_start_dt"),
        F.date_add(start, 3650).alias("policy_end_dt"),
        money("o_totalprice").alias("total_policy_amt"),
    )


def dim_policy_type(spark: SparkSession, sf: str) -> DataFrame:
    """Without type 5, so that left joins have rows without a match."""
    kinds = table(spark, sf, "orders").filter(type_id(F.col("o_orderpriority")) != "5").select("o_orderpriority").distinct()
    kind = type_name(F.col("o_orderpriority"))
    return kinds.select(
        type_id(F.col("o_orderpriority")).alias("policy_type_id"),
        kind.alias("policy_type_name"),
        F.concat(F.lit("Cover for "), F.lower(kind)).alias("policy_type_desc"),
    )


def dim_address(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    return s.join(table(spark, sf, "nation"), s["s_nationkey"] == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("address_sk"),
        F.lit("USA").alias("country"),
        F.col("n_name").alias("state_province"),
        F.col("s_name").alias("city"),
        (F.col("s_suppkey") + 10000).cast("string").alias("postal_code"),
    )


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """A line per lineitem, not yet linked to a customer version."""
    line, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    rows = line.join(o, line["l_orderkey"] == o["o_orderkey"])
    ship, due = F.to_date("l_shipdate"), F.date_add(F.to_date("o_orderdate"), 90)
    days = F.datediff(ship, due)
    return rows.select(
        F.col("l_linenumber").alias("line"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderkey").alias("policy_sk"),
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("policy_id"),
        F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey")).alias("address_sk"),
        ship.alias("txn_date"),
        date_key(ship).alias("date_sk"),
        money("l_extendedprice").alias("premium_amt"),
        days.alias("late_days"),
        late_months(days).alias("late_duration_months"),
    )


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return link_customer_version(transactions(spark, sf), dim_customer(spark, sf), closed="left")


class Warehouse(Mapping):
    """The views by table name; a report builds only those it asks for."""

    VIEWS = {
        "dim_customer": dim_customer,
        "dim_policy": dim_policy,
        "dim_policy_type": dim_policy_type,
        "dim_address": dim_address,
        "fact_policy_txn": fact,
    }

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def __getitem__(self, name: str) -> DataFrame:
        return self.VIEWS[name](self.spark, self.sf)

    def __iter__(self):
        return iter(self.VIEWS)

    def __len__(self) -> int:
        return len(self.VIEWS)


def _feed_date(c: Column) -> Column:
    return F.date_format(c, "M/d/yyyy")


def _dollars(c: Column) -> Column:
    """Text with a dollar sign and one thousands comma."""
    return F.concat(F.lit("$"), F.regexp_replace(c.cast("string"), r"^(\d+)(\d{3})\.", "$1,$2."))


def raw_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A raw daily feed with a line per order, all text; one region has the name in parts.

    Besides the feed columns it holds ``source_file``. Even orders belong to day 1, odd ones to day 2.
    """
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"]).join(places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    k, cust, day = F.col("o_orderkey"), F.col("c_custkey"), F.col("o_orderkey") % 2 + 1
    in_parts = F.col("r_name") == "AFRICA"
    start = F.to_date("o_orderdate")
    kind, price = type_name(F.col("o_orderpriority")), money("o_totalprice")
    postal = (10000 + F.col("c_nationkey") * 10 + F.when(cust % 3 == 0, day).otherwise(0)).cast("string")
    status = F.when(cust % 5 == 0, cust + day).otherwise(cust)
    columns = {
        "Customer ID": F.concat(F.lit(" "), cust.cast("string"), F.lit("\t")),
        "Customer Name": F.when(~in_parts, F.col("c_name")),
        "Customer Title": F.when(in_parts, "mr."),
        "Customer First Name": F.when(in_parts, F.lower("c_mktsegment")),
        "Customer Middle Name": F.when(in_parts & (cust % 2 == 1), "q"),
        "Customer Last Name": F.when(in_parts, F.concat(F.lit("o'"), F.lower("n_name"))),
        "Customer_Segment": F.col("c_mktsegment"),
        "Maritial_Status": pick(STATUSES, status),
        "Gender": pick(["Female", "Male"], cust),
        "DOB": _feed_date(F.date_add(F.lit(dt.date(1960, 1, 1)), (cust % 10000).cast("int"))),
        "Effective_Start_Dt": F.when(cust % 7 != 0, "1/1/1990"),
        "Effective_End_Dt": F.lit(None).cast("string"),
        "Policy_Type_Id": type_id(F.col("o_orderpriority")),
        "Policy_Type": kind,
        "Policy_Type_Desc": F.concat(F.lit("Cover for "), F.lower(kind)),
        "Policy_Id": F.concat(type_id(F.col("o_orderpriority")), F.lit("_"), F.col("c_nationkey").cast("string")),
        "Policy_Name": F.concat(F.lit("Plan "), kind),
        "Premium_Amt": _dollars(price),
        "Policy_Term": term(F.col("o_orderstatus")),
        "Policy_Start_Dt": _feed_date(start),
        "Policy_End_Dt": _feed_date(F.date_add(start, 3650)),
        "Next_Premium_Dt": _feed_date(F.date_add(start, 30)),
        "Actual_Premium_Paid_Dt": F.when(k % 97 != 0, _feed_date(F.date_add(start, (k % 400 + 10).cast("int")))),
        "Country": pick(COUNTRIES, cust),
        "Region": F.col("r_name"),
        "State or Province": F.col("n_name"),
        "City": F.concat(F.lit("City "), (cust % 50).cast("string")),
        "Postal Code": F.when(cust % 2 == 0, F.concat(postal, F.lit(".0"))).otherwise(postal),
        "Total_Policy_Amt": (price * F.lit(Decimal(10))).cast(MONEY).cast("string"),
        "Premium_Amt_Paid_TillDate": F.when(k % 50 != 0, (price * F.lit(Decimal(2))).cast(MONEY).cast("string")).otherwise("n/a"),
    }
    source = F.concat(F.lit("Feed_"), F.col("r_name"), F.lit("_day"), day.cast("string"), F.lit(".csv"))
    return rows.select([e.alias(n) for n, e in columns.items()] + [source.alias("source_file")])
