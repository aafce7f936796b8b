"""One query per operator, on the driver tables. Dirt, nulls and history are derived by expression."""

from __future__ import annotations

import datetime as dt
import functools
import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bindings import views
from bindings.views import money, pick, table
from premia import functions
from premia.operators import history, links, policies, profile, quality, relational, standardize
from premia.plans import daily_load, dimensions, fact, reports
from premia.schemas import TABLES
from premia.session import shared_dir, tune
from premia.sources import files, tables
from premia.streaming.daily import load_arriving_days

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LOADED_AT = dt.datetime(2024, 1, 1)


def as_of(day: int) -> dt.date:
    """Changes of day 1 take effect in 1997, those of day 2 in 1998."""
    return dt.date(1996 + day, 1, 1)


def query(run: Query) -> Query:
    @functools.wraps(run)
    def tuned(spark: SparkSession, sf: str) -> DataFrame:
        return run(tune(spark), sf)

    QUERIES[run.__name__] = tuned
    return run


def as_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def as_bigint(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


# --- reports -------------------------------------------------------------------------------------------------


@query
def rpt_b(spark, sf):
    return reports.changed_policy_type(views.Warehouse(spark, sf))


@query
def rpt_b_revised(spark, sf):
    return reports.changed_policy_details(views.Warehouse(spark, sf))


@query
def rpt_b_customer(spark, sf):
    rows = views.dim_policy(spark, sf).withColumnRenamed("policy_id", "customer_id")
    return reports.customer_type_changes(rows)


@query
def rpt_c(spark, sf):
    return as_double(reports.amounts_by_customer(views.Warehouse(spark, sf)), "total_policy_amt")


@query
def rpt_d(spark, sf):
    return as_double(reports.amounts_by_type(views.Warehouse(spark, sf), "URGENT"), "total_policy_amt")


@query
def rpt_e(spark, sf):
    found = reports.amounts_by_term(views.Warehouse(spark, sf), ["ASIA", "EUROPE"], "Quarterly", 1996)
    return as_double(found, "total_policy_amt")


@query
def rpt_f(spark, sf):
    return reports.marital_history(views.Warehouse(spark, sf))


@query
def rpt_g(spark, sf):
    return as_double(reports.full_listing(views.Warehouse(spark, sf)), "total_policy_amt")


@query
def rpt_h(spark, sf):
    return reports.address_history(views.Warehouse(spark, sf), dt.date(1996, 1, 1), dt.date(1998, 12, 31))


# --- links and joins -----------------------------------------------------------------------------------------


@query
def join_asof_scd2(spark, sf):
    linked = links.link_customer_version(views.transactions(spark, sf), views.dim_customer(spark, sf), "both")
    return linked.select("policy_sk", "line", "customer_id", "customer_sk", "txn_date")


def _postal_facts(spark, sf):
    """Transactions with the postal code of a supplier and an unknown code in every eleventh order."""
    rows = views.transactions(spark, sf)
    code = F.when(F.col("policy_sk") % 11 == 0, "0").otherwise((10000 + F.col("policy_sk") % 7).cast("string"))
    return rows.withColumn("postal_code", code)


def _customer_addresses(spark, sf):
    """Five postal codes per customer."""
    c = table(spark, sf, "customer")
    code = F.explode(F.sequence(F.lit(10000), F.lit(10004)))
    rows = c.select(F.col("c_custkey"), code.alias("code"))
    return rows.select(
        (F.col("c_custkey") * 100000 + F.col("code")).alias("address_sk"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("code").cast("string").alias("postal_code"),
    )


@query
def join_address_link(spark, sf):
    rows = _postal_facts(spark, sf).drop("address_sk")
    linked = links.link_address(rows, _customer_addresses(spark, sf))
    return linked.select("policy_sk", "line", "customer_id", "postal_code", "address_sk")


@query
def join_policy_link(spark, sf):
    """The plain link on the policy id, from one row per policy with its number of transactions."""
    return links.link_policy(
        views.transactions(spark, sf).drop("policy_sk").groupBy("policy_id").agg(F.count("*").alias("txns")),
        views.dim_policy(spark, sf),
    )


@query
def join_policy_version(spark, sf):
    rows = views.transactions(spark, sf).withColumnRenamed("policy_sk", "order_key")
    linked = links.link_policy_version(rows, views.dim_policy(spark, sf))
    return linked.select("order_key", "line", "policy_id", "txn_date", "policy_sk")


@query
def join_late_fee(spark, sf):
    rows = links.link_late_fee(views.transactions(spark, sf), links.late_fee_bands(spark))
    return rows.select("policy_sk", "line", "late_duration_months", "late_fee_sk")


@query
def dim_late_fee(spark, sf):
    """The penalty table with the use the transactions make of each row."""
    rows = views.transactions(spark, sf)
    use = rows.groupBy("late_duration_months").agg(
        F.count("*").alias("txns"), F.sum("premium_amt").cast("decimal(28,2)").alias("premium")
    )
    bands = links.late_fee_bands(spark).drop("created_at")
    found = bands.join(use, bands["duration_months"] == use["late_duration_months"], "left")
    return found.select(
        "duration_months",
        F.col("penalty_percent").cast("double").alias("penalty_percent"),
        "description",
        F.coalesce("txns", F.lit(0)).alias("txns"),
        F.coalesce(F.col("penalty_percent") * F.col("premium"), F.lit(0)).cast("double").alias("penalty"),
    )


def _fact_feed(spark, sf):
    rows = _postal_facts(spark, sf).drop("policy_sk", "address_sk")
    rate = functions.late_fee_rate(F.col("late_duration_months"))
    return rows.withColumn("late_fee_amount", F.col("premium_amt") * rate)


@query
def fact_policy_txn(spark, sf):
    built = fact.build_fact(
        _fact_feed(spark, sf),
        views.dim_customer(spark, sf),
        views.dim_policy(spark, sf),
        _customer_addresses(spark, sf),
        links.late_fee_bands(spark),
    )
    keys = ["customer_sk", "policy_sk", "address_sk", "late_fee_sk", "date_sk"]
    return as_double(built.select(*keys, "premium_amt", "late_fee"), "premium_amt", "late_fee")


def _left_keys(spark, sf):
    """Orders by customer with a null key in every tenth row."""
    o = table(spark, sf, "orders")
    key = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey") % 2000)
    return o.select(key.alias("k"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("tag"))


def _right_keys(spark, sf):
    """Customers, the last of which have no orders here, and one null key."""
    c = table(spark, sf, "customer")
    key = F.when(F.col("c_custkey") != 5, F.col("c_custkey") + 100)
    return c.select(key.alias("k"), F.col("c_mktsegment").alias("tag"), F.col("c_nationkey").alias("nation"))


def _join(how: str) -> Query:
    def run(spark, sf):
        joined = relational.join_tables(_left_keys(spark, sf), _right_keys(spark, sf), "k", "k", how)
        return joined.select("k", "id", "tag_x", "tag_y", "nation")

    run.__name__ = f"join_{how}"
    return run


for _how in ("inner", "left", "right", "outer"):
    query(_join(_how))


@query
def agg_generic(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select(
        F.when(F.col("user_id") % 7 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        F.col("value").alias("worth"),
        F.col("value").alias("spread"),
        F.col("value").alias("middle"),
        F.col("value").alias("least"),
        F.col("user_id").alias("users"),
        F.col("event_id").alias("earliest"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("hits"),
        F.col("event_id").alias("order"),
    )
    wanted = {
        "value": "sum", "worth": "mean", "spread": "std", "middle": "median", "least": "min",
        "users": "nunique", "earliest": "first", "hits": "count",
    }
    found = relational.aggregations(rows, ["event_type"], wanted, order_by=["order"])
    return found.withColumns({c: F.round(c, 6) for c in ("value", "worth", "spread", "middle")})


@query
def set_union_outer(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    line = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    return relational.union_outer([o, line])


# --- standardization -----------------------------------------------------------------------------------------


@query
def std_columns(spark, sf):
    c = table(spark, sf, "customer")
    raw = c.toDF("  Customer ID ", "State or--Province", "Maritial_Status", "Policy_Type", "State_or_Province")
    named = standardize.rename_columns(standardize.standardize_columns(raw))
    return as_double(named.withColumn("marital_status", F.col("marital_status").cast("int")), "policy_type_name")


@query
def std_currency(spark, sf):
    line = table(spark, sf, "lineitem")
    text = F.when(F.col("l_orderkey") % 50 == 0, "n/a").otherwise(views._dollars(money("l_extendedprice")))
    rows = line.select("l_orderkey", "l_linenumber", text.alias("price"))
    return as_double(standardize.clean_currency(rows, ["price", "absent"]), "price")


@query
def std_dates_formats(spark, sf):
    """Dates in several formats, and text that is none."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, F.date_format("o_orderdate", "M/d/yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
    text = text.when(k == 2, F.date_format("o_orderdate", "M/d/yyyy H:mm")).when(k == 3, F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise("soon")
    formats = ("M/d/yyyy", "yyyy-MM-dd", "M/d/yyyy H:mm", "dd.MM.yyyy")
    return standardize.parse_dates(o.select("o_orderkey", text.alias("day")), ["day"], formats)


@query
def std_dates(spark, sf):
    o = table(spark, sf, "orders")
    text = F.when(F.col("o_orderkey") % 20 == 0, "31/31/2012").otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    return standardize.parse_dates(o.select("o_orderkey", text.alias("day")), ["day", "absent"])


@query
def std_dates_inferred(spark, sf):
    """Files that write month or day first, some years in two digits: each file and column is read in one order."""
    o = table(spark, sf, "orders")
    day, two_digits = F.date_add(F.to_date("o_orderdate"), 7305), F.col("o_orderkey") % 2 == 0

    def written(order: str) -> Column:
        return F.when(two_digits, F.date_format(day, f"{order}/yy")).otherwise(F.date_format(day, f"{order}/yyyy"))

    file = F.col("o_orderkey") % 3
    text = F.when(file == 0, written("M/d")).when(file == 1, written("d/M")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    rows = o.select("o_orderkey", F.concat(F.lit("f"), file.cast("string"), F.lit(".csv")).alias("source_file"), text.alias("day"))
    return standardize.parse_dates_in_order(rows, standardize.date_orders(rows, ["day"]), ["day"])


@query
def std_trim(spark, sf):
    c = table(spark, sf, "customer")
    return standardize.trim_strings(c.select("c_custkey", F.concat(F.lit(" \t"), "c_name", F.lit("\n ")).alias("name")))


@query
def std_country(spark, sf):
    c = table(spark, sf, "customer")
    return standardize.clean_country(c.select("c_custkey", pick(views.COUNTRIES, F.col("c_custkey")).alias("country")))


@query
def std_ids(spark, sf):
    o = table(spark, sf, "orders")
    padded = F.when(F.col("o_orderkey") % 9 != 0, F.concat(F.lit("  "), F.col("o_custkey").cast("string"), F.lit(" ")))
    return standardize.normalize_ids(o.select("o_orderkey", padded.alias("customer_id")))


@query
def std_postal(spark, sf):
    s = table(spark, sf, "supplier")
    code = (F.col("s_suppkey") + 10000).cast("string")
    raw = F.when(F.col("s_suppkey") % 3 == 0, F.concat(code, F.lit(".0"))).when(F.col("s_suppkey") % 3 == 1, code)
    return standardize.normalize_postal(s.select("s_suppkey", raw.alias("postal_code")))


@query
def date_key(spark, sf):
    o = table(spark, sf, "orders")
    day = F.when(F.col("o_orderkey") % 13 != 0, F.to_date("o_orderdate"))
    return o.select("o_orderkey", functions.date_key(day).alias("date_sk"))


@query
def date_key_parse(spark, sf):
    return date_key(spark, sf).withColumn("day", functions.date_of_key(F.col("date_sk")))


# Fixed values of the binding: spellings of the customer segments.
SEGMENTS = {"Car": ["automobile"], "Home": ["household", "furniture"]}


@query
def std_value_map(spark, sf):
    c = table(spark, sf, "customer")
    text = F.concat(F.lit(" "), F.col("c_mktsegment"))
    return standardize.map_values(c.select("c_custkey", text.alias("segment")), {"segment": SEGMENTS})


@query
def std_region_lookup(spark, sf):
    lookup = views.places(spark, sf).filter("n_nationkey <> 3").select(
        F.col("n_name").alias("state_province"), F.col("r_name").alias("region")
    )
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return standardize.region_of_state(c.select("c_custkey", F.col("n_name").alias("state_province")), lookup)


# --- business columns ----------------------------------------------------------------------------------------


@query
def xf_customer_name(spark, sf):
    p = table(spark, sf, "part")
    rows = p.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 4 == 0, "already named").alias("customer_name"),
        F.lit("mr.").alias("customer_title"),
        F.concat(F.lit("o'"), "p_name").alias("customer_first_name"),
        F.when(F.col("p_partkey") % 2 == 0, "van  der").alias("customer_middle_name"),
        F.concat(F.lower("p_type"), F.lit("-x ")).alias("customer_last_name"),
    )
    return policies.construct_customer_name(rows).select("p_partkey", "customer_name")


@query
def xf_late_fee(spark, sf):
    line, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    rows = line.join(o, line["l_orderkey"] == o["o_orderkey"]).select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_orderkey") % 40 != 0, F.to_date("l_shipdate")).alias("actual_premium_paid_dt"),
        F.date_add(F.to_date("o_orderdate"), 90).alias("next_premium_dt"),
        money("l_extendedprice").alias("premium_amt"),
    )
    fees = policies.calculate_late_fees(rows).drop("actual_premium_paid_dt", "next_premium_dt")
    return as_double(fees, "premium_amt", "late_fee_pct", "late_fee_amount", "total_amount_to_pay")


@query
def xf_installments(spark, sf):
    o = table(spark, sf, "orders")
    rows = o.select(
        "o_orderkey",
        money("o_totalprice").alias("total_policy_amt"),
        F.when(F.col("o_orderkey") % 30 != 0, (F.col("o_orderkey") % 900 * 10).cast("decimal(18,2)")).alias("premium_amt"),
        F.when(F.col("o_orderkey") % 8 != 0, F.lit(500).cast("decimal(18,2)")).alias("premium_amt_paid_tilldate"),
    )
    found = policies.installments(rows).select("o_orderkey", "installment_count", "remaining_amount")
    return as_double(found, "remaining_amount")


@query
def xf_split(spark, sf):
    return relational.split_dataframe(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus", "no_such_column"])


@query
def xf_dedup_first(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    return relational.keep_first(o, ["o_custkey"], ["o_orderkey"])


# --- history -------------------------------------------------------------------------------------------------


def _existing_customers(spark, sf):
    c = table(spark, sf, "customer").filter("c_custkey % 10 <> 9")
    return c.select(
        F.col("c_custkey").alias("customer_sk"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.when(F.col("c_custkey") % 4 != 3, pick(views.STATUSES, F.col("c_custkey"))).alias("marital_status"),
    )


def _new_customers(spark, sf):
    c, key = table(spark, sf, "customer").filter("c_custkey % 10 <> 8"), F.col("c_custkey")
    status = F.when(key % 5 == 0, "Remarried").when(key % 4 != 3, pick(views.STATUSES, key))
    return c.select(
        key.cast("string").alias("customer_id"),
        F.when(key % 6 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        status.alias("marital_status"),
        F.when(key % 3 != 0, F.lit(dt.date(1990, 1, 1))).alias("effective_start_dt"),
    )


COMPARED = ["customer_name", "customer_segment", "marital_status"]


def _scd2(spark, sf):
    return history.scd_type_2(
        _new_customers(spark, sf), _existing_customers(spark, sf), ["customer_id"], COMPARED, as_of(1)
    )


@query
def scd2_inserts(spark, sf):
    return _scd2(spark, sf)[0]


@query
def scd2_expired(spark, sf):
    return _scd2(spark, sf)[1]


@query
def scd2_initial(spark, sf):
    return history.first_load(_new_customers(spark, sf))


@query
def scd2_apply(spark, sf):
    """The customer table after two batches, without its hash keys."""
    given = {"gender": F.lit("F"), "region": F.lit("West"), "dob": F.lit(dt.date(1980, 1, 1))}
    first = _existing_customers(spark, sf).drop("customer_sk").withColumns(given)
    first = first.withColumn("effective_start_dt", F.lit(dt.date(1992, 1, 1)))
    none = spark.createDataFrame([], TABLES["dim_customer"])
    loaded = history.apply_customer_batch(none, first, as_of(1), F.lit(LOADED_AT))
    second = _new_customers(spark, sf).withColumns(given)
    result = history.apply_customer_batch(loaded, second, as_of(2), F.lit(LOADED_AT))
    return result.drop("customer_sk", "created_at")


@query
def scd1_merge(spark, sf):
    source = _new_customers(spark, sf).drop("customer_segment")
    return history.scd_type_1(source, _existing_customers(spark, sf), "customer_id")


# --- staging, dimensions, loads ------------------------------------------------------------------------------


def _feed(spark, sf):
    return daily_load.clean_feed(views.raw_feed(spark, sf), F.lit(LOADED_AT))


def _staging(name: str) -> Query:
    def run(spark, sf):
        rows = daily_load.staging_rows(_feed(spark, sf), name).drop("ingestion_date")
        return as_double(rows, *[c for c, t in rows.dtypes if t.startswith("decimal")])

    run.__name__ = name
    return run


for _name in daily_load.STAGING:
    query(_staging(_name))


@query
def dim_policy_type(spark, sf):
    return dimensions.policy_types(_feed(spark, sf))


@query
def dim_policy(spark, sf):
    rows = dimensions.policies(_feed(spark, sf), F.lit(LOADED_AT)).drop("policy_sk", "created_at")
    return as_double(rows, "total_policy_amt")


@query
def dim_address(spark, sf):
    return dimensions.addresses(_feed(spark, sf), F.lit(LOADED_AT)).drop("address_sk", "created_at")


@query
def dim_date(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return dimensions.calendar(days, "day")


def _described_fact(warehouse: tables.Warehouse) -> DataFrame:
    """The fact with the attributes its keys lead to, for a comparison without hash keys."""
    customer = warehouse.read("dim_customer").select(
        "customer_sk", "customer_id", "customer_name", "marital_status", "eff_start_dt", "eff_end_dt", "current_flag"
    )
    policy = warehouse.read("dim_policy").select(
        "policy_sk", "policy_id", "policy_type", "policy_start_dt", F.col("total_policy_amt").alias("version_amt")
    )
    address = warehouse.read("dim_address").select("address_sk", "postal_code", "city", "country")
    band = warehouse.read("dim_late_fee").select("late_fee_sk", "duration_months")
    rows = (
        warehouse.read("fact_policy_txn")
        .join(customer, "customer_sk", "left")
        .join(policy, "policy_sk", "left")
        .join(address, "address_sk", "left")
        .join(band, "late_fee_sk", "left")
        .drop("customer_sk", "policy_sk", "address_sk", "late_fee_sk", "ingestion_date")
    )
    return as_double(rows, *[c for c, t in rows.dtypes if t.startswith("decimal")])


@query
def pipe_batch(spark, sf):
    """Row counts of all warehouse tables after one batch of the whole feed."""
    warehouse = tables.Warehouse(spark, shared_dir(spark))
    daily_load.load_day(warehouse, views.raw_feed(spark, sf), 1, as_of(1), LOADED_AT)
    return tables.table_counts(spark, {name: warehouse.read(name) for name in TABLES if name != "rejects"})


@query
def load_rejects(spark, sf):
    """What a load leaves out: cells that are no dates, rows without a customer version, a damaged file."""
    warehouse = tables.Warehouse(spark, shared_dir(spark))
    raw = views.raw_feed(spark, sf)
    paid = F.when(F.col("City").endswith("7"), "31/31/2012").otherwise(F.col("Actual_Premium_Paid_Dt"))
    raw = raw.withColumn("Actual_Premium_Paid_Dt", paid)
    daily_load.load_day(warehouse, raw, 1, as_of(1), LOADED_AT, rejected=[("a.zip/x_day1.csv", "BadZipFile: damaged")])
    return warehouse.read("rejects")


@query
def load_rules(spark, sf):
    """What a load warns of: rows that fail a rule, all of them loaded, and a column that no feed has."""
    warehouse = tables.Warehouse(spark, shared_dir(spark))
    city = F.col("City")
    raw = views.raw_feed(spark, sf).withColumns({
        "Premium_Amt": F.when(city.endswith("3"), "-$5.00").otherwise(F.col("Premium_Amt")),
        "Policy_Id": F.when(city.endswith("4"), " ").otherwise(F.col("Policy_Id")),
        "Loyalty  Code": F.lit("x"),
    })
    daily_load.load_day(warehouse, raw, 1, as_of(1), LOADED_AT)
    loaded = warehouse.read("feed").agg(F.count("*").alias("rows")).select(F.lit("table").alias("kind"), F.lit("feed").alias("item"), F.lit("loaded").alias("reason"), "rows")
    return warehouse.read("rejects").unionByName(loaded)


SPLIT_NAME = ["Customer Title", "Customer First Name", "Customer Middle Name", "Customer Last Name"]


def _write_feed(spark, sf, folder):
    """The raw feed as files per day, with the two headers feeds come in and a name that drifts in case."""
    raw = views.raw_feed(spark, sf)
    for day in (1, 2):
        for variant, drop in (("Central", ["Customer Name"]), ("East", SPLIT_NAME)):
            mine = (F.col("Region") == "AFRICA") == F.lit(variant == "Central")
            rows = raw.filter((files.batch_day(F.col("source_file")) == day) & mine).drop(*drop, "source_file")
            if day == 2:
                rows = rows.withColumnRenamed("Customer Last Name", "Customer Last name")
            rows.write.options(header=True, escape='"').csv(f"{folder}/Feed_{variant}_day{day}.csv")


@query
def pipe_two_days(spark, sf):
    """Files of two days through the whole load; the fact with what its keys lead to."""
    folder = shared_dir(spark)
    _write_feed(spark, sf, f"{folder}/in")
    warehouse = daily_load.load_folder(spark, f"{folder}/in", f"{folder}/out", as_of, LOADED_AT)
    return _described_fact(warehouse)


@query
def pipe_stream(spark, sf):
    """The same two days, started by their arrival: plain files of day 1, then a zip archive with those of day 2."""
    folder = shared_dir(spark)
    _write_feed(spark, sf, f"{folder}/all")

    def arrive() -> None:
        stream = load_arriving_days(spark, f"{folder}/in", f"{folder}/out", f"{folder}/seen", as_of, LOADED_AT)
        stream.awaitTermination()
        if stream.exception() is not None:
            raise stream.exception()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed, writing, member = io.BytesIO(), None, None
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            for frame in batches:
                for (name, header), its in frame.groupby(["name", "header"], sort=False):
                    lines = its["value"].tolist()
                    if name != writing:
                        if member:
                            member.close()
                        writing, member = name, archive.open(name, "w", force_zip64=True)
                        lines.insert(0, header)
                    member.write(("\n".join(lines) + "\n").encode())
            if member:
                member.close()
        if member:
            yield pd.DataFrame({"value": [packed.getvalue()]})

    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    store.mkdirs(hadoop.Path(f"{folder}/in"))
    for variant in ("Central", "East"):
        store.rename(hadoop.Path(f"{folder}/all/Feed_{variant}_day1.csv"), hadoop.Path(f"{folder}/in/Feed_{variant}_day1.csv"))
    arrive()
    # Every file of day 2 becomes a member per file that Spark wrote, header and all.
    lines = spark.read.text(f"{folder}/all/*.csv").select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"))
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))
    stem = F.regexp_extract("path", r"Feed_(\w+)_day2\.csv/part-(\d+)", 1), F.regexp_extract("path", r"/part-(\d+)", 1)
    named = lines.join(first, "path").where(F.col("value") != F.col("header"))
    named = named.select(F.concat(F.lit("Feed_"), stem[0], F.lit("_part"), stem[1], F.lit("_day2.csv")).alias("name"), "header", "value", "at")
    spread = named.repartition("name").sortWithinPartitions("name", "at")
    _write_archives(spread.mapInPandas(pack, "value binary"), f"{folder}/in", "late")
    arrive()
    return _described_fact(tables.Warehouse(spark, f"{folder}/out"))


# --- sources and sinks ---------------------------------------------------------------------------------------


def _write_customers(spark, sf):
    """Customers as files of three days, in two header forms."""
    folder = shared_dir(spark)
    c = table(spark, sf, "customer")
    for day, header in ((1, "Customer Name"), (2, "Customer NAME"), (11, "Full Name")):
        rows = c.filter(F.col("c_custkey") % 3 == day % 3).select(
            F.col("c_custkey").alias("Customer ID"), F.col("c_name").alias(header), F.col("c_mktsegment").alias("Segment")
        )
        rows.write.options(header=True, escape='"').csv(f"{folder}/Customers_day{day}.csv")
    return folder


def _customer_rows(df):
    return df.withColumn("customer_id", F.col("customer_id").cast("bigint"))


@query
def src_csv(spark, sf):
    path = f"{shared_dir(spark)}/orders.csv"
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    o.write.options(header=True, escape='"').csv(path)
    return as_bigint(files.read_csv(spark, path), "o_orderkey", "o_custkey")


@query
def src_folder_union(spark, sf):
    return _customer_rows(files.read_folder(spark, _write_customers(spark, sf)))


@query
def src_batch_days(spark, sf):
    rows = files.read_folder(spark, _write_customers(spark, sf))
    return rows.groupBy(files.batch_day(F.col("source_file")).alias("batch_day")).agg(F.count("*").alias("rows"))


@query
def src_batch_select(spark, sf):
    return _customer_rows(files.read_day(spark, _write_customers(spark, sf), 1))


def _write_archives(packed: DataFrame, folder: str, name: str) -> None:
    """One row of bytes per task as files ``name<i>.zip``."""
    spark = packed.sparkSession
    # A text file takes the bytes of its rows as they are; what it adds stands behind the archive's end.
    parts = shared_dir(spark)
    packed.select(F.col("value").cast("string")).write.text(parts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    store.mkdirs(hadoop.Path(folder))
    for i, part in enumerate(store.globStatus(hadoop.Path(f"{parts}/part-*"))):
        if part.getLen():
            store.rename(part.getPath(), hadoop.Path(f"{folder}/{name}{i}.zip"))


@query
def src_zip_csv(spark, sf):
    """Customers in zip archives, two members each, and read back with the folder they lie in."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if not frames:
            return
        rows, packed = pd.concat(frames), io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            for part in (0, 1):
                at = TaskContext.get().partitionId()
                archive.writestr(f"customers{at}_{part}_day1.csv", rows[part::2].to_csv(index=False))
        yield pd.DataFrame({"value": [packed.getvalue()]})

    c = table(spark, sf, "customer")
    text = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nnext'))
    rows = c.select(F.col("c_custkey").alias("Customer ID"), text.alias("Name")).repartition(4, "Customer ID")
    folder = shared_dir(spark)
    _write_archives(rows.mapInPandas(pack, "value binary"), folder, "customers")
    read = files.read_folder(spark, folder)
    return _customer_rows(read).select("customer_id", "name", F.lit("customers_day1.csv").alias("source_file"))


@query
def src_sql_query(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    return tables.read_query(
        spark,
        "SELECT o_orderstatus, count(*) AS orders, count(DISTINCT o_custkey) AS customers "
        "FROM orders GROUP BY o_orderstatus",
    )


@query
def src_table(spark, sf):
    table(spark, sf, "supplier").createOrReplaceTempView("supplier")
    return tables.read_table(spark, "supplier")


@query
def sink_append(spark, sf):
    """Two appends after a replacement, read back."""
    path = f"{shared_dir(spark)}/events"
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    tables.load_table(e.filter("event_type = 'error'"), path, "replace")
    tables.load_table(e.filter("event_type = 'view'"), path)
    tables.load_table(e.filter("event_type not in ('view', 'error')"), path)
    return spark.read.parquet(path)


DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query
def chk_table_counts(spark, sf):
    return tables.table_counts(spark, {t: table(spark, sf, t) for t in DRIVER_TABLES})


@query
def chk_preview(spark, sf):
    return tables.preview(table(spark, sf, "orders").drop("o_orderdate"), ["o_orderkey"], 10)


# --- quality and profile -------------------------------------------------------------------------------------


def _dirty_events(spark, sf):
    e, i = table(spark, sf, "events"), F.col("event_id")
    return e.select(
        F.when(i % 100 != 0, i).alias("event_id"),
        F.when(i % 9 != 0, F.col("user_id")).alias("user_id"),
        F.when(i % 4 != 0, F.col("event_type")).alias("event_type"),
        F.when(i % 10 == 1, F.lit(float("nan"))).when(i % 10 != 0, F.col("value")).alias("value"),
    )


@query
def val_nulls(spark, sf):
    return quality.check_nulls(_dirty_events(spark, sf))


@query
def val_duplicates(spark, sf):
    return quality.check_duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def val_orphans(spark, sf):
    rows = views.transactions(spark, sf).select("policy_sk", "line", "address_sk")
    known = views.dim_address(spark, sf).filter("address_sk % 7 <> 0")
    return quality.check_referential_integrity(rows, known, "address_sk", "address_sk")


@query
def val_report(spark, sf):
    return quality.validation_report(_dirty_events(spark, sf).select("user_id", "event_type"))


@query
def val_schema(spark, sf):
    return quality.check_schema(_dirty_events(spark, sf), ["event_id", "event_type", "value", "amount"])


@query
def val_schema_drift(spark, sf):
    """Two feeds over three days, one of which drifts; each change with the cells that the file fills in that column."""
    folder = shared_dir(spark)
    c = table(spark, sf, "customer")
    cells = {"Customer ID": "c_custkey", "Customer Name": "c_name", "Segment": "c_mktsegment", "Nation": "c_nationkey"}
    headers = {
        1: ["Customer ID", "Customer Name", "Segment"],
        2: ["Customer ID", "Customer NAME", "Segment", "Nation"],
        3: ["Segment", "Customer NAME", "Nation"],
    }
    for day, header in headers.items():
        for feed, mine, columns in (("Debit", "c_acctbal < 0", header), ("Credit", "c_acctbal >= 0", headers[1])):
            named = [F.col(cells[n.replace("NAME", "Name")]).alias(n) for n in columns]
            its = c.filter(mine).filter(F.col("c_custkey") % 3 + 1 == day)
            its.select(named).write.options(header=True, escape='"').csv(f"{folder}/{feed}_day{day}.csv")
    drift = quality.schema_drift(files.file_headers(spark, folder), ["customer_id", "customer_name", "segment"])
    read = files.read_folder(spark, folder)
    names = [n for n in read.columns if n != "source_file"]
    counts = read.groupBy("source_file").agg(*[F.count(n).alias(n) for n in names])
    filled = counts.unpivot("source_file", names, "column_name", "filled_rows")
    return drift.join(filled, ["source_file", "column_name"])


@query
def val_rules(spark, sf):
    rows = _dirty_events(spark, sf).withColumn("value", F.nanvl("value", F.lit(0.0)) - 5)
    return quality.check_rules(rows, {**quality.required("event_id", "user_id"), **quality.positive("value")})


@query
def val_dates(spark, sf):
    o = table(spark, sf, "orders")
    text = F.when(F.col("o_orderkey") % 20 == 0, "31/31/2012").when(
        F.col("o_orderkey") % 20 != 1, F.date_format("o_orderdate", "M/d/yyyy")
    )
    return quality.check_dates(o.select(text.alias("policy_start_dt"), F.lit("soon").alias("dob")), ["policy_start_dt", "dob"])


@query
def eda_missing(spark, sf):
    found = profile.missing_values(_dirty_events(spark, sf))
    return found.withColumn("percentage", F.round("percentage", 6))


@query
def eda_stats(spark, sf):
    e = _dirty_events(spark, sf).drop("event_id")
    return profile.basic_stats(e).withColumns(
        {c: F.round(c, 6) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")}
    )


@query
def eda_corr(spark, sf):
    line = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
    return profile.correlations(line).withColumn("correlation", F.round("correlation", 6))


@query
def eda_histogram(spark, sf):
    found = profile.histogram(table(spark, sf, "events"), "value", 30)
    return found.withColumns({c: F.round(c, 6) for c in ("bin_start", "bin_end")})


@query
def eda_value_counts(spark, sf):
    return profile.value_counts(_dirty_events(spark, sf), "event_type")
