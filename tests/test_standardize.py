from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from premia.functions import date_key, date_of_key, in_year, title_case
from premia.functions.text import WHITE_SPACE, strip_space
from premia.operators import standardize as std
from premia.operators.policies import calculate_late_fees, construct_customer_name, installments
from premia.schemas import TABLES


@pytest.mark.parametrize(
    ("raw", "name"),
    [
        ("Customer ID", "customer_id"),
        ("  State or Province ", "state_or_province"),
        ("Maritial_Status", "maritial_status"),
        ("__A--b  c!", "a_b_c"),
        ("Straße", "stra_e"),
    ],
)
def test_snake_case(raw, name):
    assert std.snake_case(raw) == name


def test_columns_that_share_a_name_keep_the_first(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["Last Name", "x", "Last name"])
    assert std.standardize_columns(df).collect()[0].asDict() == {"last_name": "a", "x": "b"}


def test_rename(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["policy_type", "state_or_province", "maritial_status"])
    assert std.rename_columns(df).columns == ["policy_type_name", "state_province", "marital_status"]


def test_trim_takes_all_white_space_and_keeps_null(spark):
    df = spark.createDataFrame([("\t a b  \n", 1), (None, 2), ("\x1c", 3)], ["s", "n"])
    assert rows(std.trim_strings(df)) == [(None, 2), ("", 3), ("a b", 1)]


def test_country_keeps_what_is_not_listed(spark):
    given = ["US", " usa ", "U.S", "u.s.", "United States Of America", "U.S.A", "Canada", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(given)], ["i", "country"])
    assert [r[1] for r in rows(std.clean_country(df))] == ["USA"] * 5 + ["U.S.A", "Canada", None]
    more = std.clean_country(df, spellings=("u.s.a",))
    assert [r[1] for r in rows(more)][5] == "USA"


def test_currency(spark):
    texts = ["$1,234.50", "5000", "-7", "1e3", " 12 ", "n/a", "", "nan", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], ["i", "amt"])
    got = [r[1] for r in rows(std.clean_currency(df, ["amt", "absent"]))]
    assert got == [Decimal("1234.50"), 5000, -7, 1000, 12, None, None, None, None]


def test_dates(spark):
    texts = ["3/8/1996", "12/31/2099", "31/12/2012", "2012-01-02", "soon", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], ["i", "dob"])
    got = [r[1] for r in rows(std.parse_dates(df))]
    assert got == [dt.date(1996, 3, 8), dt.date(2099, 12, 31), None, dt.date(2012, 1, 2), None, None, None]
    again = std.parse_dates(std.parse_dates(df))
    assert [r[1] for r in rows(again)] == got
    iso = std.parse_dates(df, formats="yyyy-MM-dd")
    assert [r[1] for r in rows(iso)][3] == dt.date(2012, 1, 2)


def test_ids_and_postal_codes(spark):
    df = spark.createDataFrame([(" 7\t", "00123.0"), (None, None)], ["customer_id", "postal_code"])
    assert rows(std.normalize_postal(std.normalize_ids(df))) == [("", ""), ("7", "00123")]


def test_date_keys(spark):
    df = spark.createDataFrame([(dt.date(2012, 3, 9),), (None,)], "d date")
    keyed = df.select(date_key(F.col("d")).alias("k"))
    assert rows(keyed) == [(0,), (20120309,)]
    assert rows(keyed.select(date_of_key(F.col("k")))) == [(None,), (dt.date(2012, 3, 9),)]


def test_year_range(spark):
    days = [dt.date(2011, 12, 31), dt.date(2012, 1, 1), dt.date(2012, 12, 31), dt.date(2013, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert rows(df.filter(in_year(F.col("d"), 2012))) == [(days[1],), (days[2],)]


def test_value_map_and_region_lookup(spark):
    df = spark.createDataFrame([(" M ", "TX"), ("Female", "ZZ"), ("x", None)], ["gender", "state_province"])
    mapped = std.map_values(df, {"gender": {"Male": ["m", "male"], "Female": ["f", "female"]}, "absent": {"a": ["b"]}})
    assert [r[0] for r in mapped.collect()] == ["Male", "Female", "x"]
    lookup = spark.createDataFrame([("TX", "South")], ["state_province", "region"])
    assert rows(std.region_of_state(mapped, lookup).select("state_province", "region")) == [
        (None, None),
        ("TX", "South"),
        ("ZZ", None),
    ]


def test_project_to_adds_absent_columns(spark):
    df = spark.createDataFrame([("1", "x")], ["policy_type_id", "extra"])
    out = std.project_to(df, TABLES["dim_policy_type"])
    assert out.columns == ["policy_type_id", "policy_type_name", "policy_type_desc"]
    assert rows(out) == [("1", None, None)]


@pytest.mark.parametrize("text", ["o'brien mc-donald 3rd", "ÉCOLE ñandú", "x", "", "a1b2", "they're  bill's"])
def test_title_case_is_that_of_python(spark, text):
    df = spark.createDataFrame([(text,)], ["s"])
    assert df.select(title_case(F.col("s"))).first()[0] == text.title()


def test_customer_name_fills_only_what_is_missing(spark):
    schema = "customer_name string, customer_title string, customer_first_name string, customer_last_name string"
    df = spark.createDataFrame(
        [(None, "mr.", " ANNA  b", "o'brien"), ("jOHN qUILL", "x", "y", "z"), (None, None, None, None)], schema
    )
    assert [r[0] for r in construct_customer_name(df).collect()] == ["Mr. Anna B O'Brien", "jOHN qUILL", ""]
    plain = spark.createDataFrame([("n",)], ["customer_name"])
    assert construct_customer_name(plain) is plain


def late(spark, days, premium="100.00"):
    due = dt.date(2013, 1, 1)
    rows = [(i, None if d is None else due + dt.timedelta(d), due, Decimal(premium)) for i, d in enumerate(days)]
    schema = "i int, actual_premium_paid_dt date, next_premium_dt date, premium_amt decimal(18,2)"
    return calculate_late_fees(spark.createDataFrame(rows, schema)).orderBy("i").collect()


def test_late_months_round_half_to_even(spark):
    days = {5: 0, 10: 0, 15: 0, 20: 1, 45: 2, 75: 2, 91: 3, 178: 6, 275: 9, 366: 12, -45: -2, -15: 0, None: 0}
    got = late(spark, list(days))
    assert [r.late_duration_months for r in got] == list(days.values())
    assert [r.late_duration_days for r in got] == list(days)


def test_late_fee_has_no_limit_and_none_for_early_payers(spark):
    got = late(spark, [150, 180, -300, 30 * 100, None], "5000.00")
    assert [r.late_fee_amount for r in got] == [125, 150, 0, 2500, 0]
    assert [r.total_amount_to_pay for r in got] == [5125, 5150, 5000, 7500, 5000]
    assert [r.late_fee_pct for r in got][:2] == [Decimal("0.025"), Decimal("0.030")]


def test_late_fee_needs_its_columns(spark):
    df = spark.createDataFrame([(1,)], ["premium_amt"])
    assert calculate_late_fees(df) is df


def test_installments(spark):
    schema = "total_policy_amt decimal(18,2), premium_amt decimal(18,2), premium_amt_paid_tilldate decimal(18,2)"
    data = [(Decimal(1000), Decimal(300), Decimal(600)), (Decimal(1000), Decimal(0), None)]
    got = installments(spark.createDataFrame(data, schema)).collect()
    assert [(r.installment_count, r.remaining_amount) for r in got] == [(4, 400), (None, 1000)]


def test_strip_space_looks_characters_up_only_at_odd_ends(spark):
    cells = ["", " ", "a", " a", "a ", "\ta b\x1c", "\x7fa\x7f", " é ", "é", "éa", "aé", "a\x85", "　", "!", "~", "漢 字", "\x00a", None]
    found = spark.createDataFrame([(c,) for c in cells], "c string").select("c", strip_space(F.col("c")).alias("got"))
    assert "CASE WHEN" in found._jdf.queryExecution().optimizedPlan().toString().upper()
    assert all(r.got == (None if r.c is None else r.c.strip(WHITE_SPACE)) for r in found.collect())
