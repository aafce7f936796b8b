from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from premia.functions import hash_key
from premia.operators.history import apply_customer_batch, first_load, scd_type_1, scd_type_2
from premia.schemas import TABLES

OPEN = dt.date(9999, 12, 31)
JAN, FEB = dt.date(2020, 1, 1), dt.date(2020, 2, 1)


def test_scd1_overwrites_with_what_is_given(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "c", "z")], "k int, v string, t string")
    source = spark.createDataFrame([(1, None, "s1"), (2, "B", "s2"), (3, "D", "s3"), (None, "C", "s4")], "k int, v string, s string")
    assert rows(scd_type_1(source, target, "k")) == [
        (None, "C", "z", None),
        (1, "a", "x", None),
        (2, "B", "y", None),
        (3, "D", None, "s3"),
    ]


def test_scd1_is_one_join_and_takes_any_column_names(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, s_v string")
    source = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    out = scd_type_1(source, target, "k")
    assert rows(out) == [(1, "a", "x"), (2, "c", "y"), (3, "d", None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_scd1_wants_unique_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="duplicate"):
        scd_type_1(target.union(target), target, "k")


EXISTING = [(10, "a", "Ann", "x"), (11, "b", "Bob", None), (12, "c", "Cid", "z"), (13, "d", "ab", "c")]
NEW = [("a", "Ann", "x"), ("b", "Bob", "y"), ("e", "Eve", "w"), ("d", "a", "bc")]


def test_scd2(spark):
    existing = spark.createDataFrame(EXISTING, "customer_sk int, customer_id string, name string, status string")
    new = spark.createDataFrame(NEW, "customer_id string, name string, status string")
    inserts, expired = scd_type_2(new, existing, ["customer_id"], ["name", "status"], JAN)
    # a is unchanged, c not in the batch; d changes although its texts run together to the same
    assert rows(inserts) == [
        ("b", "Bob", "y", 1, JAN, OPEN),
        ("d", "a", "bc", 1, JAN, OPEN),
        ("e", "Eve", "w", 1, JAN, OPEN),
    ]
    assert rows(expired) == [(11, 0, JAN), (13, 0, JAN)]
    inserts, expired = scd_type_2(new, existing.drop("customer_sk"), ["customer_id"], ["name", "status"], JAN)
    assert inserts.count() == 3
    assert expired is None


def test_scd2_new_keys_may_start_when_the_feed_says(spark):
    existing = spark.createDataFrame([], "customer_sk int, customer_id string, name string")
    new = spark.createDataFrame([("a", "Ann", FEB), ("b", "Bob", None)], "customer_id string, name string, effective_start_dt date")
    inserts, _ = scd_type_2(new, existing, ["customer_id"], ["name"], JAN, new_key_start="effective")
    assert [r.eff_start_dt for r in inserts.orderBy("customer_id").collect()] == [FEB, dt.date(1900, 1, 1)]
    assert rows(first_load(new).select("eff_start_dt", "current_flag")) == [(dt.date(1900, 1, 1), 1), (FEB, 1)]
    with pytest.raises(ValueError, match="new_key_start"):
        scd_type_2(new, existing, ["customer_id"], ["name"], JAN, new_key_start="never")


def test_hash_keys_tell_rows_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("", None), (None, ""), (None, None)], "a string, b string")
    assert df.select(hash_key(F.col("a"), F.col("b"))).distinct().count() == 5


batches = st.lists(
    st.dictionaries(st.sampled_from("abcd"), st.sampled_from(["S", "M", None]), min_size=1), min_size=1, max_size=3
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches)
def test_history_invariants(spark, days):
    """Against a plain model: one current row per customer, versions that meet but do not overlap, repeatable loads."""
    current = spark.createDataFrame([], TABLES["dim_customer"])
    closed: list[tuple] = []
    model: dict[str, list[list]] = {}
    for i, batch in enumerate(days):
        as_of = JAN + dt.timedelta(days=i)
        new = spark.createDataFrame(
            [(k, "n", "s", v, "g", "r", None, None) for k, v in batch.items()],
            "customer_id string, customer_name string, customer_segment string, marital_status string, "
            "gender string, region string, effective_start_dt date, dob date",
        )
        now = F.lit(dt.datetime(2020, 1, 1))
        result = apply_customer_batch(current, new, as_of, now).collect()
        after = spark.createDataFrame([r for r in result if r.current_flag == 1], TABLES["dim_customer"])
        again = apply_customer_batch(after, new, as_of, now)
        assert rows(again) == rows(after)
        closed += [(r.customer_id, r.marital_status, r.eff_start_dt, r.eff_end_dt) for r in result if r.current_flag == 0]
        current = after
        for k, v in batch.items():
            versions = model.setdefault(k, [])
            if not versions:
                versions.append([k, v, dt.date(1900, 1, 1), OPEN])
            elif versions[-1][1] != v:
                versions[-1][3] = as_of
                versions.append([k, v, as_of, OPEN])
    now_open = [(r.customer_id, r.marital_status, r.eff_start_dt, r.eff_end_dt) for r in current.collect()]
    want = [tuple(v) for versions in model.values() for v in versions]
    assert sorted(now_open + closed, key=str) == sorted(want, key=str)
    assert len({r[0] for r in now_open}) == len(now_open) == len(model)
