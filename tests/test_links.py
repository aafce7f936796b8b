from __future__ import annotations

import bisect
import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from premia.operators import links

DAY = dt.date(2020, 1, 10)
OPEN = dt.date(9999, 12, 31)


def test_customer_version_on_the_day_of_a_change(spark):
    dim = spark.createDataFrame(
        [("a1", "a", dt.date(1900, 1, 1), DAY), ("a2", "a", DAY, OPEN)],
        "customer_sk string, customer_id string, eff_start_dt date, eff_end_dt date",
    )
    facts = spark.createDataFrame(
        [("a", DAY), ("a", DAY - dt.timedelta(1)), ("a", None), ("b", DAY), (None, DAY)], "customer_id string, txn_date date"
    )
    both = links.link_customer_version(facts, dim, "both")
    assert rows(both) == [("a", DAY - dt.timedelta(1), "a1"), ("a", DAY, "a1"), ("a", DAY, "a2")]
    left = links.link_customer_version(facts, dim, "left")
    assert rows(left) == [("a", DAY - dt.timedelta(1), "a1"), ("a", DAY, "a2")]
    with pytest.raises(ValueError, match="closed"):
        links.link_customer_version(facts, dim, "right")


def test_policy_link_fans_out(spark):
    dim = spark.createDataFrame([("p1", "p"), ("p2", "p")], "policy_sk string, policy_id string")
    facts = spark.createDataFrame([("p", 1), ("q", 2)], "policy_id string, n int")
    assert rows(links.link_policy(facts, dim)) == [("p", 1, "p1"), ("p", 1, "p2"), ("q", 2, None)]


def test_policy_version_against_a_search(spark):
    """One policy has a third of all transactions and versions; dates repeat, some are missing."""
    rng = random.Random(1)
    first = dt.date(2020, 1, 1)
    days = [first + dt.timedelta(rng.randrange(300)) for _ in range(400)]
    versions = {(f"p{0 if i % 3 == 0 else i % 7}", d) for i, d in enumerate(days)}
    dim_rows = [(f"{p}/{d}", p, "t", d) for p, d in sorted(versions)]
    fact_rows = [
        (f"p{0 if i % 3 == 0 else i % 9}", None if i % 50 == 0 else first + dt.timedelta(rng.randrange(-20, 320)))
        for i in range(2000)
    ]
    dim = spark.createDataFrame(dim_rows, "policy_sk string, policy_id string, policy_type string, policy_start_dt date")
    facts = spark.createDataFrame(fact_rows, "policy_id string, txn_date date")
    starts: dict[str, list[dt.date]] = {}
    for p, d in sorted(versions):
        starts.setdefault(p, []).append(d)

    def expected(p, day):
        if p not in starts:
            return None
        at = bisect.bisect_right(starts[p], day) - 1 if day else 0
        return f"{p}/{starts[p][max(at, 0)]}"

    got = links.link_policy_version(facts, dim)
    assert rows(got) == sorted(
        ((p, d, expected(p, d)) for p, d in fact_rows), key=lambda r: [(c is not None, str(c)) for c in r]
    )


def test_versions_that_start_on_one_day_do_not_multiply_rows(spark):
    dim = spark.createDataFrame(
        [("k1", "p", "b", DAY), ("k2", "p", "a", DAY)],
        "policy_sk string, policy_id string, policy_type string, policy_start_dt date",
    )
    facts = spark.createDataFrame([("p", DAY)] * 3, "policy_id string, txn_date date")
    assert rows(links.link_policy_version(facts, dim)) == [("p", DAY, "k2")] * 3


def test_address_link_with_and_without_postal_code(spark):
    dim = spark.createDataFrame([("a1", "a", "1"), ("a2", "a", "2")], "address_sk string, customer_id string, postal_code string")
    facts = spark.createDataFrame([("a", "2"), ("a", "3")], "customer_id string, postal_code string")
    assert rows(links.link_address(facts, dim)) == [("a", "2", "a2"), ("a", "3", None)]
    assert rows(links.link_address(facts.select("customer_id").distinct(), dim)) == [("a", "a1"), ("a", "a2")]


def test_late_fee_link(spark):
    facts = spark.createDataFrame([(-1,), (0,), (60,), (61,)], "late_duration_months int")
    assert rows(links.link_late_fee(facts, links.late_fee_bands(spark))) == [(-1, None), (0, 0), (60, 60), (61, None)]
    bands = links.late_fee_bands(spark).collect()
    assert len(bands) == 61
    assert (str(bands[5].penalty_percent), bands[5].description) == ("0.0250", "5 Months Delay")


def test_left_join_with_null_keys_loses_and_adds_nothing(spark):
    left = spark.createDataFrame([(i, None if i % 3 else i % 5) for i in range(60)], "i int, fk int")
    right = spark.createDataFrame([(0, "zero"), (1, "one"), (None, "none")], "k int, v string")
    got = links.left_join_nullable(left, right, "fk", "k").select("i", "fk", "v")
    want = left.join(right, left.fk == right.k, "left").select("i", "fk", "v")
    assert rows(got) == rows(want)


def test_derived_addresses_are_not_broadcast(spark):
    people = spark.range(10).select(F.col("id").cast("string").alias("customer_id"))
    dim = people.select("customer_id", F.explode(F.array(*[F.lit(str(i)) for i in range(9)])).alias("postal_code"))
    dim = dim.withColumn("address_sk", F.concat("customer_id", F.lit("-"), "postal_code"))
    facts = spark.createDataFrame([("1", "3"), ("1", "3"), ("1", "x"), (None, "3"), ("2", None)], "customer_id string, postal_code string")
    linked = links.link_address(facts, dim)
    plan = linked._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert rows(linked) == rows(spark.createDataFrame([("1", "3", "1-3"), ("1", "3", "1-3"), ("1", "x", None), (None, "3", None), ("2", None, None)], linked.schema))
