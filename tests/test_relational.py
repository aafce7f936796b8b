from __future__ import annotations

import pandas as pd
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from premia.operators import quantiles
from premia.operators.quantiles import column_quantiles, grouped_medians
from premia.operators.relational import (
    aggregations,
    join_tables,
    keep_first,
    marked_keys,
    split_dataframe,
    touched_rows,
    union_outer,
)
from premia.plans.dimensions import only_absent

L = [(1, "a"), (2, "b"), (None, "c")]
R = [(1, "x"), (1, "y"), (None, "z"), (3, "w")]


@pytest.mark.parametrize("hot_keys", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_join_is_that_of_pandas(spark, how, hot_keys):
    left = spark.createDataFrame(L, "k int, v string")
    right = spark.createDataFrame(R, "k int, v string")
    got = join_tables(left, right, "k", "k", how, hot_keys=hot_keys)
    want = pd.DataFrame(L, columns=["k", "v"]).merge(pd.DataFrame(R, columns=["k", "v"]), on="k", how=how)
    want = want.astype(object).where(want.notna(), None)
    assert got.columns == list(want.columns)
    assert rows(got) == sorted(
        ((None if r[0] is None else int(r[0]), *r[1:]) for r in want.itertuples(index=False)),
        key=lambda r: [(c is not None, str(c)) for c in r],
    )


def test_join_keeps_both_keys_of_different_names(spark):
    left = spark.createDataFrame([(1, 5)], "a int, v int")
    right = spark.createDataFrame([(1, 6)], "b int, v int")
    got = join_tables(left, right, "a", "b")
    assert got.columns == ["a", "v_x", "b", "v_y"]
    assert rows(got) == [(1, 5, 1, 6)]


def test_no_cross_join(spark):
    df = spark.createDataFrame(L, "k int, v string")
    with pytest.raises(ValueError, match="cross"):
        join_tables(df, df, "k", "k", "cross")


def test_aggregates_drop_null_keys_and_sum_nothing_to_zero(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), (None, 5, 3), ("b", 7, 4)], "k string, v int, o int")
    got = aggregations(df, ["k"], {"v": "sum", "o": "max"})
    assert rows(got) == [("a", 0, 2), ("b", 7, 4)]


def test_several_aggregates_of_a_column(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), ("a", 4), ("b", 7)], "k string, v int")
    got = aggregations(df, "k", {"v": ["count", "size", "median", "nunique", "max"]})
    assert got.columns == ["k", "v_count", "v_size", "v_median", "v_nunique", "v_max"]
    assert rows(got) == [("a", 2, 3, 3.0, 2, 4), ("b", 1, 1, 7.0, 1, 7)]


def test_first_and_last_skip_nulls(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 6, 3), ("a", None, 4)], "k string, v int, o int")
    assert rows(aggregations(df, ["k"], {"v": "first"}, ["o"])) == [("a", 5)]
    assert rows(aggregations(df, ["k"], {"v": "last"}, ["o"])) == [("a", 6)]
    with pytest.raises(ValueError, match="order_by"):
        aggregations(df, ["k"], {"v": "first"})
    with pytest.raises(ValueError, match="unknown"):
        aggregations(df, ["k"], {"v": "mode"})


def test_only_medians(spark):
    df = spark.createDataFrame([("a", 1), ("a", 4), ("b", None)], "k string, v int")
    assert rows(aggregations(df, ["k"], {"v": "median"})) == [("a", 2.5), ("b", None)]


def test_union_split_and_keep_first(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    c = spark.createDataFrame([(2, 2.0)], "a int, c double")
    assert rows(union_outer([a, c])) == [(1, "x", None), (2, None, 2.0)]
    df = spark.createDataFrame([(1, "f2", "b"), (1, "f1", "z"), (1, "f1", "c"), (None, "f1", "d"), (None, "f1", None)], "k int, f string, v string")
    assert rows(keep_first(df, ["k"], ["f"])) == [(None, "f1", None), (1, "f1", "c")]
    assert rows(keep_first(df.select("k"), ["k"])) == [(None,), (1,)]
    assert split_dataframe(df, ["k", "absent"]).count() == 2
    assert split_dataframe(df, ["k"], drop_duplicates=False).count() == 5


values = st.lists(
    st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_subnormal=False)), max_size=40
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values)
def test_quantiles_are_those_of_pandas(spark, xs):
    df = spark.createDataFrame([(i % 2, x) for i, x in enumerate(xs)], "k int, x double")
    series = pd.Series(xs, dtype=float)
    got = {r.prob: r.quantile for r in column_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()}
    if series.notna().any():
        assert got == pytest.approx({p: series.quantile(p) for p in (0.25, 0.5, 0.75)})
    else:
        assert got == {}
    want = series.groupby([i % 2 for i in range(len(xs))]).median().dropna().to_dict()
    assert dict(grouped_medians(df, ["k"], "x").collect()) == pytest.approx(want)


def test_quantiles_of_groups_of_any_size(spark):
    """Groups of 1, 1,000 and 1,000,000 rows, half of the large one a single value, and outliers."""
    ids = spark.range(1_001_001)
    key = F.when(F.col("id") == 0, 1).when(F.col("id") <= 1000, 1000).otherwise(1_000_000)
    noise = F.pmod(F.xxhash64("id"), F.lit(1 << 40)).cast("double") / 1000
    x = F.when(F.col("id") % 2 == 0, 77.0).when(F.col("id") % 1001 == 3, noise * 1e250).otherwise(noise)
    df = ids.select(key.alias("k"), x.alias("x"))
    exact = lambda c, p: F.expr(f"percentile({c}, {p})")
    want = {r.k: r.m for r in df.groupBy("k").agg(exact("x", 0.5).alias("m")).collect()}
    assert dict(grouped_medians(df, ["k"], "x").collect()) == pytest.approx(want)
    probs = [0.0, 0.25, 0.4999, 0.5, 0.501, 0.75, 1.0]
    want = dict(zip(probs, df.select(F.expr(f"percentile(x, array({', '.join(map(str, probs))}))")).first()[0]))
    got = {r.prob: r.quantile for r in column_quantiles(df, ["x"], probs).collect()}
    assert got == pytest.approx(want)


def test_brackets_that_miss_are_taken_back(spark, monkeypatch):
    """With a sketch far too coarse for its margin, steps miss their ranks; the result stays exact."""
    monkeypatch.setattr(quantiles, "K", 8)
    monkeypatch.setattr(quantiles, "MARGIN", 0.001)
    monkeypatch.setattr(quantiles, "INSIDE", 500)
    df = spark.range(4000).select((F.col("id") % 2).alias("k"), F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("double").alias("x"))
    want = {r.k: r.m for r in df.groupBy("k").agg(F.expr("percentile(x, 0.5)").alias("m")).collect()}
    assert dict(grouped_medians(df, ["k"], "x").collect()) == pytest.approx(want)
    got = {r.prob: r.quantile for r in column_quantiles(df, ["x"], [0.1, 0.9]).collect()}
    assert got == pytest.approx(dict(zip([0.1, 0.9], df.select(F.expr("percentile(x, array(0.1, 0.9))")).first()[0])))


def test_wide_brackets_are_sketched_again(spark, monkeypatch):
    """Brackets of 1/80 of the rows, of which 100 may stay: two rounds for a million values."""
    monkeypatch.setattr(quantiles, "INSIDE", 100)
    df = spark.range(1_000_000).select((F.col("id") % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(1 << 50)).cast("double").alias("x"))
    want = {r.k: r.m for r in df.groupBy("k").agg(F.expr("percentile(x, 0.5)").alias("m")).collect()}
    assert dict(grouped_medians(df, ["k"], "x").collect()) == pytest.approx(want, rel=1e-15)
    got = {r.prob: r.quantile for r in column_quantiles(df, ["x"], [0.0, 0.001, 0.3, 1.0]).collect()}
    exact = df.select(F.expr("percentile(x, array(0.0, 0.001, 0.3, 1.0))")).first()[0]
    assert got == pytest.approx(dict(zip([0.0, 0.001, 0.3, 1.0], exact)), rel=1e-15)


def _dimension(spark, n):
    return spark.range(n).select(F.when(F.col("id") > 0, F.concat(F.lit("p"), "id")).alias("k"), F.col("id").alias("v"))


def test_touched_rows_keep_all_that_a_batch_can_meet(spark):
    dim = _dimension(spark, 50_000)
    batch = _dimension(spark, 50_000).where("v % 1000 = 0").select("k").union(spark.createDataFrame([("new",)], "k string"))
    batch = batch.union(batch)
    got = touched_rows(dim, ["k"], marked_keys(batch, ["k"]))
    assert got.columns == dim.columns
    met = {r.v for r in got.collect()}
    assert set(range(0, 50_000, 1000)) <= met and len(met) < 60
    # With few marks more rows pass, but none is lost.
    few = {r.v for r in touched_rows(dim, ["k"], marked_keys(batch, ["k"], 256), 256).collect()}
    assert met <= few | met and set(range(0, 50_000, 1000)) <= few and len(few) < 25_000
    assert marked_keys(dim, ["k"], 256).count() <= 4
    assert rows(only_absent(batch.distinct(), got, ["k"])) == [("new",)]


def test_touched_rows_of_empty_frames(spark):
    dim = _dimension(spark, 10)
    nothing = dim.limit(0)
    assert touched_rows(dim, ["k"], marked_keys(nothing, ["k"])).count() == 0
    assert touched_rows(nothing, ["k"], marked_keys(dim, ["k"])).count() == 0
