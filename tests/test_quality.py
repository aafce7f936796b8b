from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from premia.operators import profile, quality

NAN = float("nan")
DATA = [(1, "a", 1.0), (1, "a", 1.0), (None, None, NAN), (None, None, NAN), (3, "b", None)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(DATA, "k int, s string, x double")


def test_nulls_count_not_a_number_too(df):
    assert rows(quality.check_nulls(df)) == [("k", 2), ("s", 2), ("x", 3)]
    assert rows(quality.check_nulls(df, ["s"])) == [("s", 2)]


def test_duplicates(spark, df):
    assert quality.check_duplicates(df).first()[0] == 2
    assert quality.check_duplicates(df, ["s"]).first()[0] == 2
    assert quality.check_duplicates(spark.createDataFrame([], "a int")).first()[0] == 0


def test_orphans(spark, df):
    dim = spark.createDataFrame([(1,), (1,)], "id int")
    assert rows(quality.check_referential_integrity(df, dim, "k", "id").select("k")) == [(None,), (None,), (3,)]
    with_null = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(quality.check_referential_integrity(df, with_null, "k", "id").select("k")) == [(3,)]


def test_report(spark, df):
    assert quality.validation_report(df).first()[:] == (5, 3, 7, 2, "k int, s string, x double")
    none = spark.createDataFrame([], "a int")
    assert quality.validation_report(none).first()[:] == (0, 1, 0, 0, "a int")


def test_schema_rules_and_dates(spark, df):
    assert rows(quality.check_schema(df, ["k", "z"])) == [
        ("k", "present", 3),
        ("s", "unexpected", 3),
        ("x", "unexpected", 2),
        ("z", "missing", 0),
    ]
    rules = {**quality.required("s"), **quality.positive("k"), "x below 2": F.col("x") < 2}
    assert rows(quality.check_rules(df, rules)) == [("k is positive", 0), ("s is given", 2), ("x below 2", 3)]
    blank = spark.createDataFrame([("",), ("7",), (None,)], "id string")
    assert rows(quality.check_rules(blank, quality.required("id"))) == [("id is given", 2)]
    raw = spark.createDataFrame([("1/2/2012",), ("13/13/2012",), (None,)], "d string")
    assert rows(quality.check_dates(raw, ["d"])) == [("d", 1)]
    assert quality.has_any(df, "z", "k") and not quality.has_any(df, "z")


def test_missing_values(spark, df):
    got = [tuple(r) for r in profile.missing_values(df).collect()]
    assert got == [("x", 3, 60.0), ("k", 2, 40.0), ("s", 2, 40.0)]
    assert profile.missing_values(spark.createDataFrame([], "a int")).collect() == []


def test_stats_are_those_of_pandas(spark):
    pdf = pd.DataFrame({"n": [1, 2, 2, 9], "x": [0.5, None, 2.5, -1.0], "s": ["b", "a", "b", None]})
    df = spark.createDataFrame(
        [(1, 0.5, "b", dt.date(1970, 1, 2)), (2, None, "a", None), (2, 2.5, "b", None), (9, -1.0, None, None)],
        "n int, x double, s string, d date",
    )
    got = {r.column_name: r.asDict() for r in profile.basic_stats(df).collect()}
    want = pdf.describe(include="all")
    names = {"25%": "p25", "50%": "p50", "75%": "p75"}
    for col in ("n", "x"):
        for stat in ("count", "mean", "std", "min", "25%", "50%", "75%", "max"):
            assert got[col][names.get(stat, stat)] == pytest.approx(want[col][stat])
        assert got[col]["unique"] is None
    assert [got["s"][k] for k in ("count", "unique", "top", "freq")] == [3, 2, "b", 2]
    assert [got["d"][k] for k in ("count", "min", "p50", "max")] == [1, 86400.0, 86400.0, 86400.0]


def test_stats_of_times_take_the_wall_clock(spark):
    df = spark.sql("select timestamp_ntz'1970-01-02 01:02:03.5' as a, timestamp'1970-01-01 00:00:07' as b, date'1970-01-03' as c")
    got = {r.column_name: r.p50 for r in profile.basic_stats(df).collect()}
    assert got == {"a": 86400 + 3723.5, "b": 7.0, "c": 2 * 86400.0}


def test_correlations_are_those_of_pandas(spark):
    pdf = pd.DataFrame({"a": [1, 2, 3, 5], "b": [2.0, NAN, 1.0, 0.0], "c": [1.0, 1.0, 1.0, 1.0]})
    want = pdf.corr()
    got = {(r.column_x, r.column_y): r.correlation for r in profile.correlations(spark.createDataFrame(pdf)).collect()}
    assert len(got) == 9
    for (x, y), r in got.items():
        assert (r is None or r != r) if pd.isna(want.loc[x, y]) else r == pytest.approx(want.loc[x, y])


@pytest.mark.parametrize("gaps", [False, True])
def test_correlations_of_many_columns_are_those_of_pandas(spark, gaps):
    rng = np.random.default_rng(5)
    values = rng.normal(size=(300, 200)) + 1e6
    values[:, 1] = values[:, 0] * -2
    values[:, 2] = 7.1
    if gaps:
        values[rng.random(values.shape) < 0.3] = NAN
        values[:, 3] = NAN
        values[5:, 4] = NAN
        values[:, 6] = np.where(np.isnan(values[:, 5]), np.arange(300), 3.0)  # constant where column 5 is given
    pdf = pd.DataFrame(values, columns=[f"n{i}" for i in range(200)])
    want = pdf.corr()
    got = profile.correlations(spark.createDataFrame(pdf).repartition(5)).toPandas()
    assert len(got) == 200 * 200
    got = got.pivot(index="column_x", columns="column_y", values="correlation").loc[want.index, want.columns]
    if gaps:
        assert got.loc["n5", "n6"] is None or np.isnan(got.loc["n5", "n6"])
        want.loc["n5", "n6"] = want.loc["n6", "n5"] = NAN
    np.testing.assert_allclose(got.to_numpy(dtype=float), want.to_numpy(), rtol=0, atol=1e-6)


def test_the_two_ways_to_correlations_agree(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, 4.0), (3, 5.0, 1.0), (9, 1.0, 1.0)], "a int, b double, c double")
    near = rows(profile.correlations(df).selectExpr("column_x", "column_y", "round(correlation, 9)"))
    assert rows(profile.correlations(df, wide=0).selectExpr("column_x", "column_y", "round(correlation, 9)")) == near
    empty = rows(profile.correlations(df.limit(0)))
    assert rows(profile.correlations(df.limit(0), wide=0)) in (empty, [])


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 1, 9, 10)] + [(None,), (NAN,)], "v double")
    got = profile.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r.rows for r in got] == [3, 0, 0, 0, 2]
    assert [r.bin_start for r in got] == pytest.approx([0, 2, 4, 6, 8])
    one = profile.histogram(df.filter("v = 1"), "v", 2).orderBy("bin").collect()
    assert [(r.bin_start, r.rows) for r in one] == [(0.5, 0), (1.0, 2)]
    assert profile.histogram(df.filter("v is null"), "v").collect() == []


def test_value_counts(spark, df):
    assert [tuple(r) for r in profile.value_counts(df, "s").collect()] == [("a", 2), ("b", 1)]


def _headers(spark, **files):
    cells = [(f"{n}.csv", int(n[-1]), i, c, c.lower()) for n, header in files.items() for i, c in enumerate(header.split())]
    return spark.createDataFrame(cells, "source_file string, batch_day int, position int, written string, column_name string")


def test_schema_drift(spark):
    headers = _headers(spark, a_day1="x y z", a_day2="x Y new z", a_day4="z x Y", b_day1="x x y", b_day2="x y x")
    got = rows(quality.schema_drift(headers).select("source_file", "column_name", "change", "position", "position_before"))
    assert sorted(got, key=str) == sorted([
        ("a_day2.csv", "y", "respelled", 1, 1), ("a_day2.csv", "new", "added", 2, None),
        ("a_day4.csv", "new", "lost", None, 2), ("a_day4.csv", "z", "moved", 0, 3), ("a_day4.csv", "x", "moved", 1, 0),
        ("b_day2.csv", "y", "moved", 1, 2), ("b_day2.csv", "x", "moved", 2, 1),
    ], key=str)
    unknown = quality.schema_drift(headers, ["x", "y", "z"]).filter("change = 'unknown'")
    assert rows(unknown.select("source_file", "column_name")) == [("a_day2.csv", "new")]
    assert quality.schema_drift(headers.limit(0), ["x"]).count() == 0
