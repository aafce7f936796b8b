"""What the physical plans must show so that they hold on large and skewed tables."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from conftest import SF

import __spark_entry__ as entry
from bindings import views
from bindings.queries import QUERIES
from premia.operators.relational import keep_first, marked_keys, touched_rows
from premia.plans import reports
from premia.plans.dimensions import only_absent
from premia.session import RUNTIME_CONF, shared_dir, tune


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    """Plans as for large tables."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


LAZY = [n for n in QUERIES if not n.startswith(("pipe_", "src_", "sink_", "load_", "val_schema_drift"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairs_of_all_rows(no_broadcast, name):
    text = plan(entry.queries()[name](no_broadcast, SF))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|SinglePartition\b.*Window", text)


@pytest.mark.parametrize("name", LAZY)
def test_nothing_is_broadcast_unchecked(no_broadcast, name):
    """With a size limit of nothing there must be no broadcast: no hint overrides the check of sizes."""
    assert "BroadcastHashJoin" not in plan(entry.queries()[name](no_broadcast, SF))


def test_the_penalty_table_is_small_enough_to_be_broadcast(spark):
    assert plan(entry.queries()["join_late_fee"](spark, SF)).count("BroadcastHashJoin") >= 1


def test_first_rows_are_found_before_the_shuffle(spark):
    text = plan(keep_first(views.table(spark, SF, "orders"), ["o_custkey"], ["o_orderkey"]))
    assert text.index("partial_min") > text.index("Exchange")
    assert "Window" not in text


def test_a_dimension_is_cut_to_the_keys_of_the_batch_before_its_shuffle(no_broadcast, tmp_path):
    path = f"{tmp_path}/dim"
    views.table(no_broadcast, SF, "orders").select("o_custkey", "o_orderkey").write.parquet(path)
    batch, dim = views.table(no_broadcast, SF, "customer").select(views.F.col("c_custkey").alias("o_custkey")), no_broadcast.read.parquet(path)
    text = plan(only_absent(batch, touched_rows(dim, ["o_custkey"], marked_keys(batch, ["o_custkey"])), ["o_custkey"]))
    # Upwards from the scan of the dimension: the marks first, then the exchange by key.
    above = text[: text.index(path)]
    assert above.rindex("BroadcastHashJoin") > above.rindex("Exchange hashpartitioning(coalesce(o_custkey")


def test_reports_count_transactions_before_the_join(no_broadcast):
    text = plan(reports.amounts_by_customer(views.Warehouse(no_broadcast, SF)))
    assert "partial_count" in text
    assert re.search(r"SortMergeJoin \[policy_sk.*(?:\n.*){3}HashAggregate\(keys=\[customer_sk", text)


def test_scans_read_only_the_columns_needed(spark):
    text = plan(entry.queries()["rpt_c"](spark, SF))
    schemas = re.findall(r"lineitem.*?ReadSchema: (struct<[^>]*>)", text)
    assert schemas == ["struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>"]


def test_year_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    views.dim_policy(spark, SF).write.parquet(path)
    tables = {**views.Warehouse(spark, SF), "dim_policy": spark.read.parquet(path)}
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(reports.amounts_by_term(tables))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[([^]]*policy_start_dt[^]]*)", text).group(1)
    assert "GreaterThanOrEqual(policy_start_dt,2012-01-01)" in pushed
    assert "LessThan(policy_start_dt,2013-01-01)" in pushed


def test_null_keys_spread_in_the_listing(no_broadcast):
    text = plan(reports.full_listing(views.Warehouse(no_broadcast, SF)))
    assert re.search(r"hashpartitioning\(address_sk#\w+, _spread#\w+", text)


def test_hot_keys_are_split(spark):
    """A customer with a third of all transactions: adaptive execution splits its join partition."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        from premia.operators.links import link_customer_version

        facts = spark.range(0, 60_000, 1, 8).selectExpr(
            "id", "cast(if(id % 3 = 0, 0, id % 1000) as string) as customer_id", "date'2020-01-01' as txn_date"
        )
        dim = spark.range(1000).selectExpr(
            "cast(id as string) as customer_sk", "cast(id as string) as customer_id",
            "date'1900-01-01' as eff_start_dt", "date'9999-12-31' as eff_end_dt",
        )
        linked = link_customer_version(facts, dim)
        assert len(linked.collect()) == 60_000
        assert "skew=true" in plan(linked)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_settings(spark):
    spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
    tune(spark)
    assert all(spark.conf.get(k) == v for k, v in RUNTIME_CONF.items())


def test_working_folder_is_the_one_the_cluster_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark), shared_dir(spark)
    assert first.startswith(base + "/") and first != second
