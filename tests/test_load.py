from __future__ import annotations

import datetime as dt
from decimal import Decimal

import feeds
import pytest
from conftest import rows
from pyspark.sql import functions as F

from premia.plans.daily_load import load_day, load_folder
from premia.schemas import TABLES
from premia.sources.files import read_day, scan_archives
from premia.sources.tables import ConcurrentLoad, Warehouse
from premia.streaming.daily import load_arriving_days

NOW = dt.datetime(2024, 1, 1)
OPEN = dt.date(9999, 12, 31)
START = dt.date(2011, 5, 31)
CHANGE = dt.date(2014, 1, 1)


def as_of(day):
    return CHANGE if day == 2 else dt.date(2012 + day, 1, 1)


def snapshot(warehouse) -> dict[str, list]:
    return {t: rows(warehouse.read(t)) for t in TABLES}


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("load")
    return load_folder(spark, feeds.write(base / "in"), str(base / "out"), as_of, NOW)


def test_customer_history(two_days):
    got = two_days.read("dim_customer").select(
        "customer_id", "customer_name", "marital_status", "customer_segment", "eff_start_dt", "eff_end_dt", "current_flag"
    )
    assert rows(got) == [
        ("1", "Mr. Anna O'Hara", "Married", "Corporate", CHANGE, OPEN, 1),
        ("1", "Mr. Anna O'Hara", "Single", "Corporate", START, CHANGE, 0),
        ("2", "Mrs. Bea Q Lund", "Married", "Corporate", START, OPEN, 1),
        ("3", "cARL dOE", "Single", "Corporate", START, OPEN, 1),
        ("4", "Dora Fox", "Divorced", "Consumer", CHANGE, OPEN, 1),
        ("4", "Dora Fox", "Divorced", "Corporate", START, CHANGE, 0),
        ("5", "Edgar, Jr.", "Single", "Corporate", START, OPEN, 1),
    ]
    assert {r.dob for r in two_days.read("dim_customer").collect()} == {dt.date(1980, 7, 9)}


def test_other_dimensions_hold_each_key_once(two_days):
    assert rows(two_days.read("dim_policy_type").select("policy_type_id")) == [("10",), ("11",), ("12",)]
    assert rows(two_days.read("dim_policy").select("policy_id", "policy_start_dt")) == [
        ("10_1", dt.date(2008, 11, 20)),
        ("11_1", dt.date(2012, 1, 5)),
        ("11_2", dt.date(2012, 1, 6)),
        ("11_2", dt.date(2013, 2, 6)),
        ("12_1", dt.date(2013, 2, 2)),
    ]
    assert rows(two_days.read("dim_address").select("customer_id", "postal_code", "country")) == [
        ("1", "01234", "USA"),
        ("1", "65299", "USA"),
        ("2", "65210", "U.S.A"),
        ("3", "10001", "USA"),
        ("4", "10002", "USA"),
        ("5", "10003", "USA"),
    ]
    assert two_days.read("dim_late_fee").count() == 61
    days = two_days.read("dim_date")
    assert days.agg(F.min("dt"), F.max("dt")).first()[:] == (dt.date(2013, 3, 1), dt.date(2014, 8, 4))
    assert days.count() == days.select("dt").distinct().count()


def test_one_fact_per_feed_row(two_days):
    fact = two_days.read("fact_policy_txn")
    customer = two_days.read("dim_customer").select("customer_sk", "customer_id", "marital_status", "eff_start_dt")
    policy = two_days.read("dim_policy").select("policy_sk", "policy_id", "policy_start_dt")
    address = two_days.read("dim_address").select("address_sk", "postal_code")
    got = fact.join(customer, "customer_sk").join(policy, "policy_sk").join(address, "address_sk").select(
        "customer_id", "date_sk", "marital_status", "eff_start_dt", "policy_start_dt", "postal_code", "late_fee_sk", "late_fee"
    )
    assert fact.count() == 8
    assert rows(got) == [
        ("1", 20130904, "Single", START, dt.date(2008, 11, 20), "01234", 6, Decimal("150.00")),
        ("1", 20140210, "Married", CHANGE, dt.date(2008, 11, 20), "65299", 8, Decimal("200.00")),
        ("2", 20130320, "Married", START, dt.date(2008, 11, 20), "65210", 0, Decimal("0.00")),
        ("2", 20130705, "Married", START, dt.date(2013, 2, 2), "65210", 0, Decimal("0.00")),
        ("3", 20131006, "Single", START, dt.date(2012, 1, 5), "10001", 6, Decimal("180.00")),
        ("4", 20130301, "Divorced", START, dt.date(2012, 1, 6), "10002", None, Decimal("0.00")),
        ("4", 20140804, "Divorced", CHANGE, dt.date(2013, 2, 6), "10002", 13, Decimal("325.00")),
        ("5", 20130720, "Single", START, dt.date(2012, 1, 5), "10003", 0, Decimal("0.00")),
    ]


def test_staging_keeps_every_batch(two_days):
    assert {t: two_days.read(t).count() for t in TABLES if t.startswith("stg_")} == {
        "stg_customers": 8,
        "stg_policy": 8,
        "stg_address": 8,
        "stg_transactions": 8,
    }
    for name, schema in TABLES.items():
        assert two_days.read(name).columns == schema.names


def test_repeating_days_changes_nothing(spark, two_days, tmp_path):
    folder = feeds.write(tmp_path / "in")
    again = load_folder(spark, folder, str(tmp_path / "out"), as_of, NOW)
    want = snapshot(two_days)
    assert snapshot(again) == want
    load_day(again, read_day(spark, folder, 2), 2, as_of(2), NOW)
    assert snapshot(again) == want
    # taking up day 1 again takes back day 2 until that is loaded too
    load_day(again, read_day(spark, folder, 1), 1, as_of(1), NOW)
    assert again.finished() == [1]
    assert again.read("fact_policy_txn").count() == 4
    load_day(again, read_day(spark, folder, 2), 2, as_of(2), NOW)
    assert snapshot(again) == want


def test_a_load_cut_off_stays_out_of_sight(spark, tmp_path, monkeypatch):
    folder = feeds.write(tmp_path / "in")
    warehouse = load_folder(spark, folder, str(tmp_path / "out"), as_of, NOW, days=[1])
    before = snapshot(warehouse)
    write = Warehouse.write

    def fail_at_fact(self, table, df, day):
        if table == "fact_policy_txn":
            raise OSError("cut off")
        write(self, table, df, day)

    monkeypatch.setattr(Warehouse, "write", fail_at_fact)
    with pytest.raises(OSError, match="cut off"):
        load_day(warehouse, read_day(spark, folder, 2), 2, as_of(2), NOW)
    assert snapshot(warehouse) == before


@pytest.mark.parametrize("cut_at", ["dim_policy", "log"])
def test_a_reload_cut_off_leaves_the_old_tables(spark, two_days, monkeypatch, cut_at, tmp_path):
    before = {t: rows(two_days.read(t)) for t in ("stg_customers", "dim_customer", "dim_policy", "fact_policy_txn")}
    less = read_day(spark, feeds.write(tmp_path / "in", ["Feed_East_day1.csv"]), 1)
    write = Warehouse.write

    def fail(self, table, df, day):
        if table == cut_at:
            raise OSError("cut off")
        write(self, table, df, day)

    def no_log(self, day, as_of):
        raise OSError("cut off")

    monkeypatch.setattr(Warehouse, "write", fail)
    if cut_at == "log":  # all tables are written
        monkeypatch.setattr(Warehouse, "finish", no_log)
    again = Warehouse(spark, two_days.root)
    with pytest.raises(OSError, match="cut off"):
        load_day(again, less, 1, as_of(1), NOW)
    fresh = Warehouse(spark, two_days.root)
    assert fresh.finished() == [1, 2]
    assert {t: rows(fresh.read(t)) for t in before} == before


def test_clean_removes_what_does_not_count(spark, two_days):
    before = snapshot(two_days)
    fresh = Warehouse(spark, two_days.root)
    fresh.begin(1)
    fresh.write("dim_policy_type", fresh.read("dim_policy_type"), 1)
    other = Warehouse(spark, two_days.root)
    gone = other.clean()
    assert any("dim_policy_type" in p for p in gone)
    assert other.clean() == []
    assert snapshot(other) == before


def test_types_of_all_tables(two_days):
    for name, schema in TABLES.items():
        assert [(f.name, f.dataType) for f in two_days.read(name).schema] == [(f.name, f.dataType) for f in schema]


def test_iso_dates_and_rejects(spark, tmp_path):
    """Dates in another format give facts, and what a load leaves out is listed."""
    east = feeds.FILES["Feed_East_day1.csv"]
    folder = feeds.write_zip(tmp_path / "in", "a.zip", {"Feed_East_day1.csv": east, "Feed_Far_day1.csv": east})
    whole = (tmp_path / "in" / "a.zip").read_bytes()
    at = whole.rindex(b"Feed_Far_day1.csv", 0, whole.index(b"PK\x01\x02")) + 60
    (tmp_path / "in" / "a.zip").write_bytes(whole[:at] + bytes([whole[at] ^ 255]) + whole[at + 1 :])
    warehouse = load_folder(spark, folder, str(tmp_path / "out"), as_of, NOW)
    assert warehouse.read("fact_policy_txn").count() == 2
    assert [(r.kind, r.item) for r in warehouse.read("rejects").collect()] == [("file", "a.zip/Feed_Far_day1.csv")]
    raw = read_day(spark, folder, 1)
    iso = raw.withColumn("actual_premium_paid_dt", F.when(F.col("customer_id") == "4", "soon").otherwise("2013-04-05"))
    other = Warehouse(spark, str(tmp_path / "other"))
    load_day(other, iso, 1, as_of(1), NOW)
    assert [r.date_sk for r in other.read("fact_policy_txn").collect()] == [20130405]
    assert rows(other.read("rejects").select("kind", "item", "rows")) == [("cell", "actual_premium_paid_dt", 1), ("row", "fact_policy_txn", 1)]


def test_files_without_a_day_are_one_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "all.csv").write_text(feeds.FILES["Feed_East_day1.csv"])
    warehouse = load_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), as_of, NOW)
    assert warehouse.finished() == [0]
    assert warehouse.read("fact_policy_txn").count() == 2


def test_arriving_days_end_in_the_same_tables(spark, two_days, tmp_path):
    """Day 2 comes first, then half of day 1, then the rest."""
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    arrivals = [["Feed_Central_day2.csv", "Feed_East_day2.csv"], ["Feed_East_day1.csv"], ["Feed_Central_day1.csv"]]
    for names in arrivals:
        feeds.write(folder, names)
        stream = load_arriving_days(spark, str(folder), out, check, as_of, NOW)
        stream.awaitTermination()
        assert stream.exception() is None
    assert Warehouse(spark, out).finished() == [1, 2]
    assert snapshot(Warehouse(spark, out)) == snapshot(two_days)


def test_raw_rows_are_read_once_and_rules_are_listed(spark, tmp_path):
    folder = feeds.write(tmp_path / "in")
    raw = read_day(spark, folder, 1)
    kept = raw.toPandas()
    kept.loc[kept.customer_id == "3", "premium_amt"] = "-1"
    kept.loc[kept.customer_id == "4", "policy_id"] = " "
    kept["loyalty"] = "gold"
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            passed.add(len(b))
            yield b

    rows_of = spark.createDataFrame(kept.where(kept.notna(), None), ", ".join(f"{c} string" for c in kept.columns))
    warehouse = Warehouse(spark, str(tmp_path / "out"))
    assert load_day(warehouse, rows_of.mapInPandas(counted, rows_of.schema), 1, as_of(1), NOW)
    assert passed.value == len(kept) == 4
    assert rows(warehouse.read("rejects")) == [
        ("column", "loyalty", "no column of the feed", None),
        ("rule", "policy_id is given", "failed", 1),
        ("rule", "premium_amt is positive", "failed", 1),
    ]
    assert warehouse.read("fact_policy_txn").count() == 4


def test_values_are_normalised(spark, tmp_path):
    raw = read_day(spark, feeds.write(tmp_path / "in"), 1).withColumns(
        {"gender": F.lit(" M "), "policy_term": F.lit("quarter"), "region": F.lit("nowhere"), "maritial_status": F.lit("Unmarried")}
    )
    warehouse = Warehouse(spark, str(tmp_path / "out"))
    lookup = spark.createDataFrame([("Central State", "Central"), ("East State", "East")], "state_province string, region string")
    load_day(warehouse, raw, 1, as_of(1), NOW, regions=lookup)
    got = warehouse.read("dim_customer").select("customer_id", "gender", "marital_status", "region")
    assert rows(got) == [(c, "Male", "Single", r) for c, r in (("1", "Central"), ("2", "Central"), ("3", "East"), ("4", "East"))]
    assert {r.policy_term for r in warehouse.read("dim_policy").collect()} == {"Quarterly"}


def test_dates_in_the_order_of_their_column(spark, tmp_path):
    """5/1/2012 is a day of January where the column also has 13/1/2012; the doubt is counted."""
    raw = read_day(spark, feeds.write(tmp_path / "in"), 1)
    paid = F.when(F.col("customer_id") == "3", "13/9/2013").when(F.col("customer_id") == "4", "5/9/13").otherwise(F.col("actual_premium_paid_dt"))
    warehouse = Warehouse(spark, str(tmp_path / "out"))
    load_day(warehouse, raw.withColumn("actual_premium_paid_dt", paid), 1, as_of(1), NOW, date_formats=None)
    got = {r.customer_id: r.txn_date for r in warehouse.read("feed").collect()}
    assert (got["3"], got["4"]) == (dt.date(2013, 9, 13), dt.date(2013, 9, 5))  # the file from East
    assert got["1"] == dt.date(2013, 9, 4)  # the file from Central
    listed = {(r.item, r.reason): r.rows for r in warehouse.read("rejects").collect()}
    assert listed["actual_premium_paid_dt", "day and month could be swapped"] == 2


def test_an_empty_batch_is_not_logged(spark, two_days, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "out"))
    raw = read_day(spark, feeds.write(tmp_path / "in"), 1)
    assert not load_day(warehouse, raw.where("false"), 1, as_of(1), NOW)
    assert warehouse.finished() == []


def test_two_loads_at_once(spark, tmp_path):
    """Of loads of one day one counts; a load of an earlier day goes on, and takes the later one back."""
    root = str(tmp_path / "out")

    def begun(day):
        warehouse = Warehouse(spark, root)
        warehouse.begin(day)
        types = spark.createDataFrame([(str(day), "t", "d")], TABLES["dim_policy_type"])
        warehouse.write("dim_policy_type", types, day)
        return warehouse

    one, two = begun(1), begun(1)
    two.finish(1, as_of(1))
    with pytest.raises(ConcurrentLoad):
        one.finish(1, as_of(1))
    late, later = begun(2), begun(3)
    later.finish(3, as_of(3))
    late.finish(2, as_of(2))
    fresh = Warehouse(spark, root)
    assert fresh.finished() == [1, 2]
    assert rows(fresh.read("dim_policy_type").select("policy_type_id")) == [("1",), ("2",)]
    built_on_2, again = begun(3), begun(2)
    again.finish(2, as_of(2))
    with pytest.raises(ConcurrentLoad, match="day 3 was built without the load of day 2"):
        built_on_2.finish(3, as_of(3))


def test_days_arriving_in_archives(spark, two_days, tmp_path):
    """A zip with both regions of day 2 starts the load of day 2."""
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    day = {d: {n: t for n, t in feeds.FILES.items() if f"day{d}" in n} for d in (1, 2)}
    for arrive in (lambda: feeds.write(folder, list(day[1])), lambda: feeds.write_zip(folder, "late.zip", {**day[2], "notes.csv": "a\n"})):
        arrive()
        stream = load_arriving_days(spark, str(folder), out, check, as_of, NOW)
        stream.awaitTermination()
        assert stream.exception() is None
    assert snapshot(Warehouse(spark, out)) == snapshot(two_days)


def test_arrived_archives_are_checked_once(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    feeds.write_zip(folder, "all.zip", feeds.FILES)
    scans = []

    def scan(*args, **options):
        scans.append(args)
        return scan_archives(*args, **options)

    monkeypatch.setattr("premia.streaming.daily.scan_archives", scan)
    monkeypatch.setattr("premia.plans.daily_load.scan_archives", scan)
    out = str(tmp_path / "out")
    stream = load_arriving_days(spark, str(folder), out, str(tmp_path / "check"), as_of, NOW)
    stream.awaitTermination()
    assert stream.exception() is None
    assert Warehouse(spark, out).finished() == [1, 2] and len(scans) == 1
