from __future__ import annotations

import zipfile

import feeds
import pytest
from conftest import rows
from pyspark.sql import functions as F

from premia.schemas import NAME_PARTS
from premia.sources import archives, files, tables


def test_folder_unites_headers_that_differ(spark, tmp_path):
    folder = feeds.write(tmp_path / "in")
    (tmp_path / "in" / "notes.txt").write_text("not a feed")
    (tmp_path / "in" / "sub").mkdir()
    (tmp_path / "in" / "sub" / "Feed_Far_day3.csv").write_text("Customer ID\n99\n")
    df = files.read_folder(spark, folder)
    assert df.count() == 8
    assert len(df.columns) == 30 + 1
    assert set(NAME_PARTS) | {"customer_name", "source_file"} <= set(df.columns)
    last = {r.customer_id.strip(): r.customer_last_name for r in df.filter("source_file like '%Central_day2%'").collect()}
    assert last == {"1": "o'hara", "2": "Lund"}
    got = {r.customer_id: (r.customer_name, r.postal_code, r.country) for r in df.filter("source_file like '%East_day2%'").collect()}
    assert got == {"4": ("Dora Fox", "10002", None), "5": ("Edgar, Jr.", "10003", "US")}
    deep = files.read_folder(spark, folder, recursive=True)
    assert deep.count() == 9


def test_days_and_selection(spark, tmp_path):
    folder = feeds.write(tmp_path / "in")
    (tmp_path / "in" / "Feed_West_day11.csv").write_text("Customer ID\n1\n")
    (tmp_path / "in" / "Feed_West_dayX.csv").write_text("Customer ID\n1\n")
    assert files.find_days(spark, folder) == [1, 2, 11]
    one = files.read_day(spark, folder, 1)
    assert {r[0] for r in one.select("source_file").distinct().collect()} == {"Feed_Central_day1.csv", "Feed_East_day1.csv"}
    assert files.read_day(spark, folder, 7) is None
    day = files.read_folder(spark, folder).select(files.batch_day(files.F.col("source_file")).alias("d"))
    assert rows(day.distinct()) == [(None,), (1,), (11,), (2,)]


def test_empty_or_missing_folder(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert files.read_folder(spark, str(tmp_path / "empty")) is None
    assert files.read_folder(spark, str(tmp_path / "missing")) is None
    assert files.find_days(spark, str(tmp_path / "missing")) == []


def test_unreadable_file_is_skipped(spark, tmp_path):
    folder = feeds.write(tmp_path / "in", ["Feed_East_day1.csv"])
    (tmp_path / "in" / "Feed_Bad_day1.csv").write_text("")
    assert files.read_folder(spark, folder).count() == 2


def test_archives_are_read_in_place(spark, tmp_path):
    folder = feeds.write(tmp_path / "in", ["Feed_East_day1.csv"])
    changed = feeds.FILES["Feed_East_day1.csv"].replace("Dora Fox", "Dora Elk")
    members = {n: feeds.FILES[n] for n in ("Feed_Central_day1.csv", "Feed_Central_day2.csv")}
    feeds.write_zip(tmp_path / "in", "a.zip", {**members, "Feed_East_day1.csv": changed, "sub/x_day5.csv": "a\n1\n", "r.txt": "x"})
    (tmp_path / "in" / "broken.zip").write_bytes(b"no archive")
    before = sorted(p.name for p in (tmp_path / "in").iterdir())
    assert files.find_days(spark, folder) == [1, 2]
    df = files.read_folder(spark, folder)
    assert df.count() == 6
    # the archive's copy replaces the plain file
    names = {r.customer_name for r in df.filter("source_file = 'Feed_East_day1.csv'").collect()}
    assert names == {"cARL dOE", "Dora Elk"}
    assert files.read_day(spark, folder, 2).count() == 2
    assert sorted(p.name for p in (tmp_path / "in").iterdir()) == before
    # the same columns and cells as plain files give
    plain = files.read_folder(spark, feeds.write(tmp_path / "plain", list(members)))
    zipped = df.filter("source_file like '%Central%'").select(plain.columns)
    assert rows(zipped) == rows(plain)


def test_last_archive_wins_and_odd_records_survive(spark, tmp_path):
    feeds.write_zip(tmp_path, "a.zip", {"x_day1.csv": "Id,Note\n1,old\n"})
    folder = feeds.write_zip(tmp_path, "b.zip", {"x_day1.csv": '﻿Id,Note\n1,"two\nlines, ""quoted"""\n\n2\n3,c,extra\n4,NA\n'})
    got = rows(files.read_folder(spark, folder).select("id", "note"))
    assert got == [("1", 'two\nlines, "quoted"'), ("2", None), ("3", "c"), ("4", None)]


def test_long_cells_and_damaged_members(spark, tmp_path):
    long = "x" * 300_000
    folder = feeds.write_zip(tmp_path, "a.zip", {"a_day1.csv": f"Id,Note\n1,{long}\n", "b_day1.csv": "Id,Note\n" + "2,y\n" * 50_000})
    whole = (tmp_path / "a.zip").read_bytes()
    at = whole.index(b"b_day1.csv") + len(b"b_day1.csv") + 200_000
    (tmp_path / "a.zip").write_bytes(whole[:at] + b"#" + whole[at + 1 :])
    df = files.read_folder(spark, folder)
    assert [(r.source_file, len(r.note)) for r in df.collect()] == [("a_day1.csv", 300_000)]
    ((file, reason),) = files.rejected_files(files.scan_archives(spark, folder))
    assert file == "a.zip/b_day1.csv" and reason
    with pytest.raises(ValueError, match="b_day1.csv"):
        files.read_folder(spark, folder, on_damage="fail")


def test_broken_archives_are_listed(spark, tmp_path):
    (tmp_path / "broken.zip").write_bytes(b"no archive")
    assert [f for f, _ in files.rejected_files(files.scan_archives(spark, str(tmp_path)))] == ["broken.zip"]
    assert files.read_folder(spark, str(tmp_path)) is None


def test_headers_by_position(spark, tmp_path):
    """Names that repeat up to case, hold a backtick or lack text."""
    (tmp_path / "a_day1.csv").write_text("Customer ID,Customer Name,customer name,No`te\n1,A,B,c\n")
    feeds.write_zip(tmp_path, "z.zip", {"b_day1.csv": "Customer ID,Customer Name,customer name,No`te\n2,A,B,c\n"})
    df = files.read_folder(spark, str(tmp_path))
    assert sorted(df.columns) == ["customer_id", "customer_name", "no_te", "source_file"]
    assert rows(df.select("customer_id", "customer_name", "no_te")) == [("1", "A", "c"), ("2", "A", "c")]


def test_padded_days_are_read(spark, tmp_path):
    (tmp_path / "x_day01.csv").write_text("Id\n1\n")
    (tmp_path / "x_day11.csv").write_text("Id\n2\n")
    feeds.write_zip(tmp_path, "z.zip", {"y_day001.csv": "Id\n3\n"})
    assert files.find_days(spark, str(tmp_path)) == [1, 11]
    assert rows(files.read_day(spark, str(tmp_path), 1).select("id")) == [("1",), ("3",)]


def test_options_reach_archive_members(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Customer ID;Name\n1;A\n")
    feeds.write_zip(tmp_path, "z.zip", {"b.csv": "Customer ID;Name\n2;B\n"})
    df = files.read_folder(spark, str(tmp_path), sep=";")
    assert rows(df.select("customer_id", "name")) == [("1", "A"), ("2", "B")]
    with pytest.raises(ValueError, match="encoding"):
        files.read_folder(spark, str(tmp_path), sep=";", encoding="latin1")


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    def jobs(n: int) -> int:
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"f{i}.csv").write_text("Id\n1\n")
        group = f"files {n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert files.read_folder(spark, str(folder)).count() == n
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(2) == jobs(30) > 0


def test_folder_written_by_spark_counts_as_one_file(spark, tmp_path):
    df = spark.range(10).selectExpr("id as `Customer ID`", "'a \"b\", c' as Note").repartition(3)
    df.write.options(header=True, escape='"').csv(str(tmp_path / "Feed_X_day4.csv"))
    assert files.find_days(spark, str(tmp_path)) == [4]
    got = files.read_day(spark, str(tmp_path), 4)
    assert got.count() == 10
    assert rows(got.select("note", "source_file").distinct()) == [('a "b", c', "Feed_X_day4.csv")]


def test_csv_options_pass_through(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a;b\n1;"x\ny"\n')
    got = files.read_csv(spark, str(tmp_path / "a.csv"), sep=";", multiLine=True)
    assert rows(got) == [("1", "x\ny")]
    typed = files.read_csv(spark, str(tmp_path / "a.csv"), schema=files.T.StructType([files.T.StructField("a", files.T.IntegerType())]), sep=";")
    assert typed.schema["a"].dataType.simpleString() == "int"


def test_load_modes(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "t")
    tables.load_table(df.filter("id > 9"), path, "fail")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
    tables.load_table(df, path, "fail")
    tables.load_table(df, path)
    assert spark.read.parquet(path).count() == 6
    tables.load_table(df.filter("id > 9"), path, "replace")
    assert spark.read.parquet(path).count() == 6
    tables.load_table(df, path, "replace")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        tables.load_table(df, path, "fail")
    with pytest.raises(KeyError):
        tables.load_table(df, path, "upsert")


def test_counts_report_tables_that_cannot_be_read(spark):
    spark.range(4).createOrReplaceTempView("four")
    found = tables.named_tables(spark, ["four", "no_such_table"])
    assert rows(tables.table_counts(spark, found)) == [("four", 4), ("no_such_table", None)]
    assert rows(tables.read_query(spark, "select count(*) from four")) == [(4,)]
    assert rows(tables.preview(tables.read_table(spark, "four"), ["id"], 2)) == [(0,), (1,)]


def test_members_of_one_archive_run_in_tasks_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "CHUNK", 1000)
    monkeypatch.setattr(archives, "PIECE", 70)
    text = "Id,Note\r\n" + "".join(f'{i},"é line\n{i}"\r\n' for i in range(3000))
    folder = feeds.write_zip(tmp_path, "a.zip", {f"{n}_day1.csv": text for n in "abcdefgh"})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = files.read_folder(spark, folder).withColumn("task", F.spark_partition_id())
        got = df.groupBy("source_file").agg(F.count("*"), F.countDistinct("task"), F.count_if(F.col("note") == F.concat(F.lit("é line\n"), "id"))).collect()
        assert sorted(tuple(r)[1:] for r in got) == [(3000, 1, 3000)] * 8
        assert df.select("task").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_records(size):
    text = 'a,b\r\n1,"x\n""y"",\n"\n\n2,z\n"open\n'
    pieces = (text[i : i + size] for i in range(0, len(text), size))
    assert list(archives.records(pieces, '"')) == ["a,b", '1,"x\n""y"",\n"', "2,z", '"open\n']
    assert list(archives.records(iter([""]), '"')) == []


def test_stored_members_are_read(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "s.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.csv", "Id\n1\n2")
        z.writestr("empty.csv", "")
    assert rows(files.read_folder(spark, str(tmp_path)).select("id", "source_file")) == [("1", "a.csv"), ("2", "a.csv")]
