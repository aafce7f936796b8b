"""Data-quality checks. Every check gives a DataFrame and none stops a load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from premia.functions import parse_date
from premia.functions.dates import FEED_DATE_FORMATS


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or not a number in a floating-point column."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def unpivot(row: DataFrame, cells: Mapping[str, Mapping[str, Column]], label: str) -> DataFrame:
    """Turn one wide row into a row per label: ``{label: {column: value}}``."""
    structs = [F.struct(F.lit(n).alias(label), *[v.alias(k) for k, v in vs.items()]) for n, vs in cells.items()]
    return row.select(F.inline(F.array(*structs)))


def check_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` for the listed or all columns, in one pass."""
    cols = list(columns or df.columns)
    counts = df.agg(*[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(cols)])
    return unpivot(counts, {c: {"null_count": F.col(f"n{i}")} for i, c in enumerate(cols)}, "column_name")


def check_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row: how many rows repeat an earlier one; null equals null."""
    groups = df.groupBy(*(subset or df.columns)).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def check_referential_integrity(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key the dimension lacks; a null key is an orphan unless the dimension has one too."""
    keys = dim.select(F.col(dim_key).alias("_dim_key")).distinct()
    return fact.join(keys, fact[fact_key].eqNullSafe(keys["_dim_key"]), "left_anti")


def validation_report(df: DataFrame) -> DataFrame:
    """One row: rows, columns, nulls_total, duplicates and the column types. One grouping serves all counts."""
    nulls = sum((F.when(is_missing(df, c), 1).otherwise(0) for c in df.columns), F.lit(0))
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n")).withColumn("_nulls", nulls)
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.coalesce(F.sum(F.col("_n") * F.col("_nulls")), F.lit(0)).alias("nulls_total"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        F.lit(", ".join(f"{n} {t}" for n, t in df.dtypes)).alias("dtypes"),
    )


def has_any(df: DataFrame, *names: str) -> bool:
    """Whether at least one of the columns is there, for columns that go by several names."""
    return any(n in df.columns for n in names)


def check_schema(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``(column_name, status, filled_rows)``: present, missing or unexpected columns and their non-null rows."""
    have = df.columns
    names = [*expected, *(c for c in have if c not in expected)]
    status = {n: "missing" if n not in have else "present" if n in expected else "unexpected" for n in names}
    filled = df.agg(*[F.count_if(~is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(have)])
    cells = {
        n: {
            "status": F.lit(status[n]),
            "filled_rows": F.col(f"n{have.index(n)}") if n in have else F.lit(0).cast("bigint"),
        }
        for n in names
    }
    return unpivot(filled, cells, "column_name")


def schema_drift(headers: DataFrame, expected: Sequence[str] = ()) -> DataFrame:
    """How headers change from one file of a feed to the next.

    ``headers`` holds a row per header cell: ``source_file, batch_day, position, written, column_name``. Files whose names
    differ in the day alone are one feed, in the order of their days. The result has a row per change: ``(feed, source_file,
    column_name, change, written, written_before, position, position_before)``, where ``change`` is

    - ``unknown``: the column is not among the expected ones (if any are given), in every file that has it;
    - ``added`` or ``lost`` against the file before;
    - ``respelled``: the same column, written otherwise;
    - ``moved``: of the columns that both files have, it follows another one than before.

    A column that a header holds twice counts as two, the first with the first of the file before.
    """
    feed = F.regexp_replace("source_file", r"(?i)_?day\d+\.csv$", "").alias("feed")
    in_feed = Window.partitionBy("feed").orderBy(F.col("batch_day").asc_nulls_first(), "source_file")
    cells = headers.select(feed, "*").withColumn("seq", F.dense_rank().over(in_feed))
    same = Window.partitionBy("feed", "seq", "column_name").orderBy("position")
    cells = cells.withColumn("nth", F.row_number().over(same))
    keys = ["feed", "seq", "column_name", "nth"]
    now = cells.select(*keys, "written", "position")
    before = now.withColumn("seq", F.col("seq") + 1).withColumnsRenamed({"written": "written_before", "position": "position_before"})
    later = cells.select("feed", "seq", "source_file").distinct().filter("seq > 1")
    both = now.join(before, keys, "full").join(later, ["feed", "seq"])
    common = F.col("position").isNotNull() & F.col("position_before").isNotNull()
    label = F.struct("column_name", "nth")

    def follows(order: str) -> Column:
        return F.lag(label).over(Window.partitionBy("feed", "seq", common).orderBy(order))

    changes = {
        "added": F.col("position_before").isNull(),
        "lost": F.col("position").isNull(),
        "respelled": F.col("written") != F.col("written_before"),
        "moved": common & F.col("elsewhere"),
    }
    kinds = F.array_compact(F.array(*[F.when(on, F.lit(change)) for change, on in changes.items()]))
    compared = both.withColumn("elsewhere", ~follows("position").eqNullSafe(follows("position_before")))
    shown = ["feed", "source_file", "column_name", "change", "written", "written_before", "position", "position_before"]
    drift = compared.withColumn("change", F.explode(kinds)).select(shown)
    if not expected:
        return drift
    unknown = cells.filter(~F.col("column_name").isin(list(expected))).withColumn("change", F.lit("unknown"))
    return drift.unionByName(unknown.select([c for c in shown if not c.endswith("_before")]), allowMissingColumns=True)


def required(*names: str) -> dict[str, Column]:
    return {f"{n} is given": F.col(n).isNotNull() & (F.col(n).cast("string") != "") for n in names}


def positive(*names: str) -> dict[str, Column]:
    return {f"{n} is positive": F.col(n).isNull() | (F.col(n) > 0) for n in names}


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, failed_rows)`` for conditions each row should meet, in one pass."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"n{i}") for i, ok in enumerate(rules.values())])
    return unpivot(counts, {r: {"failed_rows": F.col(f"n{i}")} for i, r in enumerate(rules)}, "rule")


def check_dates(raw: DataFrame, cols: Sequence[str], formats: str | Sequence[str] = FEED_DATE_FORMATS) -> DataFrame:
    """``(column_name, bad_rows)``: cells that hold text which is no date."""
    counts = raw.agg(
        *[
            F.count_if(F.col(c).isNotNull() & parse_date(F.col(c), formats).isNull()).alias(f"n{i}")
            for i, c in enumerate(cols)
        ]
    )
    return unpivot(counts, {c: {"bad_rows": F.col(f"n{i}")} for i, c in enumerate(cols)}, "column_name")
