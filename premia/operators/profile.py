"""Profiles of a frame: missing values, statistics, correlation, histogram, category counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from premia.operators.quality import is_missing, unpivot
from premia.operators.quantiles import column_quantiles


def missing_values(df: DataFrame) -> DataFrame:
    """``(column_name, missing_values, percentage)`` of columns with missing cells, most affected first."""
    rows = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    cells = {
        c: {
            "missing_values": F.col(f"n{i}"),
            "percentage": F.col(f"n{i}") * F.lit(100.0) / F.nullif(F.col("rows"), F.lit(0)),
        }
        for i, c in enumerate(df.columns)
    }
    found = unpivot(rows, cells, "column_name").filter("missing_values > 0")
    return found.orderBy(F.desc("percentage"), "column_name")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _is_time(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _as_number(df: DataFrame, name: str) -> Column:
    """A number as it is, a date or time as its wall clock in seconds since 1970."""
    col, kind = F.col(name), df.schema[name].dataType
    if not _is_time(kind):
        return col.cast("double")
    days = F.unix_date(F.to_date(col)) * F.lit(86400.0)
    if isinstance(kind, T.DateType):
        return days
    return days + F.hour(col) * 3600 + F.minute(col) * 60 + F.date_part(F.lit("SECOND"), col).cast("double")


def basic_stats(df: DataFrame) -> DataFrame:
    """One row per column: count, unique, top, freq, mean, std, min, p25, p50, p75, max.

    Numbers have no unique, top and freq; text has nothing else but a count. Dates and times are described in
    seconds since 1970. The top value is the most frequent one, of several the smallest.
    """
    measured = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) or _is_time(f.dataType)]
    texts = [c for c in df.columns if c not in measured]
    parts = []
    if measured:
        values = df.select([F.nanvl(_as_number(df, c), F.lit(None).cast("double")).alias(c) for c in measured])
        kinds = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
        wide = values.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(measured) for k, f in kinds.items()])
        stats = unpivot(
            wide, {c: {k: F.col(f"{k}{i}") for k in kinds} for i, c in enumerate(measured)}, "column_name"
        )
        quartiles = (
            column_quantiles(values, measured, [0.25, 0.5, 0.75])
            .groupBy("column_name")
            .agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(f"p{int(p * 100)}") for p in (0.25, 0.5, 0.75)])
        )
        parts.append(stats.join(quartiles, "column_name", "left"))
    if texts:
        cells = df.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in texts]))
        )
        per_value = cells.groupBy("column_name", "value").agg(F.count("*").alias("n"))
        given = F.col("value").isNotNull()
        # The smallest of the most frequent values: least by falling count, then by value.
        best = F.min(F.when(given, F.struct((-F.col("n")).alias("rank"), "value")))
        words = per_value.groupBy("column_name").agg(
            F.coalesce(F.sum(F.when(given, F.col("n"))), F.lit(0)).alias("count"),
            F.count_if(given).alias("unique"),
            best["value"].alias("top"),
            (-best["rank"]).alias("freq"),
        )
        parts.append(words)
    order = ["column_name", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max"]
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    types = {"unique": "bigint", "top": "string", "freq": "bigint"}
    return whole.select(
        [F.col(c) if c in whole.columns else F.lit(None).cast(types.get(c, "double")).alias(c) for c in order]
    )


def correlations(df: DataFrame, wide: int = 24) -> DataFrame:
    """``(column_x, column_y, correlation)`` for all pairs of numeric columns, over rows where both are given.

    Where a column has one value only there is no correlation; ``corr`` would divide by zero, an error in ANSI
    mode. A first pass tells which columns vary, and which have gaps, so that they may be constant over the rows
    of a pair; for these the division is guarded, which costs more.

    A frame of more than ``wide`` columns has too many pairs for one aggregate each, see :func:`wide_correlations`.
    """
    cols = numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_x string, column_y string, correlation double")
    if len(cols) > wide:
        return wide_correlations(df, cols)
    pairs = list(combinations_with_replacement(cols, 2))
    value = {c: F.when(~is_missing(df, c), F.col(c).cast("double")) for c in cols}
    spans = {c: F.struct(F.count(v).alias("n"), (F.min(v) < F.max(v)).alias("varies")) for c, v in value.items()}
    rows, *found = df.agg(F.count("*"), *spans.values()).first()
    first = dict(zip(cols, found, strict=True))

    def pearson(x: str, y: str) -> Column:
        if not (first[x].varies and first[y].varies):
            return F.lit(None).cast("double")
        if x == y or first[x].n == first[y].n == rows:
            return F.corr(value[x], value[y])
        spread = [F.stddev_pop(F.when(value[b].isNotNull(), value[a])) for a, b in ((x, y), (y, x))]
        return F.try_divide(F.covar_pop(value[x], value[y]), spread[0] * spread[1])

    wide = df.agg(F.count("*"), *[pearson(x, y).alias(f"r{i}") for i, (x, y) in enumerate(pairs)])
    cells = []
    for i, (x, y) in enumerate(pairs):
        for a, b in {(x, y), (y, x)}:
            cells.append(
                F.struct(F.lit(a).alias("column_x"), F.lit(b).alias("column_y"), F.col(f"r{i}").alias("correlation"))
            )
    return wide.select(F.inline(F.array(*cells)))


# Fixed value: a task's sums are merged with those of one in so many others before all are.
SALTS = 64
_SUMS = ("n", "total", "squares", "products")
_SUMS_SCHEMA = "x int, salt int, " + ", ".join(f"{c} array<double>" for c in _SUMS)


def _added_up(rows: pd.DataFrame, salt: int) -> pd.DataFrame:
    """Rows of sums for one column as one row."""
    return pd.DataFrame({"x": rows["x"][:1], "salt": salt, **{c: [np.sum(np.stack(rows[c]), axis=0)] for c in _SUMS}})


def wide_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The same as :func:`correlations` for frames of many columns, by cross-product matrices.

    Each task turns its rows into four matrices over all pairs (x, y), of the rows where both are given: their number, the sums
    and sums of squares of x, and the sums of products. A matrix travels as one row per x and is summed in two steps, so that no
    task gets a row of every other. Values are taken as distances from their column's mean, which a first pass gives, so that
    the differences of sums keep their digits. Over the rows of a pair a column counts as constant if its spread is below
    1e-6 of its root mean square distance from the mean. Infinite values give no correlation, a frame without rows no rows.
    """
    cols = list(cols)
    value = [F.when(~is_missing(df, c), F.col(c).cast("double")) for c in cols]
    ends = df.agg(F.struct(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(value)]),
                  F.struct(*[(F.min(v) < F.max(v)).alias(f"v{i}") for i, v in enumerate(value)])).first()
    means = np.array([m if m is not None else 0.0 for m in ends[0]])
    varies = list(ends[1])

    def crossed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = len(means)
        sums = [np.zeros((k, k)) for _ in _SUMS]
        any_rows = False
        for batch in batches:
            any_rows = any_rows or len(batch) > 0
            rows = batch.to_numpy(dtype=float) - means
            given = ~np.isnan(rows)
            rows, given = np.where(given, rows, 0.0), given.astype(float)
            with np.errstate(invalid="ignore", over="ignore"):
                for at, part in zip(sums, (given.T @ given, rows.T @ given, (rows * rows).T @ given, rows.T @ rows)):
                    at += part
        if any_rows:
            salt = TaskContext.get().partitionId() % SALTS
            yield pd.DataFrame({"x": range(k), "salt": salt, **{c: list(m) for c, m in zip(_SUMS, sums)}})

    def somewhat(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _added_up(rows, key[1])

    def whole(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _added_up(rows, 0)

    placed = df.select([v.alias(f"c{i}") for i, v in enumerate(value)])
    partial = placed.mapInPandas(crossed, _SUMS_SCHEMA).groupBy("x", "salt").applyInPandas(somewhat, _SUMS_SCHEMA)
    rows = partial.groupBy("x").applyInPandas(whole, _SUMS_SCHEMA)
    cells = rows.select("x", F.posexplode(F.arrays_zip(*_SUMS)).alias("y", "s")).select("x", "y", "s.*")
    # The sums of y over the pair stand in y's own row; the two meet by the unordered pair.
    pair = F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    of = lambda c, side: F.max(F.when(F.col("x") == F.col(side), F.col(c)))
    met = cells.withColumns({"a": pair[0], "b": pair[1]}).groupBy("a", "b").agg(
        F.max("n").alias("n"), F.max("products").alias("products"),
        *[of(c, side).alias(f"{c}_{side}") for c in ("total", "squares") for side in ("a", "b")],
    )
    n = F.nullif(F.col("n"), F.lit(0.0))
    mean = {s: F.col(f"total_{s}") / n for s in "ab"}
    spread = {s: F.col(f"squares_{s}") / n - mean[s] * mean[s] for s in "ab"}
    least = F.lit(1e-12)
    moves = (spread["a"] > least * F.col("squares_a") / n) & (spread["b"] > least * F.col("squares_b") / n)
    r = (F.col("products") / n - mean["a"] * mean["b"]) / F.sqrt(spread["a"] * spread["b"])
    name = lambda c: F.element_at(F.array(*map(F.lit, cols)), F.col(c) + 1)
    fixed = [i for i, v in enumerate(varies) if not v]
    known = moves & ~F.col("a").isin(fixed) & ~F.col("b").isin(fixed) if fixed else moves
    found = met.withColumn("r", F.when(known, F.when(F.col("a") == F.col("b"), 1.0).otherwise(r)))
    sides = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))
    both = found.select(F.explode(F.array_distinct(sides)).alias("p"), F.nanvl("r", F.lit(None).cast("double")).alias("r"))
    both = both.select(F.col("p.x").alias("x"), F.col("p.y").alias("y"), "r")
    return both.select(name("x").alias("column_x"), name("y").alias("column_y"), F.col("r").alias("correlation"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``(bin, bin_start, bin_end, rows)`` for equal-width bins from least to greatest value; the last is closed.

    A column with one value gets bins around it that span 1. The two ends go through the driver.
    """
    value = F.col(column).cast("double")
    usable = df.select(value.alias("v")).filter(value.isNotNull() & ~F.isnan(value))
    low, high = usable.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, rows bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    number = F.least(F.width_bucket("v", F.lit(low), F.lit(high), F.lit(bins)).cast("int"), F.lit(bins))
    counts = usable.groupBy(number.alias("bin")).agg(F.count("*").alias("rows"))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("bin_start"),
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_end"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, rows)`` of a category column without nulls, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), "value")
