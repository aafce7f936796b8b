"""Exact quantiles without gathering the values of a group.

One pass sketches every column or group: KLL sketches of ``K``, which tasks fill and merge, so that one sketch serves all
wanted ranks. The values that the sketch gives a margin below and above a rank enclose it in a bracket. A second pass
counts what lies below, at and inside the brackets. A bracket that holds its ranks and at most ``INSIDE`` values is done;
one that holds more is sketched again, inside only, and one that misses its ranks, which the margin makes very unlikely, is
taken up again with four times the margin. The last pass counts the values of the brackets one by one, everything below and
above as one, and a running count finds the ranks.

Three passes serve up to ``INSIDE / (2 * MARGIN)`` rows a group, and every further one some 1 / (2 * MARGIN) times as
many. Groups of up to ``INSIDE`` rows are their own bracket and need no counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from premia.session import shared_dir

#: The rank error of a sketch of this size is below 0.0015 with 99 % confidence; the margin is several times that.
K = 2048
MARGIN = 0.006
GRID = 512
INSIDE = 100_000


def _at_rank(rank: Column) -> Column:
    """The value whose run of equal values covers a 0-based rank."""
    covers = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
    return F.max(F.when(covers, F.struct(F.col("_zone"), F.col("_value"))))


def _pick(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Linear interpolation between the two ranks next to ``_prob * (n - 1)``."""
    running = Window.partitionBy(*keys).orderBy("_zone", "_value")
    whole = Window.partitionBy(*keys)
    target = F.col("_prob") * (F.col("_total") - 1)
    ranked = counts.withColumns({"_upto": F.sum("_n").over(running), "_total": F.sum("_n").over(whole)})
    ranked = ranked.withColumn("_target", target)
    found = ranked.groupBy(*keys).agg(
        F.max("_target").alias("_target"),
        _at_rank(F.floor("_target")).alias("_low"),
        _at_rank(F.ceil("_target")).alias("_high"),
    )
    low, high = F.col("_low._value"), F.col("_high._value")
    share = F.col("_target") - F.floor("_target")
    # The form low + share * (high - low) gives the value itself when both neighbours agree.
    return found.withColumn("_quantile", low + share * (high - low))


def _zone(value: Column, low: Column, high: Column) -> Column:
    return F.when(value < low, -1).when(value > high, 1).otherwise(0)


def _kept(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back, so that rounds do not pile up."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ends(value: Column, ranks: list[Column]) -> Column:
    """The sketched values at ranks from 0 to 1; null if there are no values."""
    sketch = F.kll_sketch_agg_double(value, F.lit(K))
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*ranks)))


def _grid(sketch: Column) -> Column:
    """The sketched values at all multiples of 1 / GRID; the ranks of sketches have to be constants."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))


def _sketched(value: Column) -> Column:
    return F.when(F.count(value) > 0, _grid(F.kll_sketch_agg_double(value, F.lit(K))))


def _brackets(rows: DataFrame, keys: Sequence[str], prob: float) -> DataFrame:
    """keys, _low, _high: per group a bracket of the wanted ranks with at most ``INSIDE`` values strictly inside."""
    value, low, high = F.col("_value"), F.col("_low"), F.col("_high")
    around = [F.lit(max(prob - MARGIN, 0.0)), F.lit(min(prob + MARGIN, 1.0))]
    spans = rows.groupBy(*keys).agg(
        F.min("_value").alias("_least"), F.max("_value").alias("_most"), F.count("*").alias("_total"), _ends(value, around).alias("_ends")
    )
    spans = _kept(spans)
    small = F.col("_total") <= INSIDE
    done = spans.where(small).select(*keys, F.col("_least").alias("_low"), F.col("_most").alias("_high"))
    # Ends that are the least or the greatest value cannot miss.
    open_ones = spans.where(~small).select(
        *keys,
        (F.col("_least") if prob <= MARGIN else F.col("_ends")[0]).alias("_low"),
        (F.col("_most") if prob >= 1 - MARGIN else F.col("_ends")[1]).alias("_high"),
        "_total", F.col("_least").alias("_low0"), F.col("_most").alias("_high0"), F.lit(MARGIN).alias("_margin"),
    )
    first, last = (f(F.lit(prob) * (F.col("_total") - 1)) for f in (F.floor, F.ceil))
    state = ["_low", "_high", "_total", "_low0", "_high0", "_margin"]
    while not open_ones.isEmpty():
        inside = F.when((value > low) & (value < high), value)
        counted = rows.join(open_ones, list(keys)).groupBy(*keys, *state).agg(
            F.count_if(value < low).alias("_under"),
            F.count_if(value <= low).alias("_upto_low"),
            F.count_if(value <= high).alias("_upto_high"),
            F.count(inside).alias("_inside"),
            _sketched(inside).alias("_new"),
        )
        seen = _kept(counted)
        holds = (F.col("_under") <= first) & (last < F.col("_upto_high"))
        # A bracket whose margin is the whole cannot shrink; it is then counted as it is.
        finished = holds & ((F.col("_inside") <= INSIDE) | (F.col("_margin") >= 1))
        done = done.unionByName(seen.where(finished).select(*keys, "_low", "_high"))
        # Places on the grid beside the ranks; beyond it, or at the ends themselves, the end stays.
        share = {r: (rank - F.col("_upto_low")) / F.col("_inside") for r, rank in (("first", first), ("last", last))}
        down, up = F.floor((share["first"] - F.col("_margin")) * GRID), F.ceil((share["last"] + F.col("_margin")) * GRID)
        new_low = F.when((first < F.col("_upto_low")) | (down <= 0), low).otherwise(F.get("_new", down.cast("int")))
        new_high = F.when(last < F.col("_upto_low"), low).when(up >= GRID, high).otherwise(F.get("_new", up.cast("int")))
        step = seen.where(holds & ~finished).select(
            *keys, new_low.alias("_low"), F.greatest(new_low, new_high).alias("_high"), "_total",
            low.alias("_low0"), high.alias("_high0"), "_margin",
        )
        back = seen.where(~holds).select(
            *keys, F.col("_low0").alias("_low"), F.col("_high0").alias("_high"), "_total", "_low0", "_high0", (F.col("_margin") * 4).alias("_margin")
        )
        open_ones = _kept(step.unionByName(back))
    return done


def grouped_medians(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """Exact median of a numeric column per group; nulls do not count."""
    value = F.col(col).cast("double")
    rows = df.select(*keys, value.alias("_value")).filter(value.isNotNull() & ~F.isnan(value))
    zone = _zone(F.col("_value"), F.col("_low"), F.col("_high"))
    counts = (
        rows.join(_brackets(rows, keys, 0.5), list(keys))
        .select(*keys, zone.alias("_zone"), F.when(zone == 0, F.col("_value")).alias("_value"))
        .groupBy(*keys, "_zone", "_value")
        .agg(F.count("*").alias("_n"))
        .withColumn("_prob", F.lit(0.5))
    )
    return _pick(counts, keys).select(*keys, F.col("_quantile").alias(out or col))


@dataclass
class _Bracket:
    """Ends around the ranks of one quantile of one column, those of the step before, and the margin."""

    col: str
    prob: float
    total: int
    low: float
    high: float
    before: tuple[float, float]
    margin: float = 0.0
    wide: bool = False
    below: int = 0
    above: int = 0

    def ranks(self) -> tuple[int, int]:
        target = self.prob * (self.total - 1)
        return math.floor(target), math.ceil(target)


def _shrink(df: DataFrame, values: dict[str, Column], brackets: list[_Bracket]) -> None:
    """Count all brackets in one pass, and again those that are too wide; a few numbers each reach the driver."""
    pending = list(brackets)
    while pending:
        aggs = []
        for i, b in enumerate(pending):
            v = values[b.col]
            inside = F.when((v > b.low) & (v < b.high), v)
            # Most brackets are narrow enough by the sketch; only wide ones are sketched inside.
            b.wide = b.wide or 2 * b.margin * b.total > INSIDE
            aggs.append(
                F.struct(
                    F.count_if(v < b.low).alias("under"), F.count_if(v <= b.low).alias("upto_low"), F.count_if(v <= b.high).alias("upto_high"),
                    F.count(inside).alias("inside"), (_sketched(inside) if b.wide else F.lit(None).cast("array<double>")).alias("grid"),
                ).alias(f"b{i}")
            )
        still = []
        for b, seen in zip(pending, df.agg(*aggs).first(), strict=True):
            first, last = b.ranks()
            if not (seen.under <= first and last < seen.upto_high):
                b.low, b.high = b.before
                b.margin *= 4
                b.wide = True
                still.append(b)
            elif seen.inside <= INSIDE or b.margin >= 1:
                b.below, b.above = seen.under, b.total - seen.upto_high
            elif seen.grid is None:  # wider than the sketch said: sketch it
                b.wide = True
                still.append(b)
            else:
                b.before = (b.low, b.high)
                low, high = b.low, b.high
                down = math.floor(((first - seen.upto_low) / seen.inside - b.margin) * GRID)
                up = math.ceil(((last - seen.upto_low) / seen.inside + b.margin) * GRID)
                if down > 0:
                    low = seen.grid[down]
                if last < seen.upto_low:
                    high = b.low
                elif up < GRID:
                    high = seen.grid[up]
                b.low, b.high = low, max(low, high)
                still.append(b)
        pending = still


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of numeric columns over the whole frame: ``(column_name, prob, quantile)``.

    Only rows within a bracket are grouped by value.
    """
    spark = df.sparkSession
    values = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    around = [F.lit(min(max(p + side * MARGIN, 0.0), 1.0)) for p in probs for side in (-1, 1)]
    spans = df.agg(
        *[
            F.struct(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), _ends(v, around).alias("ends")).alias(f"c{i}")
            for i, v in enumerate(values.values())
        ]
    ).first()
    brackets = []
    for c, s in zip(values, spans, strict=True):
        for i, p in enumerate(probs if s.n else ()):
            b = _Bracket(c, float(p), s.n, s.low, s.high, (s.low, s.high))
            if s.n > INSIDE:
                b.margin = MARGIN
                b.low, b.high = (s.low if p <= MARGIN else s.ends[2 * i]), (s.high if p >= 1 - MARGIN else s.ends[2 * i + 1])
            brackets.append(b)
    if not brackets:
        return spark.createDataFrame([], "column_name string, prob double, quantile double")
    _shrink(df, values, [b for b in brackets if b.total > INSIDE])
    schema = "column_name string, _prob double, _zone int, _value double, _n bigint"
    ends_rows = [(b.col, b.prob, zone, None, n) for b in brackets for zone, n in ((-1, b.below), (1, b.above))]
    cells = [
        F.when(
            values[b.col].between(b.low, b.high),
            F.struct(F.lit(b.col).alias("column_name"), F.lit(b.prob).alias("_prob"), F.lit(0).alias("_zone"), values[b.col].alias("_value")),
        )
        for b in brackets
    ]
    inside = (
        df.select(F.explode(F.array_compact(F.array(*cells))).alias("_cell"))
        .select("_cell.*")
        .groupBy("column_name", "_prob", "_zone", "_value")
        .agg(F.count("*").alias("_n"))
    )
    counts = inside.unionByName(spark.createDataFrame(ends_rows, schema).filter("_n > 0"))
    picked = _pick(counts, ["column_name", "_prob"])
    return picked.select("column_name", F.col("_prob").alias("prob"), F.col("_quantile").alias("quantile"))
