"""Generic joins, aggregates, unions and first-row selection."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from premia.operators.quantiles import grouped_medians

log = logging.getLogger(__name__)

_JOIN_KINDS = ("inner", "left", "right", "outer")


def same_keys(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> Column:
    """Equality on all keys where null equals null."""
    return reduce(Column.__and__, [left[a].eqNullSafe(right[b]) for a, b in zip(left_on, right_on, strict=True)])


# Fixed value: hashes that marked_keys tells apart, a bit each.
MARKS = 1 << 24


def marked_keys(rows: DataFrame, keys: Sequence[str], marks: int = MARKS) -> DataFrame:
    """``(word, bits)``: one bit per hash of the keys that occur, 64 to a row.

    However many rows there are, no more than ``marks / 64`` come out, 262,144 by default, so that they can be broadcast.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(marks))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(63).cast("int"))
    placed = rows.select(place.alias("place")).select(F.shiftright("place", 6).alias("word"), bit.alias("bit"))
    return placed.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def touched_rows(df: DataFrame, keys: Sequence[str], marked: DataFrame, marks: int = MARKS) -> DataFrame:
    """Rows of a large frame whose keys may occur among the marked ones, found where they are read.

    All rows whose keys do occur stay, null keys included, and about one in ``marks / n`` others for ``n`` marked keys. Keys
    need the types they were marked with, as hashes depend on them.
    """
    placed = df.withColumn("_place", F.pmod(F.xxhash64(*keys), F.lit(marks)))
    theirs = marked.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    met = (F.shiftright("_place", 6) == F.col("_word")) & (F.getbit("_bits", F.col("_place").bitwiseAND(63).cast("int")) == 1)
    return placed.join(F.broadcast(theirs), met, "left_semi").drop("_place")


def _as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def join_tables(
    left: DataFrame,
    right: DataFrame,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str],
    how: str = "left",
    suffixes: tuple[str, str] = ("_x", "_y"),
    hot_keys: bool = False,
) -> DataFrame:
    """Equi-join where null keys match each other; other columns with the same name get a suffix.

    Keys of the same name on both sides come out once. A cross join takes no keys and is not offered.

    Adaptive execution splits a hot key on both sides of an inner join, but only on the side that an outer join
    keeps whole, and not at all in a full join. With ``hot_keys`` an outer join is put together from parts that can
    be split, at the price of reading the inputs more than once; they then have to give the same rows each time.
    """
    if how not in _JOIN_KINDS:
        raise ValueError(f"join kind {how!r}: use one of {_JOIN_KINDS}")
    lkeys, rkeys = _as_list(left_on), _as_list(right_on)
    shared = {a for a, b in zip(lkeys, rkeys, strict=True) if a == b}
    clashes = (set(left.columns) & set(right.columns)) - shared
    l_names = {c: f"l{i}" for i, c in enumerate(left.columns)}
    r_names = {c: f"r{i}" for i, c in enumerate(right.columns)}
    lhs, rhs = left.toDF(*l_names.values()), right.toDF(*r_names.values())
    l_on, r_on = [l_names[c] for c in lkeys], [r_names[c] for c in rkeys]

    def unmatched(kept: DataFrame, kept_on: list[str], other: DataFrame, other_on: list[str]) -> DataFrame:
        keys = other.select(other_on).distinct()
        return kept.join(keys, same_keys(kept, keys, kept_on, other_on), "left_anti")

    on = same_keys(lhs, rhs, l_on, r_on)
    if hot_keys:
        parts = [lhs.join(rhs, on, "inner")]
        if how in ("left", "outer"):
            parts.append(unmatched(lhs, l_on, rhs, r_on))
        if how in ("right", "outer"):
            parts.append(unmatched(rhs, r_on, lhs, l_on))
        joined = union_outer(parts)
    else:
        joined = lhs.join(rhs, on, "full" if how == "outer" else how)

    def left_column(c: str) -> Column:
        col = F.coalesce(l_names[c], r_names[c]) if c in shared else F.col(l_names[c])
        return col.alias(c + suffixes[0] if c in clashes else c)

    out = [left_column(c) for c in left.columns]
    out += [
        F.col(r_names[c]).alias(c + suffixes[1] if c in clashes else c) for c in right.columns if c not in shared
    ]
    return joined.select(out)


_AGGREGATES = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "count": F.count,
    "size": lambda c: F.count("*"),
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "nunique": F.countDistinct,
}


def aggregations(
    df: DataFrame, group_cols: str | Sequence[str], agg: Mapping[str, str | Sequence[str]], order_by: Sequence[str] = ()
) -> DataFrame:
    """Aggregates by name: sum, count, size, mean, min, max, std, var, nunique, first, last, median.

    One name per column keeps the column's name; a list gives a column ``column_aggregate`` for each name.
    Rows with a null key are dropped and the sum of nothing is 0. The result is not sorted. ``first`` and ``last``
    take the non-null value at either end of ``order_by``, since rows of a distributed table have no order of
    their own. The median is exact and never gathers a whole group, see
    :func:`premia.operators.quantiles.grouped_medians`.
    """
    keys = _as_list(group_cols)
    rows = df.na.drop(subset=keys)
    wanted: dict[str, tuple[str, str]] = {}
    for name, kinds in agg.items():
        if isinstance(kinds, str):
            wanted[name] = (name, kinds)
        else:
            wanted.update({f"{name}_{kind}": (name, kind) for kind in kinds})
    exprs, medians = [], {}
    for out, (name, kind) in wanted.items():
        col = F.col(name)
        if kind == "median":
            medians[out] = name
        elif kind in ("first", "last"):
            if not order_by:
                raise ValueError(f"{kind} of {name} needs order_by")
            ranked = F.when(col.isNotNull(), F.struct(*order_by, col.alias("_value")))
            exprs.append((F.min if kind == "first" else F.max)(ranked)["_value"].alias(out))
        elif kind in _AGGREGATES:
            exprs.append(_AGGREGATES[kind](col).alias(out))
        else:
            raise ValueError(f"unknown aggregate {kind!r}")
    result = rows.groupBy(*keys).agg(*exprs) if exprs else rows.select(*keys).distinct()
    for out, name in medians.items():
        result = result.join(grouped_medians(rows, keys, name, out), keys, "left")
    return result.select(*keys, *wanted)


def union_outer(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_dataframe(df: DataFrame, columns: Sequence[str], drop_duplicates: bool = True) -> DataFrame:
    """The listed columns that exist, without duplicate rows."""
    have = [c for c in columns if c in df.columns]
    if len(have) < len(columns):
        log.warning("split passes over absent columns: %s", sorted(set(columns) - set(have)))
    subset = df.select(have)
    return subset.distinct() if drop_duplicates else subset


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The first row per key by ``order_by`` and then by all other columns, so that ties cannot differ by run.

    The row is a minimum over structs: each task keeps one row per key before the shuffle, however many
    rows a key has.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ordered = [*order_by, *(c for c in rest if c not in order_by)]
    first = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_first"))
    return first.select([F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns])
