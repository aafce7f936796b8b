"""Mixing sources to target weights along a time-varying curriculum.

Each source has a total weight and a schedule that says how its share moves over training time 0 to 1. Targets follow
from the weights by water filling under a limit of repeats. A source's documents, in an order fixed by a hash of their
ids, form a stream that is passed as often as the target asks; the schedule is integrated, and the inverse of the
cumulative demand gives every copy its training position. Documents are range-sorted by position.

Running totals within a source are sums over hash buckets plus a running sum inside a bucket, so that no source is
gathered in one task. Only DataFrame operations are used.

Null texts have size 0, null sources form a source of their own that sorts last, null ids count as empty text in the
order. Documents of size 0 take no words and stay out. Repeated rows are documents of their own; rows equal in id and
size are interchangeable. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from premia.llm.common import WORD, fresh, staged, text_or_empty

BUCKET_DIGITS = 3


@dataclass(frozen=True)
class Schedule:
    """Weight over time, linear between knots (time, weight); times run from 0 to 1, weights are above 0."""

    knots: tuple[tuple[float, float], ...]

    def integral(self) -> list[float]:
        """Integral of the weight up to each knot."""
        total = [0.0]
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]):
            total.append(total[-1] + (t1 - t0) * (w0 + w1) / 2)
        return total

    def position(self, share: Column) -> Column:
        """Time by which the given share of the source's demand is met."""
        total = self.integral()
        demand = share * total[-1]
        out = None
        for i in reversed(range(len(self.knots) - 1)):
            (t0, w0), (t1, w1) = self.knots[i : i + 2]
            rest = F.greatest(demand - total[i], F.lit(0.0))
            time = t0 + 2 * rest / (w0 + F.sqrt(F.greatest(w0 * w0 + 2 * (w1 - w0) / (t1 - t0) * rest, F.lit(0.0))))
            out = time if out is None else F.when(demand < total[i + 1], time).otherwise(out)
        return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


#: Fade out, stay level, fade in.
SCHEDULES = (
    Schedule(((0.0, 1.5), (1.0, 0.5))),
    Schedule(((0.0, 1.0), (1.0, 1.0))),
    Schedule(((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))),
)


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, and the hash that orders documents."""
    return docs.select(
        "doc_id",
        "source",
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("place"),
    )


def targets(sized: DataFrame, weights: Sequence[int], limit: int) -> DataFrame:
    """One row per source: source_size, target, n (its rank).

    Shares are proportional to the weights; a share above ``limit`` times the source's size stops there and the excess
    goes to the others by weight until none is above. Sources ordered by size per weight meet their limits in that
    order, so running sums decide it. The windows without partition hold one row per source.
    """
    ranked = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("n") % len(weights) + 1).cast("int")).cast("long")
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "n")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = ranked.withColumn("weight", weight).select(
        "source", "source_size", "n", "weight",
        (F.sum("source_size").over(everything) - limit * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("rest"),
        F.sum("weight").over(onwards).alias("rest_weight"),
    )
    full = F.col("rest") * F.col("weight") >= limit * F.col("source_size") * F.col("rest_weight")
    first = sums.withColumn("open", ~full)
    # Once one source in this order stays below its limit, all later ones do, with the same rest to share.
    ahead = Window.orderBy(F.col("source_size") / F.col("weight"), "n").rowsBetween(Window.unboundedPreceding, 0)
    shared = F.first(F.when(F.col("open"), F.struct("rest", "rest_weight")), ignorenulls=True).over(ahead)
    return first.withColumn("shared", shared).select(
        "source", "source_size", "n",
        F.when(F.col("shared").isNull(), (limit * F.col("source_size")).cast("double"))
        .otherwise((F.col("shared.rest") * F.col("weight")).cast("double") / F.col("shared.rest_weight")).alias("target"),
    )


def running(sized: DataFrame) -> DataFrame:
    """Adds ``start``: words of the same source before the document, in the hash order."""
    cell = F.conv(F.substring("place", 1, BUCKET_DIGITS), 16, 10).cast("int")
    rows = sized.withColumn("cell", cell)
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(
        cells.select(
            F.col("source").alias("s"), F.col("cell").alias("c"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("cell_start")
        )
    )
    inside = Window.partitionBy("source", "cell").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(starts, rows["source"].eqNullSafe(starts["s"]) & (rows["cell"] == starts["c"])).drop("s", "c")
    return joined.withColumn("start", F.col("cell_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))).drop("cell", "cell_start")


def plan(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    limit: int = 3,
    schedules: Sequence[Schedule] = SCHEDULES,
) -> DataFrame:
    """One row per document: doc_id, source, size, place, source_size, target, copies, taken, positions.

    ``positions`` holds the training position of each copy. A document is passed as often as its source's target holds
    the source whole, and once more if its middle lies within the rest, so that a source's words differ from its target
    by at most half a document.
    """
    sized = staged(sizes(docs))
    goal = staged(targets(sized, weights, limit)).withColumnRenamed("source", "s")
    rows = running(sized)
    rows = rows.join(F.broadcast(goal) if goal.count() <= 10_000 else goal, rows["source"].eqNullSafe(goal["s"])).drop("s")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    extra = (F.col("start") * 2 + F.col("size") < 2 * rest) & (F.col("whole") < limit)
    rows = rows.withColumn("whole", whole).withColumn(
        "copies", F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + extra.cast("long")).cast("long")
    )
    share = lambda k: (k * F.col("source_size") + F.col("start") + F.col("size") / 2) / F.col("target")

    def position(k: Column) -> Column:
        out = schedules[-1].position(share(k))
        for i, schedule in enumerate(schedules[:-1]):
            out = F.when(F.col("n") % len(schedules) == i, schedule.position(share(k))).otherwise(out)
        return out

    repeats = F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).otherwise(F.array().cast("array<long>"))
    return rows.select(
        "doc_id", "source", "size", "place", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        F.transform(repeats, position).alias("positions"),
    )


def ordered(planned: DataFrame) -> DataFrame:
    """The plan with the training positions of the first and the last copy, range-sorted by the first.

    Documents left out have no position and come last.
    """
    at = lambda n: F.when(F.size("positions") > 0, F.element_at("positions", n))
    rows = planned.select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies", at(1).alias("first_position"), at(-1).alias("last_position")
    )
    return rows.orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), limit: int = 3, schedules: Sequence[Schedule] = SCHEDULES) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the plan says, in training order, with the same columns."""
    at, size, many, source, key, words, turn = fresh(docs, "at", "its_size", "many", "its_source", "its_id", "words", "turn")
    planned = plan(docs, weights, limit, schedules).where("copies > 0")
    # Rows that agree in id, source and size are interchangeable, but each must take its own part of the positions.
    places = planned.groupBy("doc_id", "source", "size").agg(F.flatten(F.collect_list("positions")).alias(at), F.count("*").alias(many))
    places = places.select(F.col("doc_id").alias(key), F.col("source").alias(source), F.col("size").alias(size), at, many)
    rows = docs.withColumn(words, F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long"))
    met = rows.join(
        places, rows["doc_id"].eqNullSafe(places[key]) & rows["source"].eqNullSafe(places[source]) & (rows[words] == places[size])
    )
    one = met.where(F.col(many) == 1).select(*docs.columns, F.explode(at).alias(at))
    equal = Window.partitionBy(key, source, size).orderBy(F.xxhash64("text"))
    dealt = met.where(F.col(many) > 1).withColumn(turn, F.row_number().over(equal) - 1)
    part = F.filter(F.col(at), lambda _, i: i % F.col(many) == F.col(turn))
    rest = dealt.select(*docs.columns, F.explode(part).alias(at))
    return one.unionByName(rest).repartitionByRange(at, "doc_id").sortWithinPartitions(at, "doc_id").select(*docs.columns)
