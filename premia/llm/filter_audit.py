"""What each filter of a chain removes, in every order of the filters, and its exact Shapley share.

Every document becomes a set of filters that it fails, as bits. Documents are counted by part and set; the counts of all
coalitions (removed if any filter of the coalition fails) follow, 32 for five filters. What a filter removes at a step
of an order is the difference of two coalitions. Its Shapley share solves the least-squares problem that fits an
additive model to the coalitions under the Shapley kernel, with the shares adding up to the whole. The normal equations
are the same for every part, so they are solved once, in rationals, for every possible right-hand side; a part's shares
are then whole-number combinations of its coalitions.

Only one short row per document is shuffled: its id, its text's digest, its bits. Rows with equal texts meet in a
minimum that each task takes first, and the way back is a join on digest and id, which a frequent text does not crowd.

Null texts count as empty, null parts as the empty string. Rows with a null id fail no duplicate filter and make no other
row a duplicate. Repeated rows count as often as they come; none of them is a duplicate of the other, as their ids are
equal. An id that is labelled more than once has every label given to it. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from premia.llm.common import SPACES, UPPER, staged, text_or_empty

#: Puts the name of a filter beside the condition under which a text fails it; None stands for the duplicate filter.
Filters = dict[str, Callable[[Column], Column] | None]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES, -1), "")


def fewer_words(least: int) -> Callable[[Column], Column]:
    return lambda text: F.size(words(text)) < least


def repetitive(percent: int) -> Callable[[Column], Column]:
    """Distinct words are fewer than so many in a hundred."""
    return lambda text: 100 * F.size(F.array_distinct(words(text))) < percent * F.size(words(text))


def shouting(percent: int) -> Callable[[Column], Column]:
    """Letters A-Z are more than so many in a hundred code points."""
    return lambda text: 100 * (F.length(text) - F.length(F.translate(text, UPPER, ""))) > percent * F.length(text)


def holding(characters: str) -> Callable[[Column], Column]:
    return lambda text: text.rlike(f"[{characters}]")


def failures(docs: DataFrame, labels: DataFrame, filters: Filters, part: str = "source") -> DataFrame:
    """part, fails (bits in the order of ``filters``), good, toxic: one row per distinct case, n documents each."""
    text = text_or_empty("text")
    own = F.lit(0)
    for bit, failing in enumerate(filters.values()):
        if failing is not None:
            own = own.bitwiseOR(F.when(failing(text), 1 << bit).otherwise(0))
    rows = docs.select(
        "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), own.alias("own")
    )
    # Texts are read once. Repeated rows, however many, become one.
    rows = staged(rows.groupBy("doc_id", "part", "digest", "own").agg(F.count("*").alias("n")))

    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = rows.join(marks.where("doc_id is not null and (good = 1 or toxic = 1)"), "doc_id", "left")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    seen = marked.join(firsts.where("doc_id is not null"), ["digest", "doc_id"], "left")
    duplicate = F.col("doc_id").isNotNull() & F.col("first").isNull()
    fails = F.col("own")
    for bit, failing in enumerate(filters.values()):
        if failing is None:
            fails = fails.bitwiseOR(F.when(duplicate, 1 << bit).otherwise(0))
    return (
        seen.select("part", fails.alias("fails"), *(F.coalesce(m, F.lit(0)).alias(m) for m in ("good", "toxic")), "n")
        .groupBy("part", "fails", "good", "toxic")
        .agg(F.sum("n").alias("n"))
    )


def coalitions(cases: DataFrame, filters: int) -> DataFrame:
    """One row per part: its documents and, by coalition of filters, how many of them all, good and toxic it removes."""
    least = cases.groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )
    hit = F.explode(F.sequence(F.lit(0), F.lit(2**filters - 1))).alias("coalition")
    # A part has at most 2^filters rows here, each explodes to as many coalitions.
    by_coalition = least.select("*", hit).groupBy("part", "coalition").agg(
        *(F.sum(F.when(F.col("fails").bitwiseAND(F.col("coalition")) != 0, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")),
        F.sum("n").alias("documents"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("coalition", "n", "good", "toxic")))
    tabled = by_coalition.groupBy("part").agg(F.first("documents").alias("documents"), ordered.alias("v"))
    return tabled.select("part", "documents", *(F.col("v")[c].alias(c) for c in ("n", "good", "toxic")))


def solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """Solve for several right-hand sides at once by elimination in rationals."""
    size = len(matrix)
    rows = [a[:] + b[:] for a, b in zip(matrix, right)]
    for c in range(size):
        pivot = next(r for r in range(c, size) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(size):
            if r != c and rows[r][c]:
                factor = rows[r][c]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[c])]
    return [r[size:] for r in rows]


def shapley_weights(filters: int) -> list[list[Fraction]]:
    """For each filter, the weight of every coalition's count in its Shapley share.

    Minimises sum over S of k(S) * (v(S) - sum of shares in S)^2 over the coalitions between none and all, with the
    Shapley kernel k(S) = (m - 1) / (C(m, |S|) |S| (m - |S|)), under the constraint that the shares add up to v(all). The
    constraint joins the normal equations with a Lagrange multiplier; column S of the right-hand side is that of a v
    that is one for S and zero elsewhere.
    """
    everyone = 2**filters - 1
    size = [bin(s).count("1") for s in range(everyone + 1)]
    kernel = [
        Fraction(filters - 1, math.comb(filters, k) * k * (filters - k)) if 0 < k < filters else Fraction(0) for k in size
    ]
    inside = [[Fraction(s >> i & 1) for s in range(everyone + 1)] for i in range(filters)]
    matrix = [
        [sum((kernel[s] * inside[i][s] * inside[j][s] for s in range(everyone + 1)), Fraction(0)) for j in range(filters)] + [Fraction(1)]
        for i in range(filters)
    ]
    matrix.append([Fraction(1)] * filters + [Fraction(0)])
    right = [[kernel[s] * inside[i][s] for s in range(everyone + 1)] for i in range(filters)]
    right.append([Fraction(s == everyone) for s in range(everyone + 1)])
    return solved(matrix, right)[:filters]


def shares(v: Column, filters: int, orders: int) -> list[Column]:
    """Shapley share of each filter times the number of orders: a whole number."""
    out = []
    for weights in shapley_weights(filters):
        whole = [w * orders for w in weights]
        least = math.lcm(*(w.denominator for w in whole))
        total = F.lit(0).cast("long")
        for s, w in enumerate(whole):
            if w:
                total = total + F.lit(int(w * least)).cast("long") * v[s]
        out.append(total if least == 1 else F.floor(total / least).cast("long"))
    return out


def audit(docs: DataFrame, labels: DataFrame, filters: Filters, part: str = "source") -> DataFrame:
    """Every part, order and step: what the step's filter removes, what it would have removed earlier, its Shapley share."""
    names = list(filters)
    if any(len(n) != 1 for n in names) or len(names) < 2:
        raise ValueError("give two filters or more, each named by one character")
    return steps(coalitions(failures(docs, labels, filters, part), len(names)), names)


def steps(tabled: DataFrame, names: Sequence[str]) -> DataFrame:
    m, everyone = len(names), 2 ** len(names) - 1
    orders = ["".join(o) for o in itertools.permutations(names)]
    shared = tabled.select("*", F.array(*shares(F.col("n"), m, len(orders))).alias("shares"))
    ordered = shared.select("*", F.explode(F.array(*map(F.lit, orders))).alias("filter_order"))
    placed = ordered.select("*", F.explode(F.sequence(F.lit(1), F.lit(m))).alias("step"))
    at = {n: F.instr("filter_order", n) for n in names}
    mask, own, nth = F.lit(0), F.lit(0), F.lit(0)
    for bit, n in enumerate(names):
        mask = mask.bitwiseOR(F.when(at[n] <= F.col("step"), 1 << bit).otherwise(0))
        own = own.bitwiseOR(F.when(at[n] == F.col("step"), 1 << bit).otherwise(0))
        nth = nth + F.when(at[n] == F.col("step"), bit).otherwise(0)
    placed = placed.select("*", mask.alias("after"), own.alias("own"), nth.alias("nth"))
    after, before = F.col("after"), F.col("after").bitwiseXOR(F.col("own"))

    def gained(c: str) -> Column:
        return F.get(c, after) - F.get(c, before)

    return placed.select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - F.get("n", after)).alias("kept"),
        gained("n").alias("removed"),
        (F.get("n", F.col("own")) - gained("n")).alias("redundant"),
        (F.col("n")[everyone] - F.get("n", F.lit(everyone).bitwiseXOR(F.col("own")))).alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        F.get("shares", F.col("nth")).alias("shapley"),
    )
