"""The filter audit against the chain itself, run document by document."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from samples import ROWS, empty, messy

from premia.llm import common, filter_audit
from premia.llm.queries import FILTERS

LABELS = "doc_id long, quality int, toxic int, part string, digest int"


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    common.prepare(spark)


def failing(rows):
    """(part, letters that the row fails) of every row, by plain Python."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, source in rows:
        t = t or ""
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", t) if w]
        out = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and first[t] < i,
        }
        yield i, source or "", {k for k, v in out.items() if v}


def chained(rows, labels):
    """Every order, one document after the other."""
    good, toxic = ({r[0] for r in labels if r[0] is not None and r[at] == 1} for at in (1, 2))
    docs = list(failing(rows))
    out, removed_in_all = {}, Counter()
    for order in itertools.permutations("ABCDE"):
        counts = defaultdict(Counter)
        for i, part, fails in docs:
            gone = False
            for f in order:
                c = counts[part, f]
                c["kept"] += not gone and f not in fails
                c["removed"] += not gone and f in fails
                c["redundant"] += gone and f in fails
                c["unique_fails"] += fails == {f}
                c["good_lost"] += not gone and f in fails and i in good
                c["toxic_lost"] += not gone and f in fails and i in toxic
                gone = gone or f in fails
        for (part, f), c in counts.items():
            removed_in_all[part, f] += c["removed"]
            out[part, "".join(order), order.index(f) + 1] = c
    for (part, order, step), c in out.items():
        c["shapley"] = removed_in_all[part, order[step - 1]]
    return out


def audited(spark, docs, labels):
    got = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS), FILTERS)
    return {(r.part, r.filter_order, r.step): Counter({k: v for k, v in r.asDict().items() if k not in ("part", "filter_order", "step")}) for r in got.collect()}


MARKS = [(1, 1, 0, "x", 1), (7, 0, 0, "x", 1), (None, 1, 1, "x", 1), (8, None, 1, "x", 1), (7, 1, 0, "x", 1), (99, 1, 1, "x", 1), (3, 1, 1, "x", 1)]


def test_odd_rows(spark):
    rows = [(i, t, s) for i, t, _, s in ROWS]
    got = audited(spark, messy(spark), MARKS)
    assert len(got) == 120 * 5 * len({s or "" for *_, s in rows})
    assert got == chained(rows, MARKS)


def test_every_set_of_failures(spark):
    parts = {"A": "", "B": "again again again again ", "C": "LOUD ", "D": "# "}
    plenty = " ".join(f"w{i}" for i in range(400))
    rows = []
    for n in range(5):
        for fails in itertools.combinations("ABCD", n):
            body = " ".join(parts[f] * (40 if f == "C" else 1) for f in fails if f != "B")
            body += "" if "A" in fails else plenty
            body += " again" * (30 if "A" in fails else 900) if "B" in fails else ""
            rows += [(len(rows) + k, body, "ab"[k % 2]) for k in range(3)]
    seen = {frozenset(f) for *_, f in failing(rows)}
    assert len(seen) > 16
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert audited(spark, docs, MARKS) == chained(rows, MARKS)


def test_one_text_and_one_source_hold_a_third(spark):
    rows = [(i, "the same few words" if i % 3 else f"text {i}", "hot" if i % 3 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    assert audited(spark, docs, MARKS) == chained(rows, MARKS)


def test_empty_table(spark):
    assert filter_audit.audit(empty(spark), spark.createDataFrame([], LABELS), FILTERS).count() == 0


@pytest.mark.parametrize("m", [2, 3, 5, 6])
def test_least_squares_give_shapley_weights(m):
    """The constrained solution has the closed form |S|! (m - |S| - 1)! / m! on marginal gains."""
    for i, weights in enumerate(filter_audit.shapley_weights(m)):
        for s, w in enumerate(weights):
            k = bin(s).count("1")
            want = math.factorial(k - 1) * math.factorial(m - k) if s >> i & 1 else -math.factorial(k) * math.factorial(m - k - 1)
            assert w == Fraction(want, math.factorial(m)) or s == 0


def test_shares_add_up(spark):
    got = audited(spark, messy(spark), MARKS)
    for part in {p for p, *_ in got}:
        rows = [got[part, "ABCDE", s] for s in range(1, 6)]
        assert sum(r["shapley"] for r in rows) == 120 * sum(r["removed"] for r in rows)
