"""Spelling variants against every pair of words, compared one by one."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import ROWS, empty, messy

from premia.llm import common, spelling


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    common.prepare(spark)


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def brute(counts: dict[str, int]) -> dict[str, tuple]:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, its in near.items():
        best = min(its, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def got(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def vocabulary(spark, counts):
    return common.staged(spark.createDataFrame(list(counts.items()), "word string, n long"))


def crowded(seed: int, lengths, letters="abé") -> dict[str, int]:
    rng = random.Random(seed)
    out = {}
    for _ in range(120):
        w = "".join(rng.choices(letters, k=rng.choice(lengths)))
        for _ in range(4):
            out[w] = rng.choice([3, 3, 5, 7, 40, 41, 100, 1000])
            at = rng.randrange(len(w))
            w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]])
    return out


@pytest.mark.parametrize("lengths, longest", [((5, 6, 7), 40), ((6, 7, 8, 9, 10), 8)], ids=["trie", "trie and beyond"])
def test_every_pair(spark, monkeypatch, lengths, longest):
    monkeypatch.setattr(spelling, "LONGEST", longest)
    counts = crowded(1, lengths)
    want = brute(counts)
    assert max(x[3] for x in want.values()) > 2 and sum(x[1] != x[0] for x in want.values() if x[0]) > 0
    assert got(spelling.grouped(vocabulary(spark, counts))) == want


def test_clashing_hashes_add_and_lose_nothing(spark, monkeypatch):
    counts = dict(list(crowded(2, (5, 6)).items())[:120])
    monkeypatch.setattr(spelling, "node", lambda way, direction: F.xxhash64(way, direction) % 40)
    assert got(spelling.grouped(vocabulary(spark, counts))) == brute(counts)


def test_long_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LONGEST", 12)
    long = "ab" * 5000
    counts = {long: 50, long + "b": 5, long[1:]: 20, long[:777] + "x" + long[778:]: 3, "c" * 13: 9, "c" * 12: 4, "c" * 11: 3, "alone": 3}
    want = brute(counts)
    assert want[long][3] == 3 and want["c" * 12][3] == 2
    assert got(spelling.grouped(vocabulary(spark, counts))) == want


def test_shortened_hashes():
    def plain(w):
        h = 0
        for c in w:
            h = (h * spelling.BASE + ord(c)) % spelling.PRIME
        return h

    for w in ("a", "abc", "ÿéaa" * 20):
        assert dict(spelling.shortened(w)) == {-1: plain(w), **{i: plain(w[:i] + w[i + 1 :]) for i in range(len(w))}}


def test_no_neighbours_and_no_words(spark):
    counts = {"alpha": 3, "omega": 4}
    assert got(spelling.grouped(vocabulary(spark, counts))) == {"alpha": (None, "alpha", 3, 0, None), "omega": (None, "omega", 4, 0, None)}
    assert spelling.variants(empty(spark)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")).count() == 0


def counted(rows, spoilt=97):
    out = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % spoilt == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def test_words_of_odd_rows(spark):
    rows = [(i, t) for i, t, *_ in ROWS] + [(i, "Größe ÀÉÎ×÷ Straßen straSSen großE colour color colors " * 4) for i in (None, 20, 21)]
    docs = messy(spark, [(i, t, "en", "a") for i, t in rows])
    for spoilt in (97, 2):
        counts = {r.word: r.n for r in spelling.words(docs, spoilt, 5, 3).collect()}
        assert counts == counted(rows, spoilt)
    assert got(spelling.variants(docs, spoilt=2)) == brute(counts)


def test_a_chain_of_forms(spark):
    """Each form twice as frequent as the next: roots are found over more than one doubling step."""
    counts = {"abcdef"[:k] + "xxxxxx"[k:] + "word": 3 * 2**k for k in range(7)}
    want = brute(counts)
    assert len({x[1] for x in want.values()}) == 1
    assert got(spelling.grouped(vocabulary(spark, counts))) == want


def test_one_word_and_one_text_hold_a_third(spark):
    docs = spark.createDataFrame([(i, "hotword " * 50 if i % 3 else f"hotwords {i}") for i in range(300)], "doc_id long, text string")
    assert got(spelling.variants(docs)) == brute(counted([tuple(r) for r in docs.collect()]))
