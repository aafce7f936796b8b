"""Cases in which an operator could do less than its whole job."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from premia.llm import common, context_mixing, curriculum
from premia.llm.text_blocks import blocks


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    common.prepare(spark)


# --- 1 -------------------------------------------------------------------------------------------------------


def split(held, n):
    """The first ids that are held out, or learnt from."""
    return [i for i in range(100) if (zlib.crc32(str(i).encode()) % 7 == 2) == held][:n]


def test_a_long_word_costs_the_sum_of_its_bytes(spark):
    rng = np.random.default_rng(0)
    long = bytes(rng.integers(97, 123, 20_000).astype(np.uint8))
    learnt = [(i, "some plain words to learn from, again and again") for i in split(False, 8)]
    (held,) = split(True, 1)
    docs = spark.createDataFrame([*learnt, (held, long.decode())], "doc_id long, text string")
    (got,) = [r for r in context_mixing.scores(docs).collect() if r.held_out]
    rows = spark.createDataFrame([(i, False, t.encode()) for i, t in learnt], "doc_id long, held_out boolean, text binary")
    model = context_mixing.train(common.staged(context_mixing.merged_runs(common.staged(blocks(rows, 1 << 20)), 16)))
    cost = context_mixing.bits(model, context_mixing.runs([long])[0])
    assert got.n_bytes == len(cost) == 20_002
    assert cost.sum() > 20_000
    # The mixture with whole words adds at most the price of its least weight for the word and for the end.
    assert math.isclose(got.score, -cost.sum() * math.log10(2), rel_tol=1e-3)


def counted(keys):
    """A model of starting weights whose tables hold these runs."""
    model = context_mixing.Model.start()
    dense = [t.astype(np.float32) for t in model.tables]
    context_mixing.add_counts(dense, keys, np.ones(len(keys), np.float32))
    model.tables = [t.astype(np.uint16) for t in dense]
    return model


def test_unknown_contexts_fall_back_on_the_bytes_alone():
    model = counted(context_mixing.runs([b"eee see tree " * 20])[0])
    after = np.uint64(int.from_bytes(b"\xe6\xbc\xa2\xe5\xad") << 8)
    often, never = context_mixing.bits(model, after | np.array([ord("e"), 200], np.uint64))
    assert often < 6 and never > 8  # without a prior, both cost 8 bits


def test_order_one_keeps_every_context_apart():
    pairs = np.arange(1 << 16, dtype=np.uint64)  # all contexts and bytes
    model = counted(pairs)
    assert np.count_nonzero(model.tables[context_mixing.ORDERS.index(1)].any(axis=1)) == 256 * 255


# --- pipeline ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 7])
def test_source_shares_of_sequences_follow_the_schedules(spark, parts):
    docs = spark.createDataFrame([(i, f"word{i % 50} " * 120, "abc"[i % 3]) for i in range(3000)], "doc_id long, text string, source string")
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, parts)
    mixed = common.staged(corpus_pipeline.mixing(spark, docs, ""))
    spark.conf.set(setting, before)
    rows = corpus_pipeline.packed(spark, mixed, "").collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r.doc_id for r in mixed.collect())
    filled = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert all(n == 4096 for s, n in filled.items() if s < max(filled))
    # Tokens of each source in the first and the last fifth of the windows, against its schedule over all sources'.
    last = max(filled) // 16
    tokens = {k: Counter() for k in ("all", "early", "late")}
    for r in rows:
        window, source = r.sequence_id // 16, "abc"[r.doc_id % 3]
        tokens["all"][source] += r.length
        if window < last / 5:
            tokens["early"][source] += r.length
        if window > last * 4 / 5:
            tokens["late"][source] += r.length
    share = lambda k, s: tokens[k][s] / tokens[k].total()
    assert share("early", "a") > 1.25 * share("all", "a") and share("late", "a") < 0.8 * share("all", "a")
    assert share("early", "c") < 0.85 * share("all", "c") and share("late", "c") > 1.1 * share("all", "c")
    # Each source's documents come in the order of the plan.
    planned = {(r.doc_id, i): p for r in curriculum.plan(docs).where("copies > 0").collect() for i, p in enumerate(r.positions)}
    seen, last_position = Counter(), defaultdict(float)
    for r in sorted((r for r in rows if r.start == 0), key=lambda r: (r.sequence_id, r.offset)):
        source, position = "abc"[r.doc_id % 3], planned[r.doc_id, seen[r.doc_id]]
        assert position >= last_position[source]
        seen[r.doc_id] += 1
        last_position[source] = position


def test_shares_are_mixed_without_a_logarithm_of_a_sum_per_share(monkeypatch):
    rng = np.random.default_rng(1)
    spelt = -np.append(rng.random(50) * 40, [5e3, 2e4])
    of_word, again = (np.where(rng.random(52) < 0.3, -np.inf, -rng.random(52) * 15) for _ in range(2))
    again[-1] = of_word[-1] = -np.inf
    starts = np.array([0, 20, 51])
    wanted = []
    for a in context_mixing.WORD_SHARES:
        either = np.logaddexp(np.log(a) + of_word, np.log(1 - a) + spelt)
        wanted += [np.add.reduceat(np.logaddexp(np.log(b) + again, np.log(1 - b) + either), starts) for b in context_mixing.OWN_SHARES]
    monkeypatch.setattr(np, "logaddexp", None)  # slow, as it has no vector form
    assert np.allclose(context_mixing.mixed_words(of_word, spelt, again, starts), wanted, rtol=1e-12, atol=0)


def test_runs_and_vocabulary_of_odd_texts():
    texts = [b"", b"A b", b" ", b"b\xff long-word a", b"\n"]
    keys, first = context_mixing.runs(texts)
    flat = [b"\n", b"a b \n", b"\n", b"b\xff long-word a \n", b"\n"]
    wanted = [int.from_bytes((context_mixing.START + t)[i : i + 6]) for t in flat for i in range(len(t))]
    assert keys.dtype == np.uint64 and keys.tolist() == wanted
    assert first.tolist() == np.cumsum([0, *map(len, flat[:-1])]).tolist()
    known, numbers = context_mixing.vocabulary(texts)
    assert list(known) == [b"a", b"b", b"b\xff", b"long-word"] and [n.tolist() for n in numbers] == [[], [0, 1], [], [2, 3, 0], []]
    assert context_mixing.vocabulary([]) == ({}, [])
