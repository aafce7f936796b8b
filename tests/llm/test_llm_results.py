"""Operators against SQL, brute force, round trips and held-out accuracy."""

from __future__ import annotations

import dataclasses
import hashlib
import math
import random
import re
import string
import struct
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from compare import connect, differences
from conftest import SF
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from premia.llm import byte_cnn, common, context_mixing, curriculum, packing, personal_data, simhash, suffix_dedup, syncmers
from premia.llm.queries import ORACLE, QUERIES
from premia.llm.text_blocks import packed


@pytest.fixture(scope="module")
def documents(spark):
    common.prepare(spark)
    return [(r.doc_id, r.text or "", r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]


@pytest.mark.parametrize("name", ORACLE)
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


# --- 1 -------------------------------------------------------------------------------------------------------


def test_baseline_and_model(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op1_context_mixing"](spark, SF).collect()}
    tokens = {i: [*t.encode().lower().split(), None] for i, t, _ in documents}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(w for i, x in tokens.items() if not held[i] for w in x)
    n, v = sum(c.values()), len(c)
    for i, x in tokens.items():
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (held[i], len(x), sum(c[w] > 0 for w in x), n)
        assert math.isclose(got[i].base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x), rel_tol=1e-9, abs_tol=1e-9)
        assert got[i].bits_per_byte > 0
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) / sum(r.n_bytes for r in out) > -0.9  # under 3 bits a byte


def some_model(keys, counts, seed=0):
    rng = np.random.default_rng(seed)
    model = context_mixing.Model.start()
    dense = [np.zeros(t.shape, np.float32) for t in model.tables]
    context_mixing.add_counts(dense, keys, counts.astype(np.float32))
    model.tables = [t.astype(np.uint16) for t in dense]
    model.weights = rng.normal(0.3, 0.2, model.weights.shape).astype(np.float32)
    model.refine = np.sort(rng.random(model.refine.shape), axis=1).astype(np.float32)
    return model


def test_next_byte_probabilities_add_up_to_one():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 100, 400).astype(np.uint8))]
    came, counts = np.unique(context_mixing.runs(texts)[0], return_counts=True)
    model = some_model(came, counts)
    unseen = rng.integers(0, 1 << 40, 5, dtype=np.uint64)
    for context in [*(came[:: len(came) // 15] >> np.uint64(8)), *unseen]:
        every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        keys = np.union1d(came, every)
        n = np.zeros(len(keys), np.int64)
        n[np.searchsorted(keys, came)] = counts
        cost = context_mixing.bits(model, keys, n)
        assert math.isclose(np.exp2(-cost[np.searchsorted(keys, every)]).sum(), 1, rel_tol=1e-6)


def test_bits_against_plain_python(monkeypatch):
    texts = [b"the cat sat on the mat", b"a cat, the cat and that hat", b"", b"x" * 40]
    came, counts = np.unique(context_mixing.runs(texts)[0], return_counts=True)
    model = some_model(came, counts)
    asked = np.union1d(came, context_mixing.runs([b"the hat sat on a zebra"])[0])
    n = np.zeros(len(asked), np.int64)
    n[np.searchsorted(asked, came)] = counts
    seen = Counter()
    for key, c in zip(came.tolist(), counts.tolist()):
        run = key.to_bytes(6)
        for order in range(6):
            for place in range(8):
                seen[run[5 - order : 5], f"{run[5]:08b}"[: place + 1]] += c
    expected = []
    for key in asked.tolist():
        run, cost = key.to_bytes(6), 0.0
        for place in range(8):
            word = f"{run[5]:08b}"
            pairs = [[seen[run[5 - order : 5], word[:place] + b] for b in "01"] for order in range(6)]
            chosen = max((o + 1 for o in range(6) if sum(pairs[o])), default=0) + place * 7
            logit = sum(w * math.log((b + 0.4) / (a + 0.4)) for w, (a, b) in zip(model.weights[chosen].tolist(), pairs))
            logit = min(12, max(-12, logit))
            at = (min(8, max(-8, logit)) + 8) * 2
            low = min(int(at), 31)
            refined = model.refine[chosen][low] * (1 - (at - low)) + model.refine[chosen][low + 1] * (at - low)
            p = min(1 - 1e-6, max(1e-6, (1 / (1 + math.exp(-logit)) + refined) / 2))
            cost -= math.log2(p if word[place] == "1" else 1 - p)
        expected.append(cost)
    assert np.allclose(context_mixing.bits(model, asked, n), expected, rtol=1e-4)
    monkeypatch.setattr(context_mixing, "CHUNK", 5)  # in parts that keep contexts together
    parts = list(context_mixing.grouped(asked))
    assert len(parts) > 3 and np.concatenate(parts).size == len(asked)
    for part in parts:
        assert np.allclose(context_mixing.bits(model, asked[part], n[part]), np.array(expected)[part], rtol=1e-4)


@pytest.mark.parametrize("fan_in", [2, 64])
def test_tables_are_summed_in_a_tree(spark, monkeypatch, fan_in):
    monkeypatch.setattr(context_mixing, "FAN_IN", fan_in)
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 101, 300).astype(np.uint8)) for _ in range(12)]
    rows = spark.createDataFrame([(i, False, bytearray(t)) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text binary")
    met = common.staged(context_mixing.merged_runs(common.staged(context_mixing.blocks(rows.repartition(5), 200)), 16).repartition(9))
    model = context_mixing.train(met, 16)
    came, counts = np.unique(context_mixing.runs(texts)[0], return_counts=True)
    for got, expected in zip(model.tables, some_model(came, counts).tables):
        assert np.array_equal(got, expected)


def test_share_among_earlier_tokens():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 4, n).tolist() for n in (1, 7, 30)]
    expected = [t[:i].count(w) / max(i, 1) for t in texts for i, w in enumerate(t)]
    got = context_mixing._earlier(np.array([w for t in texts for w in t]), np.array([len(t) for t in texts]))
    assert np.allclose(got, expected)


def test_byte_runs():
    keys, first = context_mixing.runs([b"Ab  c", b"", b"xyz"])
    ends = bytes(int(k) & 255 for k in keys)
    assert ends == b"ab c \n" + b"\n" + b"xyz \n"
    assert first.tolist() == [0, 6, 7]
    assert int(keys[7]) >> 8 == int.from_bytes(b"\n" * 5)


# --- 3 -------------------------------------------------------------------------------------------------------


@given(st.floats(0, 1), st.sampled_from(curriculum.SCHEDULES))
@settings(max_examples=40, deadline=None)
def test_schedule_areas(u, schedule):
    knots = schedule.knots
    area = schedule.integral()
    fine = np.linspace(0, 1, 2001)
    w = np.interp(fine, *zip(*knots))
    assert math.isclose(area[-1], np.trapezoid(w, fine), rel_tol=1e-6)


def test_positions_meet_demand(spark):
    schedule = curriculum.SCHEDULES[2]
    from pyspark.sql import functions as F

    shares = [i / 20 for i in range(21)]
    got = spark.createDataFrame([(s,) for s in shares], "u double").select(schedule.position(F.col("u"))).collect()
    fine = np.linspace(0, 1, 20_001)
    w = np.interp(fine, *zip(*schedule.knots))
    met = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2)]) / ((w[1:] + w[:-1]) / 2).sum()
    for u, (t,) in zip(shares, got):
        assert math.isclose(np.interp(t, fine, met), u, abs_tol=1e-3)


def test_words_taken_come_near_targets(spark):
    for r in curriculum.plan(spark.read.parquet(f"{SF}/documents.parquet")).groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"] / 2 + 1


# --- 4 -------------------------------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    d = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        value = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return 12 <= len(d) <= 19 and value % 10 == 0
    return 9 <= len(d) <= 15 if kind == "phone" else True


TRICKY = [
    "a@b.c.%x@d.e x@y a.b@c-d.org. me@@you.com", "1.2.3.4.5.6.7.8 300.1.1.1 0001.02.003.255 1.2.3", "9" * 5000, "1 " * 5000,
    "+1 (344) 555-6605 and 4111 1111 1111 1111 4111-1111-1111-1112 +12 +1((((((9 +123456789012345678",
    ("a" * 300 + "@b.c ") * 3, "é😀 +49 30 1234567 漢字 4111111111111111", " ".join(f"10.0.{i % 256}.{i % 200}" for i in range(700)),
]


def test_base_spans(spark, documents):
    texts = [t for _, t, _ in documents] + TRICKY
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in personal_data.digested(personal_data.spans(df)).collect()}
    for i, t in enumerate(texts):
        found = sorted((m.start(), k, m.end(), kind) for k, kind in enumerate(PLAIN) for m in re.finditer(PLAIN[kind], t) if passes(kind, m[0]))
        base = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in found)
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[3] == kind for x in found) for kind in PLAIN]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_reliable_labelers_are_found():
    rng = random.Random(1)
    counts = Counter()
    for _ in range(4000):
        y = rng.random() < 0.4
        votes = tuple(int(y if rng.random() < q else not y) for q in (0.95, 0.9, 0.6, 0.85))
        counts["card", votes] += 1
    posterior, rates = personal_data.reliabilities(counts)
    good = [a - b for a, b in rates["card"]]
    assert good[0] > good[2] and good[1] > good[2] and good[3] > good[2]
    assert posterior["card", (1, 1, 0, 1)] > 0.9 > 0.1 > posterior["card", (0, 0, 1, 0)]


def test_method_adds_spans_beside_base_ones(spark):
    rows = [f"please call (555) 123-45{i:02d} today" for i in range(40)] + [f"the password = {i:02d}aaff00112233445566 was" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    kinds = Counter(s.kind for r in personal_data.spans(df).collect() for s in r.spans)
    assert kinds == {"local_phone": 40, "credential": 40}


# --- 5 -------------------------------------------------------------------------------------------------------


@given(st.lists(st.integers(1, 500), min_size=1, max_size=8), st.integers(8, 64), st.booleans())
@settings(max_examples=40, deadline=None)
def test_service_in_closed_form(totals, window, even):
    totals = np.array(totals, np.int64)
    share = np.ones(len(totals)) if even else totals.astype(float)
    rates = share / share.sum() * window
    n = -(-int(totals.sum()) // window)
    state = packing.served(np.arange(n + 1), totals, rates, window)
    assert (np.diff(state, axis=0) >= 0).all() and (state[-1] == totals).all()
    assert (state.sum(axis=1) == np.minimum(np.arange(n + 1) * window, totals.sum())).all()
    # While every queue has tokens, deficits stay within the rounding of the sources' own and the others' tokens.
    busy = (state < totals).all(axis=1)
    off = np.abs(state - np.arange(n + 1)[:, None] * rates)
    assert (off[busy] <= 1.5 + len(totals) / 2 * rates / window + 1e-6).all()


@pytest.mark.parametrize("even", [False, True])
def test_pieces_hold_the_documents(spark, documents, even):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t, _ in documents}
    shares = {s: 1.0 for _, _, s in documents} if even else None
    pieces = packing.pieces(spark.read.parquet(f"{SF}/documents.parquet"), shares=shares, sequence=512, sequences=4).collect()
    back: dict[int, list[int]] = {}
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.length, r.doc_tokens) == (len(back.setdefault(r.doc_id, [])), len(ids), len(want[r.doc_id]))
        back[r.doc_id] += ids
    assert back == want
    filled = Counter()
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert all(n == 512 for s, n in filled.items() if s < max(filled))


def test_sequences_are_padded_except_at_powers_of_two(spark):
    rows = [(0, 0, 3, b"\1\0\0\0" * 3), (0, 3, 5, b"\2\0\0\0" * 5), (1, 0, 3, b"\3\0\0\0" * 3)]
    df = spark.createDataFrame(rows, "sequence_id long, offset long, length long, ids binary")
    got = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences_of(df, sequence=16).collect()}
    assert got == {0: [1] * 3 + [2] * 5, 1: [3] * 3 + [0] * 13}


# --- 6 -------------------------------------------------------------------------------------------------------


@given(st.integers(0, 9), st.integers(1, 150), st.integers(0, 1 << 30))
@settings(max_examples=25, deadline=None)
def test_bit_sliced_distances(radius, n, seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    b = np.concatenate([a ^ (rng.integers(0, 1 << 63, n, dtype=np.uint64) & rng.integers(0, 1 << 63, n, dtype=np.uint64) & np.uint64(0x842108421)), a[: n // 2]])
    q, t = simhash.close_pairs(a, b, radius)
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    assert set(zip(q.tolist(), t.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))


def roots(prints, radius):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    array = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= radius):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def simhash_of(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if hashes and sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_groups(spark, documents):
    prints = [simhash_of(t) for _, t, _ in documents]
    want = [(i, f"{p:016x}", documents[r][0]) for (i, *_), p, r in zip(documents, prints, roots(prints, 4))]
    assert sorted(map(tuple, QUERIES["op6_simhash_groups"](spark, SF).collect())) == want


def test_crowded_buckets_lose_no_link(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 62, 4)
    prints = sorted({int(centres[i % 4]) ^ sum(1 << int(b) for b in rng.integers(0, 20, 5)) for i in range(900)})
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.links(nodes, 4, chunk=50)
    named = {r.u: r.root for r in simhash.components(edges).collect()}
    want = roots(prints, 4)
    assert [named.get(p, p) for p in prints] == [prints[r] for r in want]


# --- 7 -------------------------------------------------------------------------------------------------------

SINGLE = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}"
TOKENS = regex.compile(rf"(?V1)[{SINGLE}]|[[\p{{L}}\p{{M}}\p{{N}}]--[{SINGLE}]]+|[^\s\p{{L}}\p{{M}}\p{{N}}]")


def chained(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", v), seed)
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def cut(word):
    """A long word but for its last 32 characters as single characters."""
    return [*word[:-32], word[-32:]] if len(word) > 32 else [word]


def brute_anchors(text, k=6, s=2):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for word in TOKENS.findall(text) for w in cut(word)]
    if len(h) < k:
        return [chained(h) & 0xFFFFFFFF] if h else []
    g = [signed(chained(h[i : i + s])) for i in range(len(h) - s + 1)]
    last = len(h) - k
    return [chained(h[i : i + k]) & 0xFFFFFFFF for i in range(last + 1) if i in (0, last) or min(g[i : i + k - s + 1]) in (g[i], g[i + k - s])]


def dice(a, b):
    a, b = set(a), set(b)
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


@pytest.mark.parametrize("rows", [7, 2048])
def test_fingerprints_and_edits(spark, documents, rows, monkeypatch):
    monkeypatch.setattr(syncmers.with_next, "__defaults__", (rows,))
    got = {r.doc_id: r for r in QUERIES["op7_closed_syncmers"](spark, SF).collect()}
    assert len(got) == len(documents)
    for n, (i, t, _) in enumerate(documents):
        after = documents[(n + 1) % len(documents)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        a, e = brute_anchors(t), brute_anchors(edited)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == ("".join(f"{x:08x}" for x in a), "".join(f"{x:08x}" for x in e))
        assert (r.near_edited, r.near_next) == (dice(a, e), dice(a, brute_anchors(after)))


def test_texts_without_spaces_have_many_anchors(spark):
    rng = random.Random(3)
    kinds = {"base64": string.ascii_letters + string.digits, "khmer": [chr(c) for c in range(0x1780, 0x17B4)], "wide": [chr(c) for c in range(0x10400, 0x10450)]}
    texts = ["".join(rng.choices(kinds[k], k=n)) for k in kinds for n in (32, 33, 800, 800)]
    texts += ["a " * 50 + "b" * 40 + " c", "x" * 31 + "-" + "y" * 33]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(syncmers.compared(docs).collect())
    for r, text in zip(got, texts):
        assert [a["hash"] for a in r.anchors] == brute_anchors(text)
        if len(text) == 800:
            assert len(r.anchors) > 200 and 0.35 < r.near_edited < 0.7


# --- 8 -------------------------------------------------------------------------------------------------------


def brute_cuts(docs):
    first = {}
    for i, t in docs:
        for p in range(len(t) - 49):
            s = t[p : p + 50]
            first[s] = min(i, first.get(s, i))
    out = []
    for i, t in docs:
        mask = np.zeros(len(t) + 1, int)
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                mask[p : p + 50] = 1
        kept = bytes(b for b, m in zip(t, mask) if not m)
        out.append((i, len(t), len(t) - len(kept), int((np.diff(mask, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_cuts_of_documents(spark, documents, hot):
    got = suffix_dedup.digested(suffix_dedup.removed(spark.read.parquet(f"{SF}/documents.parquet"), 60_000, 60_000, hot))
    assert sorted(map(tuple, got.collect())) == brute_cuts([(i, t.encode()) for i, t, _ in documents])


def shared_passage(n, seed=3):
    """Documents of which each third holds one passage, each time between other bytes."""
    rng = np.random.default_rng(seed)
    other = lambda: bytes(rng.integers(97, 123, 120).astype(np.uint8))
    passage = other()
    return [(i, other() + (passage if i % 3 == 0 else b"") + other()) for i in range(n)]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 20])
def test_cuts_of_a_passage_in_a_third_of_the_documents(spark, hot):
    docs = shared_passage(300)
    df = spark.createDataFrame([(i, t.decode()) for i, t in docs], "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, suffix_dedup.digested(suffix_dedup.removed(df, 8000, 4000, hot)).collect()))
    assert got == brute_cuts(docs)
    assert sum(r[3] for r in got) == 99


def test_strings_of_a_hot_anchor_spread_over_shards():
    docs, shards = shared_passage(900), 16
    payload = packed(pa.table({"id": [i for i, _ in docs], "text": pa.array([t for _, t in docs], pa.binary())}))
    runs = suffix_dedup.anchored([t for _, t in docs])
    asked = suffix_dedup._asked(runs.key, shards)
    around = suffix_dedup.surroundings(runs, asked, shards)
    assert 299 <= around.max() <= 302 and np.median(around) == 1
    largest = []
    for limit in (1000, 20):
        answer = {}
        for shard, s, e in suffix_dedup._by_shard((asked >> np.uint64(32)).astype(np.int64)):
            none, hot = np.zeros(e - s, bool), around[s:e] > limit
            answer[shard] = b"".join(np.packbits(m).tobytes() for m in ((none, hot) if hot.any() else (none,)))
        block = suffix_dedup.candidates(payload, answer, shards)
        assert (np.diff(block.shard) >= 0).all()
        strings = np.bincount(block.shard, [len(b) - 49 for b in block.distinct], shards)
        largest.append(strings.max() / strings.sum())
    assert largest[0] > 0.4 and largest[1] < 0.15  # 1 in 16, and anchors that few surroundings choose


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_cuts_of_repetitive_bytes(spark, monkeypatch, hot):
    rng = np.random.default_rng(0)
    base = [bytes(rng.integers(97, 100, rng.integers(0, 300)).astype(np.uint8)) for _ in range(30)]
    docs = [(i % 40, base[rng.integers(30)][: rng.integers(1, 300)] + b"ab" * int(rng.integers(0, 60)) + base[rng.integers(30)]) for i in range(60)]
    df = spark.createDataFrame([(i, t.decode()) for i, t in docs], "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffix_dedup, "SLICE", 97)  # texts in overlapping parts
    got = suffix_dedup.digested(suffix_dedup.removed(df, 2000, 2000, hot))
    assert sorted(map(tuple, got.collect())) == brute_cuts(docs)


def sent(docs, shards=16):
    """The candidates of one block whose anchors no other block has."""
    payload = packed(pa.table({"id": pa.array([i for i, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.binary())}))
    runs = suffix_dedup.anchored([t for _, t in docs])
    asked = suffix_dedup._asked(runs.key, shards)
    none = {k: np.packbits(np.zeros(e - s, bool)).tobytes() for k, s, e in suffix_dedup._by_shard((asked >> np.uint64(32)).astype(np.int64))}
    return payload, none, suffix_dedup.candidates(payload, none, shards)


def test_a_block_is_searched_without_python_per_string():
    docs = shared_passage(300)
    docs += [(i + 300, t) for i, t in docs]
    payload, none, block = sent(docs)
    assert len(block.runs.key) > 8000
    calls = 0

    def watch(frame, event, _):
        nonlocal calls
        calls += event in ("call", "c_call") and frame.f_code.co_filename == suffix_dedup.__file__

    sys.setprofile(watch)
    try:
        suffix_dedup.candidates(payload, none, 16)
    finally:
        sys.setprofile(None)
    assert calls < len(block.runs.key) / 2


def test_only_texts_that_share_an_anchor_are_sorted(monkeypatch):
    docs = shared_passage(90)
    _, _, block = sent(docs + [(i + 90, t) for i, t in docs])
    seen, sort = [], suffix_dedup._sorted
    monkeypatch.setattr(suffix_dedup, "_sorted", lambda b: (seen.append(len(b.count)), sort(b))[1])
    some = suffix_dedup.smallest(block.bodies)
    assert 30 <= sum(seen) < len(block.distinct) / 4
    assert np.array_equal(some, sort(block.bodies))
    strings = [b[p : p + 50] for b in block.distinct for p in range(len(b) - 49)]
    first = {}
    for s, i in zip(strings, np.repeat(block.bodies.least, block.bodies.count).tolist()):
        first[s] = min(i, first.get(s, i))
    assert some.tolist() == [first[s] for s in strings]


def test_unequal_texts_of_one_hash_stay_apart(monkeypatch):
    _, _, block = sent(shared_passage(30) + [(i + 30, t) for i, t in shared_passage(30)])
    twice = suffix_dedup.Bodies(*(np.concatenate([getattr(block.bodies, f.name)] * 2) for f in dataclasses.fields(block.bodies)))
    least = suffix_dedup.smallest(block.bodies)
    monkeypatch.setattr(suffix_dedup, "_mixed", lambda columns: np.zeros(len(next(iter(columns))), np.uint64))
    every, number, _ = twice.merged()
    assert np.array_equal(every.words[number], twice.words) and np.array_equal(every.anchor[number], twice.anchor)
    assert np.array_equal(suffix_dedup.smallest(block.bodies), least)
    again = suffix_dedup.Bodies.of(twice.data())
    assert all(np.array_equal(getattr(again, f.name), getattr(twice, f.name)) for f in dataclasses.fields(again))


# --- 9 -------------------------------------------------------------------------------------------------------


def test_slices_pool_like_the_whole(monkeypatch):
    net = byte_cnn.Net.start()
    rng = np.random.default_rng(0)
    texts = [rng.integers(1, 256, n, dtype=np.uint8).tobytes() for n in (0, 1, 7, 8, 9, 63, 64, 65, 1000)]
    whole = net.pooled(texts)
    monkeypatch.setattr(byte_cnn, "SLICE", 64)
    assert np.allclose(net.pooled(texts), whole, atol=1e-5)
    assert np.allclose(np.vstack([net.pooled([t]) for t in texts]), whole, atol=1e-5)


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = byte_cnn.classified(docs, labels).join(labels, "doc_id").where("held_out").collect()
    y, p = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    wins = (p[y == 1][:, None] > p[y == 0][None, :]).mean()
    assert wins > 0.9
    assert (p[y == 1] >= byte_cnn.THRESHOLD).mean() > 0.9


# --- pipeline ------------------------------------------------------------------------------------------------


def test_pipeline_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    seen = {"": ids(docs)}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.staged(stage(spark, docs, SF))
        seen[name] = ids(docs)
        if name != "packing":
            assert docs.columns == before.columns
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    first = {}
    for i in seen["quality"]:
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", texts[i]), i)
    assert seen["exact_dedup"] == sorted(first.values())
    prints = [simhash_of(texts[i]) for i in seen["exact_dedup"]]
    assert seen["near_dedup"] == [i for n, (i, r) in enumerate(zip(seen["exact_dedup"], roots(prints, 4))) if r == n]
    copies = Counter(seen["mixing"])
    assert set(copies) <= set(seen["near_dedup"]) and max(copies.values()) <= 3
    assert Counter(r.doc_id for r in docs.where("start = 0").collect()) == copies
