"""Every operator on odd rows and on an empty table."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from samples import PASSAGE, ROWS, empty, folder, messy

import corpus_pipeline
from premia.llm import block_naming, byte_cnn, common, context_mixing, curriculum, packing, personal_data, simhash, suffix_dedup, syncmers, url_rules
from premia.llm.queries import QUERIES, URL_RULES

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def sf(spark):
    common.prepare(spark)
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, 1, 0), (8, None, 0), (7, 1, 0), (99, 1, 1)], LABELS)
    pages = [(1, None, "x"), (2, "", None), (None, "http://a.NET/", "x"), (4, "no scheme", "x"), (4, "no scheme", "x")]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    return folder({"documents": messy(spark), "labels": labels, "pages": pages})


@pytest.fixture(scope="module")
def nothing(spark):
    common.prepare(spark)
    return folder({
        "documents": empty(spark), "labels": spark.createDataFrame([], LABELS),
        "pages": spark.createDataFrame([], "page_id long, url string, html string"),
        "conversations": spark.createDataFrame([], "conv_id long, turn long, role string, text string"),
    })


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_empty_tables_give_empty_results(spark, nothing, name):
    run = corpus_pipeline.run if name == "pipeline" else QUERIES[name]
    # The chat query brings one conversation of its own.
    assert run(spark, nothing).count() == (name == "op12_chat_format")


def norm(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def test_block_naming(spark, sf):
    got = {(r.doc_id, r.text_sha256): r for r in QUERIES["op2_block_naming"](spark, sf).collect()}
    texts = {(i, hashlib.sha256(norm(t).encode()).hexdigest()): norm(t) for i, t, *_ in ROWS}
    assert got.keys() == texts.keys()  # a repeated row is one document
    for key, text in texts.items():
        same = [i for i, t, *_ in ROWS if norm(t) == text]
        ids = [i for i in same if i is not None]
        assert got[key].group_size == len(same)
        assert got[key].keep_id == (min(ids) if ids else None)
        assert got[key].kept == (key[0] == got[key].keep_id)


@pytest.mark.parametrize("hashed", ["constant", "three values"])
def test_block_names_do_not_depend_on_the_hash(spark, hashed):
    from pyspark.sql import functions as F

    of = {"constant": lambda c: F.lit(0).cast("long"), "three values": lambda c: F.length(c).cast("long") % 3}[hashed]
    docs = messy(spark).where("doc_id < 9 or doc_id > 10 or doc_id is null")
    plain, clashing = (
        sorted(map(str, block_naming.groups(docs, block=5, **k).collect())) for k in ({}, {"hashed": of})
    )
    assert plain == clashing


def test_stages_keep_columns_and_types(spark, sf):
    docs = messy(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.dtypes == docs.dtypes, name
        assert out.count() > 0, name


def test_packing_stage_on_clashing_columns(spark, sf):
    """Columns named as the stage's own, also in a table read from files."""
    docs = messy(spark).withColumns({c: F.lit("x") for c in ("its_file", "its_row", "stretch", "before", "ids", "chunk")})
    name, stage = corpus_pipeline.STAGES[-1]
    want = sorted(tuple(r) for r in stage(spark, common.staged(messy(spark).coalesce(1)), sf).select("start", "length", "doc_tokens").collect())
    for given in (docs.coalesce(1), common.staged(docs.coalesce(1))):
        assert sorted(tuple(r) for r in stage(spark, given, sf).select("start", "length", "doc_tokens").collect()) == want


def test_deduplicated_keeps_one_row_of_each_text(spark):
    kept = block_naming.deduplicated(messy(spark), block=7).collect()
    assert sorted(norm(r.text) for r in kept) == sorted({norm(t) for _, t, *_ in ROWS})


def test_representatives(spark):
    docs = messy(spark)
    groups = simhash.grouped(docs)
    kept = simhash.representatives(docs).collect()
    assert len(kept) == groups.select("root").distinct().count()
    assert {r.doc_id for r in kept if r.doc_id is not None} <= {r.component_id for r in groups.collect()}


def test_simhash_of_empty_texts_is_zero(spark, sf):
    got = QUERIES["op6_simhash_groups"](spark, sf).collect()
    assert len(got) == len(ROWS)
    assert {r.fingerprint for r in got if r.doc_id in (4, 5, 6)} == {"0" * 16}
    assert {r.component_id for r in got if r.doc_id in (4, 5, 6)} == {4}


def test_mix(spark, sf):
    got = QUERIES["op3_curriculum_mix"](spark, sf).collect()
    assert len(got) == len(ROWS)
    assert all(r.taken <= 3 * r.size for r in got)
    assert sum(r.size for r in got) == sum(len(norm(t).split()) for _, t, *_ in ROWS)
    taken = curriculum.mixed(messy(spark)).groupBy("doc_id").count().collect()
    planned = curriculum.plan(messy(spark)).where("copies > 0").groupBy("doc_id").sum("copies").collect()
    assert sorted(map(tuple, taken), key=str) == sorted(map(tuple, planned), key=str)


def test_scores(spark, sf):
    got = QUERIES["op1_context_mixing"](spark, sf).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert r.score < 0 and r.base_score <= 0 and r.n_tokens >= 1
    assert {r.n_tokens for r in got if r.doc_id in (4, 5, 6)} == {1}


def test_pack(spark):
    pieces = packing.pieces(messy(spark), sequences=1, sequence=64).collect()
    assert sum(r.start == 0 for r in pieces) == len(ROWS)
    assert {r.doc_tokens for r in pieces if r.doc_id in (4, 5, 6)} == {1}
    ends = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert [n for s, n in sorted(ends.items())][:-1] == [64] * (len(ends) - 1)


def test_personal_data(spark, sf):
    got = QUERIES["op4_weak_supervision_pii"](spark, sf).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by_id[11].n_phone, by_id[11].n_card) == (1, 1)
    # Code points, not bytes or UTF-16 units.
    text = ROWS[13][1]
    assert f"phone:{text.index('+')}:{text.index(' x')}" in by_id[11].spans.split(",")
    assert by_id[4].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_fingerprints(spark, sf):
    got = QUERIES["op7_closed_syncmers"](spark, sf).collect()
    assert len(got) == len(ROWS)
    by_text = {}
    for r, (i, t, *_) in zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_chars)), sorted(ROWS, key=lambda r: (str(r[0]), len(r[1] or "")))):
        assert r.n_chars == len(t or "")
        assert by_text.setdefault(t or "", r.fingerprint) == r.fingerprint
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))


def test_one_document_follows_itself(spark):
    (row,) = syncmers.compared(messy(spark, ROWS[:1])).collect()
    assert row.near_next == 1.0
    only_nulls = syncmers.compared(messy(spark, [(None, "a b", None, None), (None, "c d", None, None)])).collect()
    assert len(only_nulls) == 2


def test_passages(spark, sf):
    got = {(r.doc_id, r.n_bytes): r for r in QUERIES["op8_suffix_dedup"](spark, sf).collect()}
    assert got[7, len(ROWS[9][1])].n_removed == 0
    assert got[8, len(ROWS[10][1])].n_removed == len(PASSAGE) + 1  # the space before it is shared, too
    size = len(ROWS[11][1])
    assert got[10, size + 5].n_removed == size
    assert got[None, 43].n_removed == 0  # shorter than a string


def test_urls(spark, sf):
    got = [tuple(r) for r in QUERIES["op10_url_rules"](spark, sf).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (None, "a.net", "/", "net/", "block"), (4, "", "", None, "allow"), (4, "", "", None, "allow")],
        key=str,
    )


def test_rules_need_not_hold_a_token():
    assert url_rules.rule_index([*URL_RULES, url_rules.Rule("ip", "block", r"^[0-9.]+", (), False)], {})[1] == [4]


def test_quality_without_labels_of_both_kinds(spark):
    docs = messy(spark)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in byte_cnn.classified(docs, none).collect()} == {0.5}
    good = spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS)
    assert all(r.predicted == 1 for r in byte_cnn.classified(docs, good).collect())


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    return [(r.rule, r.verdict) for r in sorted(url_rules.judge(pages, rules).collect(), key=lambda r: r.page_id)]


def test_words_are_cut_and_searched_in_one_alphabet(spark):
    casino = url_rules.word_rule("block", "casino")
    urls = ["http://a.org/MYcasino/", "http://a.org/\u212acasino/", "http://a.org/Casino/", "http://a.org/\u00c9casino", "http://CASINO.org", "http://a.org/xcasino"]
    assert [v for _, v in judged(spark, urls, [casino])] == ["allow", "block", "block", "block", "block", "allow"]


def test_many_rules_against_every_rule_on_every_url(spark):
    """100,000 generated rules; a URL meets few of them, and the verdicts are those of all of them."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    rules = {}
    while len(rules) < 100_000:
        host, path = ".".join(rng.choices(words, k=rng.choice([1, 2]))), "".join(f"/{w}" for w in rng.choices(words, k=rng.choice([0, 1]))) + "/"
        rules[host + path] = url_rules.place_rule(rng.choice(["block", "allow"]), host, path)
    listed = list(rules.values())
    some = rng.sample(listed, 60)
    urls = [f"https://{rng.choice(words)}.{r.name}{rng.choice(['', 'x', 'w1/w2'])}?q" for r in some] + [f"http://{w}.W1/" for w in words[:20]]
    want = []
    for u in urls:
        host, path = u.split("://")[1].split("?")[0].split("/", 1)
        key = host.lower() + "/" + path
        fits = [r for r in listed if r.name.split("/")[0].split(".")[-1] in key and re.search(r.regex, key)]
        best = max(fits, key=lambda r: (len(r.name), r.name), default=None)
        want.append((best.name, best.verdict) if best else (None, "allow"))
    assert judged(spark, urls, listed) == want
    index, always = url_rules.rule_index(listed, {})
    candidates = [sum(len(index.get(t, ())) for t in set(re.findall(url_rules.TOKEN, u.lower()))) for u in urls]
    assert not always and sum(candidates) / len(candidates) < 1000


def test_anchors_hash_elements_in_place_and_not_copied_slices(spark):
    rows = [(0, "a b c d e f g a b c d e"), (1, "x " * 30), (2, "漢字⺀ÀÉß×÷ " * 7 + "y" * 70), (3, "one two"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    token = F.regexp_extract_all("text", F.lit(r"[\p{IsHan}]|[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]{1,32}+(?![\p{L}\p{M}\p{N}&&[^\p{IsHan}]])|[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]|[^\s\p{L}\p{M}\p{N}]"), F.lit(0))
    hashes = F.transform(token, lambda t: F.xxhash64(t))
    found = docs.select("text", hashes.alias("h"), syncmers.anchors(F.col("text")).alias("found"))
    # A slice copies its elements, for every position of a text several times.
    assert "slice(namedlambdavariable()" not in found._jdf.queryExecution().optimizedPlan().toString()
    pairs = F.transform(F.sequence(F.lit(1), F.size("h") - 1), lambda i: F.xxhash64(F.slice("h", i, 2)))
    runs = F.transform(F.sequence(F.lit(1), F.size("h") - 5), lambda i: F.xxhash64(F.slice("h", i, 6)).bitwiseAND(F.lit(0xFFFFFFFF)))
    for r in found.where(F.size("h") >= 6).select("found", pairs.alias("pairs"), runs.alias("runs")).collect():
        last = len(r.runs) - 1
        chosen = [i for i in range(last + 1) if i in (0, last) or min(r.pairs[i : i + 5]) in (r.pairs[i], r.pairs[i + 4])]
        assert [(a["hash"], a["at"]) for a in r.found] == [(r.runs[i], i) for i in chosen]
