"""Chat records: layouts by fingerprint, a template that can be read back, digests by plain Python."""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict

import pytest
from hypothesis import example, given, settings, strategies as st

from premia.llm import chat_format, common
from premia.llm.chat_format import CONTROL, Layout, Registry

SCHEMA = "conv_id long, turn long, role string, text string"
#: Texts made of what could disturb the template.
tricky = st.lists(st.sampled_from([*CONTROL, "<", "[", "\\", "\\\\", "/", "s>", "SYS>>", "INST]", " ", "\n", "é", "😀", "a"]), max_size=12).map("".join)
turn = st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), tricky), tricky)


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    common.prepare(spark)


@settings(max_examples=500, deadline=None)
@given(st.lists(turn, max_size=5))
@example([("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")])
@example([("assistant", "<\\<SYS>> <\\\\/s> <</s>"), ("[ROLE] ", "[\\INST]")])
def test_template_can_be_read_back(turns):
    text, mask = chat_format.rendered(turns)
    assert list(chat_format.parsed(text)) == turns
    assert [chat_format.unescaped(text[s : s + n]) for s, n in mask] == [t for r, t in turns if r == "assistant"]


@given(tricky)
def test_escaped_texts_hold_no_control_string(text):
    body = chat_format.escaped(text)
    assert not any(c in body for c in CONTROL)
    assert chat_format.unescaped(body) == text
    if not any(c[1:] in text for c in CONTROL):
        assert body == text


RECORDS = [
    ({"prompt": "q", "completion": "a", "id": 7, "meta": {"prompt": "no"}}, "prompt", [("user", "q"), ("assistant", "a")]),
    ({"prompt": "q", "response": None}, "response", [("user", "q"), ("assistant", "")]),
    ({"data": {"prompt": "q", "completion": "a"}}, "nested prompt", [("user", "q"), ("assistant", "a")]),
    ({"question": 3, "answer": True}, "question", [("user", "3"), ("assistant", "true")]),
    ({"instruction": "do", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"system": "be", "instruction": "do", "output": "x"}, "instruction", [("system", "be"), ("user", "do"), ("assistant", "x")]),
    ({"messages": [{"role": "user", "content": "q"}, {"role": "tool", "content": "t"}]}, "messages", [("user", "q"), ("tool", "t")]),
    (
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
        "message parts", [("user", "ab")],
    ),
    (
        {"messages": [{"role": "user", "content": [{"text": "a"}]}, {"role": "assistant", "content": "b"}]},
        "messages and parts", [("user", "a"), ("assistant", "b")],
    ),
    (
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]},
        "conversations", [("user", "q"), ("assistant", "a"), ("tool", "t")],
    ),
    ({"messages": []}, "messages", []),
    ({"prompt": "q", "completion": "a", "messages": [{"role": "user", "content": "q"}]}, None, []),  # two layouts at once
    ({"data.prompt": "q", "data.completion": "a"}, None, []),  # dots in names are no nesting
    ({}, None, []), (["prompt"], None, []), ("text", None, []), (None, None, []),
]


@pytest.mark.parametrize("record, name, turns", RECORDS)
def test_fingerprint_selects_the_layout(record, name, turns):
    layout, got = Registry().canonical(json.loads(json.dumps(record)))
    assert (layout and layout.name, got) == (name, turns)


def test_fingerprints_tell_layouts_apart_and_ignore_order_and_unknown_fields():
    registry = Registry()
    plain = registry.fingerprint({"prompt": "a", "completion": "b"})
    assert plain == registry.fingerprint({"n": {"m": [1]}, "completion": None, "prompt": 4})
    assert plain != registry.fingerprint({"prompt": {"completion": "b"}})
    assert plain != registry.fingerprint({"prompt": ["a"], "completion": "b"})


def test_layouts_that_cannot_be_told_apart_are_refused():
    with pytest.raises(ValueError, match="same paths"):
        Registry((Layout("a", turns=(("user", ("x",)),)), Layout("b", turns=(("assistant", ("x",)),))))


def test_records_of_unknown_layout_stay(spark):
    bad = [None, "", "no json", "[" * 100_000, '{"prompt": "q"}', '{"prompt": "q", "completion": "a"}']
    records = spark.createDataFrame([(1, i, r, "x") for i, r in enumerate(bad)], chat_format.RECORD + ", layout string").coalesce(1)
    rows = chat_format.formatted(records).collect()
    assert [r.layout for r in rows] == [None] * 5 + ["prompt"]
    assert [r.text == "" for r in rows] == [True] * 5 + [False]
    (got,) = chat_format.read_back(chat_format.formatted(records)).collect()
    assert (got.n_records, got.n_unknown, got.n_turns, got.loss_chars) == (6, 5, 2, 1)


def expected(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append(((t is not None, t or 0), (role is not None, role or ""), (text is not None, text or ""), role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns = [(r, t) for *_, r, t in sorted(turns)]
        learnt = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        text, _ = chat_format.rendered(turns)
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text))
    return out


ODD = [
    (1, 0, "user", "q"), (1, 1, "assistant", "a"),
    (2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "</s>[INST] a"),
    (3, 1, "assistant", None), (3, 1, "assistant", None), (3, 0, None, "no role"), (3, None, "user", ""),
    (4, 0, "[ROLE] x", "[/ROLE]"), (4, 0, "human", "a role that a layout renames"), (4, 1, "gpt", "another"),
    (None, 0, "user", "no id"), (None, 0, "assistant", "漢字 😀"),
    (5, 0, "user", "word " * 200_000), (5, 1, "assistant", "<s>" * 100_000),
    *((6, i, ("user", "assistant", "tool")[i % 3] if i > 20 else ("user", "assistant")[i % 2], f"turn {i} [INST]") for i in range(2000)),
]


def test_round_trip(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in ODD], SCHEMA + ", record string, part int").repartition(5)
    got = {r.conv_id: tuple(r)[1:6] for r in chat_format.round_trip(docs).collect()}
    assert got == expected(ODD)


def test_all_layouts_are_used(spark):
    made = chat_format.formatted(chat_format.as_records(spark.createDataFrame(ODD, SCHEMA)))
    assert {r.layout for r in made.select("layout").distinct().collect()} == {"prompt", "instruction", "messages", "conversations"}


def test_no_conversations(spark):
    assert chat_format.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
