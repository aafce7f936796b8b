"""Chat records of many layouts in one template, and back.

A record is a JSON object. Its nested field paths (``messages[].role``) are hashed into a fingerprint, and the fingerprint
selects a declarative layout: where turns, roles and texts stand in such records. Fields that no layout names have no
part in the fingerprint, so records may carry any others. A layout's turns, in order, are rendered in one template whose
markers no text can hold: control strings in texts are escaped by one more backslash behind their first character, which
can be undone whatever backslashes a text has. The loss mask names the places of assistant texts in the rendered string.

A conversation may be spread over any number of records. What a task holds is one record, so conversations of any length
pass; as its digests run over all its turns in order, one conversation is read back by one task.

Null and missing texts and roles count as empty, values that are no strings count as their JSON text. Records that are
null, no JSON object, or of unknown layout render as nothing, stay in the result without a layout, and are counted.
Rows of one conversation go by turn (null first), then role, then text; repeated rows are turns of their own, rows without a
conversation id are one conversation. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from premia.llm.common import ship

ship(__name__)

Turn = tuple[str, str]


# --- layouts -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Where a record's turns stand.

    Either ``turns``: (role, paths) in order, texts of several paths joined by a blank line; or ``each``: the path of a list
    whose items give ``role`` and ``text`` by paths of their own. Records may lack the paths in ``optional``; turns all of
    whose paths they lack are left out.
    """

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str = ""
    role: str = ""
    text: tuple[str, ...] = ()
    optional: frozenset[str] = frozenset()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self) -> frozenset[str]:
        """All paths a record of this layout can have."""
        if self.each:
            return frozenset(f"{self.each}.{p}" for p in (self.role, *self.text))
        return frozenset(p for _, paths in self.turns for p in paths)


NAMES = {"human": "user", "gpt": "assistant"}
LAYOUTS = (
    Layout("prompt", turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("response", turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("nested prompt", turns=(("user", ("data.prompt",)), ("assistant", ("data.completion",)))),
    Layout("question", turns=(("user", ("question",)), ("assistant", ("answer",)))),
    Layout(
        "instruction",
        turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
        optional=frozenset({"system", "input"}),
    ),
    Layout("messages", each="messages[]", role="role", text=("content",)),
    Layout("message parts", each="messages[]", role="role", text=("content[].text",)),
    Layout("messages and parts", each="messages[]", role="role", text=("content", "content[].text")),
    Layout("conversations", each="conversations[]", role="from", text=("value",), roles=NAMES),
)


def paths(value) -> set[str]:
    """Nested field paths of the leaves: names joined by dots, ``[]`` for list items. Dots and brackets in names are marked."""
    out, left = set(), [(value, "")]
    while left:
        at_value, at = left.pop()
        if isinstance(at_value, dict) and at_value:
            names = ((k.replace("\\", "\\\\").replace(".", "\\.").replace("[", "\\["), v) for k, v in at_value.items())
            left += [(v, f"{at}.{k}" if at else k) for k, v in names]
        elif isinstance(at_value, list) and at_value:
            left += [(v, f"{at}[]") for v in at_value]
        else:
            out.add(f"{at}[]" if isinstance(at_value, list) else at)
    return out


def hashed(known: Iterable[str]) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(known)))


@dataclass
class Registry:
    """Layouts by fingerprint."""

    layouts: tuple[Layout, ...] = LAYOUTS

    def __post_init__(self) -> None:
        self.known = frozenset().union(*(x.paths() for x in self.layouts))
        self.by_fingerprint: dict[int, Layout] = {}
        empty = set()
        for x in self.layouts:
            always = x.paths() - x.optional
            for n in range(len(x.optional) + 1):
                for more in itertools.combinations(sorted(x.optional), n):
                    key = hashed(always | set(more))
                    if self.by_fingerprint.setdefault(key, x) is not x:
                        raise ValueError(f"layouts {x.name!r} and {self.by_fingerprint[key].name!r} have the same paths")
            if x.each and x.each not in empty:  # an empty list has no items whose fields could be seen
                empty.add(x.each)
                self.by_fingerprint[hashed({x.each})] = x
        self.known |= empty

    def fingerprint(self, record) -> int:
        return hashed(paths(record) & self.known)

    def canonical(self, record) -> tuple[Layout | None, list[Turn]]:
        if not isinstance(record, dict):
            return None, []
        layout = self.by_fingerprint.get(self.fingerprint(record))
        return layout, [] if layout is None else list(turns_of(record, layout))


def found(value, path: str) -> list:
    """All values at a path, in order."""
    out = [value]
    for name in path.replace("[]", ".[]").split("."):
        if name == "[]":
            out = [v for x in out if isinstance(x, list) for v in x]
        elif name:
            out = [x[name] for x in out if isinstance(x, dict) and name in x]
    return out


def as_text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, layout: Layout) -> Iterator[Turn]:
    for role, at in layout.turns:
        texts = [as_text(v) for p in at for v in found(record, p)]
        if texts:
            yield role, "\n\n".join(texts)
    if layout.each:
        for item in found(record, layout.each):
            role = "".join(as_text(v) for v in found(item, layout.role))
            texts = []
            for p in layout.text:
                # Text and parts can stand under one name: each path takes only what is no list.
                texts += [as_text(v) for v in found(item, p) if not isinstance(v, (list, dict))]
            yield layout.roles.get(role, role), "".join(texts)


# --- template ------------------------------------------------------------------------------------------------

# Control strings, and what stands before and after a text of each role.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]")
AROUND = {
    "system": ("<<SYS>> ", " <</SYS>>\n"),
    "user": ("[INST] ", " [/INST]\n"),
    "assistant": ("<s> ", " </s>\n"),
}
OTHER = ("[ROLE] ", " [/ROLE] ", " [/TURN]\n")

_RESTS = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_RESTS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_RESTS})")


def escaped(text: str) -> str:
    return _PLAIN.sub(r"\1\2\\", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def rendered(turns: Iterable[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """The turns in the template, and start and length of every assistant text in it."""
    out, mask, length = [], [], 0
    for role, text in turns:
        body = escaped(text)
        before, after = AROUND[role] if role in AROUND else (OTHER[0] + escaped(role) + OTHER[1], OTHER[2])
        if role == "assistant":
            mask.append((length + len(before), len(body)))
        out += [before, body, after]
        length += len(before) + len(body) + len(after)
    return "".join(out), mask


def parsed(text: str) -> Iterator[Turn]:
    """The turns of a rendered string."""
    at = 0

    def until(marker: str) -> str:
        nonlocal at
        end = text.index(marker, at)
        piece, at = text[at:end], end + len(marker)
        return unescaped(piece)

    while at < len(text):
        for role, (before, after) in AROUND.items():
            if text.startswith(before, at):
                at += len(before)
                yield role, until(after)
                break
        else:
            if not text.startswith(OTHER[0], at):
                raise ValueError(f"no turn begins at {at}")
            at += len(OTHER[0])
            yield until(OTHER[1]), until(OTHER[2])


# --- tables --------------------------------------------------------------------------------------------------

RECORD = "conv_id long, part long, record string"
RENDERED = "conv_id long, part long, fingerprint string, layout string, text string, mask array<struct<start: long, length: long>>"
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_records long, n_unknown long"
)


def arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def mapped(df: DataFrame, schema: str, run: Callable[[Iterator[dict]], Iterator[tuple]]) -> DataFrame:
    """Rows through ``run``, as dictionaries in and tuples out, in batches of bounded size."""
    out_schema = arrow(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for s in range(0, b.num_rows, 64) for row in b.slice(s, 64).to_pylist())
        held, size = [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out_schema)], schema=out_schema)

        for made in run(rows):
            held.append(made)
            size += sum(len(v) for v in made if isinstance(v, str))
            if len(held) >= 512 or size > 4 << 20:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return df.mapInArrow(task, schema)


def together(rows: DataFrame, *order: str) -> DataFrame:
    """Rows of a conversation in one task and in order. Later steps over rows keep them so."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def as_records(turns: DataFrame, most: int = 8) -> DataFrame:
    """Turns (conv_id, turn, role, text) as records of up to ``most`` turns, each in the plainest layout that can hold it.

    One question and answer are a prompt, with a system text before them an instruction; what has only the roles that have
    a name in ``conversations`` goes there in every second record, all else is messages.
    """

    def record(turns: list[Turn], part: int) -> dict:
        who, texts = [r for r, _ in turns], [t for _, t in turns]
        if who == ["user", "assistant"]:
            return {"prompt": texts[0], "completion": texts[1]}
        if who == ["system", "user", "assistant"]:
            return {"system": texts[0], "instruction": texts[1], "output": texts[2]}
        back = {v: k for k, v in NAMES.items()}
        if part % 2 and all(r in back for r in who):
            return {"conversations": [{"from": back[r], "value": t} for r, t in turns]}
        return {"messages": [{"role": r, "content": t} for r, t in turns]}

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for conv, its in itertools.groupby(rows, key=lambda r: r["conv_id"]):
            for part in itertools.count():
                taken = [(r["role"] or "", r["text"]) for r in itertools.islice(its, most)]
                if not taken:
                    break
                yield conv, part, json.dumps(record(taken, part), ensure_ascii=False)

    return mapped(together(turns.select("conv_id", "turn", "role", "text"), "turn", "role", "text"), RECORD, run)


def formatted(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Records (conv_id, part, record) in the template, with fingerprint, layout and loss mask; row order is kept."""

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        registry = Registry(layouts)
        for r in rows:
            try:
                value = json.loads(r["record"] or "null")
            except (ValueError, RecursionError):
                value = None
            layout, turns = registry.canonical(value)
            text, mask = rendered(turns)
            mark = f"{registry.fingerprint(value):016x}" if isinstance(value, dict) else None
            yield r["conv_id"], r["part"], mark, layout and layout.name, text, [{"start": s, "length": n} for s, n in mask]

    return mapped(records.select("conv_id", "part", "record"), RENDERED, run)


def read_back(rendered_rows: DataFrame) -> DataFrame:
    """One row per conversation with digests of its turns and of the text under its loss mask, from the template alone.

    The rows of a conversation have to stand together in order, see :func:`together`.
    """

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for conv, its in itertools.groupby(rows, key=lambda r: r["conv_id"]):
            said, learnt = hashlib.sha256(), hashlib.sha256()
            n_turns = loss = chars = n_records = unknown = 0
            for r in its:
                n_records += 1
                unknown += r["layout"] is None
                chars += len(r["text"])
                for role, text in parsed(r["text"]):
                    n_turns += 1
                    said.update(f"{role}\n{text}\n".encode())
                for span in r["mask"]:
                    text = unescaped(r["text"][span["start"] : span["start"] + span["length"]])
                    loss += len(text)
                    learnt.update(text.encode())
            yield conv, n_turns, said.hexdigest(), loss, learnt.hexdigest(), chars, n_records, unknown

    return mapped(rendered_rows.select("conv_id", "part", "layout", "text", "mask"), DIGEST, run)


def round_trip(turns: DataFrame) -> DataFrame:
    """Turns to records, records to the template, and the digests of what the template says."""
    return read_back(formatted(as_records(turns)))
