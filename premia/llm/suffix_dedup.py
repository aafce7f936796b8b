"""Removing repeated passages with suffixes sorted bucket by bucket under a cover sample.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a document with a smaller id. Only the
suffixes that can have such a twin are sorted. Each string of ``LENGTH`` bytes has an anchor, the place of the least
hash among its runs of ``RUN`` bytes, and equal strings have equal anchors; so

1. each block of documents tells shards the hashes of its anchors and how many distinct texts surround each, and hears
   which of them other blocks have, too, and which are hot, that is have more than ``HOT`` texts around them in all;
2. strings with such anchors go to their anchor's shard, neighbours with the same anchor as one text, each distinct text
   once per block. A text whose anchor no other text of the shard has is held by its own documents alone. A shard lays the
   others out so that anchors stand at multiples of ``PERIOD``, ranks the positions of a difference cover modulo
   ``PERIOD`` by the ``SAMPLE`` bytes that follow, and sorts one suffix bucket (first byte) at a time: by the first 8
   bytes, ties by the rank of the next cover position, then by the last 8. Equal strings stand at equal residues, so one
   cover position settles a tie, and no more than a bucket is sorted at once;
3. blocks hear the smallest document of every string, and where their strings stand, and cut.

Texts are rows of words, so that hashing, comparing and merging them is array work; equal hashes are compared.

Shards grow in number with the corpus. A passage that many documents share is sent once per block; where it begins and
ends, its anchors have other surroundings in each document. Such a hot anchor has no shard of its own: each of its strings
goes alone to the shard of its bytes' hash, where equal strings still meet, so that the surroundings of one anchor
spread over all shards. Matches never cross documents, and strings are judged on the input.

Null texts are empty. Null ids count as larger than any other and do not remove each other's bytes; rows with the same
id never remove each other's bytes. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from premia.llm.common import ship, staged, text_or_empty
from premia.llm.text_blocks import blocks, packed, unpacked

ship(__name__)

LENGTH = 50
RUN = 24
PERIOD = 13
COVER = (0, 1, 3, 9)
#: From the first cover position (at most 5 on) these bytes reach the last eight of a string.
SAMPLE = LENGTH - 8
#: Bytes of a text's place in a shard: at most PERIOD - 1 of padding, 2 * LENGTH - RUN of text, a multiple of PERIOD.
PLACE = 8 * PERIOD
BLOCK_BYTES = 4 << 20
#: Bytes hashed at once; their arrays fit in a core's cache.
SLICE = 1 << 16
#: Bytes of input for each shard, about 14 to an anchor.
SHARD_BYTES = 8 << 20
#: Texts around one anchor that may meet in its shard; each has at most 27 strings.
HOT = 8192
NO_ID = np.iinfo(np.int64).max
#: Words of eight bytes that hold the longest text, and for each word which of its bytes belong to a text of so many strings.
WORDS = -(-(2 * LENGTH - RUN) // 8)
KEEP = np.array(
    [[(1 << 8 * min(max(c + LENGTH - 1 - 8 * k, 0), 8)) - 1 for c in range(LENGTH - RUN + 2)] for k in range(WORDS)], np.uint64
)
#: Kinds of the columns of ``Block.places``: text, start (both as differences), count, number.
PLACES = (np.int32, np.int32, np.uint8, np.int32)


def words_at(data: np.ndarray, order: str = ">") -> np.ndarray:
    """The eight bytes from each position as an integer, by default one whose order is theirs; no memory of its own."""
    return np.ndarray((len(data) - 7,), f"{order}u8", data, strides=(1,))


def _mixed(columns: Iterable[np.ndarray]) -> np.ndarray:
    """A hash of each row of these columns."""
    h = np.uint64(0)
    for c in columns:
        h = (c.astype(np.uint64) ^ h) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, the number of each key among them, and where each first stands."""
    order = np.argsort(keys)
    new = np.append(True, keys[order[1:]] != keys[order[:-1]])[: len(keys)]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    first = np.minimum.reduceat(order, starts) if len(starts) else starts
    return keys[first], number, first


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each ``first``, as many as its size."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


@dataclass
class Runs:
    """Neighbouring strings with the same anchor: text number, first start within the text, how many, anchor's offset.

    ``key`` is the anchor's hash, ``body`` that of all bytes of the strings.
    """

    text: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    key: np.ndarray
    body: np.ndarray

    def pick(self, which: np.ndarray) -> Runs:
        return Runs(*(getattr(self, f.name)[which] for f in fields(self)))

    def singly(self) -> Runs:
        """Each string as a run of its own."""
        inside = np.arange(self.count.sum()) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        each = self.pick(np.repeat(np.arange(len(self.count)), self.count))
        return Runs(each.text, each.start + inside, np.ones_like(inside), each.anchor - inside, each.key, each.body)


def _slices(texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (text, from, to) of about SLICE bytes; parts of a long text overlap so that no string is lost."""
    waiting, held = [], 0
    for i, t in enumerate(texts):
        for s in range(0, len(t) - LENGTH + 1, SLICE):
            e = min(len(t), s + SLICE + LENGTH - 1)
            waiting.append((i, s, e))
            held += e - s
            if held >= SLICE:
                yield waiting
                waiting, held = [], 0
    if waiting:
        yield waiting


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, for each start."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return out if have == width else np.minimum(out[: len(out) - (width - have)], out[width - have :])


def anchored(texts: list[bytes]) -> Runs:
    """All strings of the texts, grouped by neighbours with the same anchor."""
    found: list[Runs] = []
    for parts in _slices(texts):
        flat = b"".join(texts[i][s:e] for i, s, e in parts)
        n = len(flat)
        w = words_at(np.frombuffer(flat + bytes(32), np.uint8)).astype(np.uint64)
        h = w[:n] * np.uint64(0x9E3779B97F4A7C15)
        for place, shift, factor in ((8, 29, 0xBF58476D1CE4E5B9), (16, 32, 0x94D049BB133111EB)):
            h ^= h >> np.uint64(shift)
            h ^= w[place : n + place]
            h *= np.uint64(factor)
        h ^= h >> np.uint64(31)
        low = np.uint64((1 << 24) - 1)
        marked = h & ~low
        marked |= np.arange(n, dtype=np.uint64)
        least = _sliding_least(marked, LENGTH - RUN + 1)
        text, begin, end = np.array(parts).T
        first = np.cumsum(end - begin) - (end - begin)
        after = first + end - begin - LENGTH + 1  # where no string of the part begins any more
        new = np.append(True, least[1:] != least[:-1])
        new[first] = True
        new[after] = True
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, len(new)))
        part = np.repeat(np.arange(len(parts)), np.diff(np.append(np.searchsorted(start, first), len(start))))
        inside = start < after[part]
        start, count, part = start[inside], count[inside], part[inside]
        anchor = (least[start] & low).astype(np.int64)
        # Four runs of RUN bytes cover the strings, which are at most 2 * LENGTH - RUN bytes long.
        stop, body = start + count + LENGTH - 1, (anchor - start).astype(np.uint64)
        for place in (start, start + RUN, stop - 2 * RUN, stop - RUN):
            body = (body ^ h[place]) * np.uint64(0x9E3779B97F4A7C15)
        found.append(Runs(text[part], start + (begin - first)[part], count, anchor - start, h[anchor], body))
    if not found:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Runs(*(np.concatenate([getattr(r, f.name) for r in found]) for f in fields(Runs)))


def _shard(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _full(key: np.ndarray, shards: int) -> np.ndarray:
    """Shard and lower half of each hash."""
    return (_shard(key, shards).astype(np.uint64) << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF))


def _asked(key: np.ndarray, shards: int) -> np.ndarray:
    """The distinct hashes, in order; what a block sends and what the answer's bits stand for."""
    return _numbered(_full(key, shards))[0]


def surroundings(runs: Runs, asked: np.ndarray, shards: int, place: np.ndarray | None = None) -> np.ndarray:
    """How many distinct texts hold each asked anchor, as 16 bits; larger numbers are hot by themselves.

    ``place``: the number of each run's hash among the asked, if it is known.
    """
    place = np.searchsorted(asked, _full(runs.key, shards)) if place is None else place
    size = np.bincount(place, minlength=len(asked))
    several = np.flatnonzero(size[place] > 1)
    place, body = place[several], runs.body[several]
    order = np.lexsort((body, place))
    place, body = place[order], body[order]
    new = np.append(True, (place[1:] != place[:-1]) | (body[1:] != body[:-1]))[: len(place)]
    texts = np.where(size > 1, np.bincount(place[new], minlength=len(asked)), size)
    return np.minimum(texts, 0xFFFF).astype("<u2")


def _by_shard(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    edges = np.flatnonzero(np.diff(values, prepend=-1, append=-1))
    for s, e in zip(edges, edges[1:]):
        yield int(values[s]), int(s), int(e)


def repeated_within(place: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Which of the ``n`` asked hashes stand in documents with different ids of this block."""
    several = np.flatnonzero(np.bincount(place, minlength=n)[place] > 1)
    place, owner = place[several], owner[several]
    least, most = np.full(n, NO_ID), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(least, place, owner)
    np.maximum.at(most, place, owner)
    return least < most


@dataclass
class Bodies:
    """Texts of 50 to 76 bytes, zeros behind: words, how many strings each has, anchor's offset, smallest id of its documents."""

    words: np.ndarray  # WORDS to a text
    count: np.ndarray
    anchor: np.ndarray
    least: np.ndarray

    def pick(self, which: np.ndarray) -> Bodies:
        return Bodies(*(getattr(self, f.name)[which] for f in fields(self)))

    def merged(self) -> tuple[Bodies, np.ndarray, np.ndarray]:
        """Equal texts as one, in order of their first; the number of each text, and the hash of each that stays."""
        key = _mixed([self.anchor * 128 + self.count, *self.words.T])
        _, number, first = _numbered(key)
        # Unequal texts of one hash stay apart.
        leader = first[number]
        equal = (self.words == self.words[leader]).all(axis=1) & (self.count == self.count[leader]) & (self.anchor == self.anchor[leader])
        leader = np.where(equal, leader, np.arange(len(leader)))
        stays = leader == np.arange(len(leader))
        number = (np.cumsum(stays) - 1)[leader]
        out = self.pick(stays)
        np.minimum.at(out.least, number, self.least)
        return out, number, key[stays]

    def data(self) -> bytes:
        """Compressed, without the zeros."""
        inside = np.arange(8 * WORDS) < (self.count + LENGTH - 1)[:, None]
        return _small(self.least, self.count.astype(np.uint8), self.anchor.astype(np.uint8), self.words.view(np.uint8)[inside])

    @staticmethod
    def of(data: bytes) -> Bodies:
        least, count, anchor, flat = _large(data, np.int64, np.uint8, np.uint8, np.uint8)
        count, anchor = count.astype(np.int64), anchor.astype(np.int64)
        words = np.zeros((len(count), WORDS), np.uint64)
        words.view(np.uint8)[np.arange(8 * WORDS) < (count + LENGTH - 1)[:, None]] = flat
        return Bodies(words, count, anchor, least.copy())


def _small(*arrays: np.ndarray) -> bytes:
    """The arrays, compressed."""
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    return sizes.tobytes() + pa.compress(b"".join([a.tobytes() for a in arrays]), codec="zstd", asbytes=True)


def _large(data: bytes, *kinds: type) -> list[np.ndarray]:
    """The arrays of ``_small``."""
    ends = np.cumsum(np.frombuffer(data, np.int64, len(kinds))).tolist()
    flat = np.frombuffer(pa.decompress(memoryview(data)[8 * len(kinds) :], ends[-1], codec="zstd"), np.uint8)
    return [flat[s:e].view(k) if e > s else np.zeros(0, k) for s, e, k in zip([0, *ends], ends, kinds)]


@dataclass
class Block:
    """A block's candidate strings: the distinct texts that hold them, in shard order, and where they stand."""

    runs: Runs
    number: np.ndarray  # of each run's distinct text
    bodies: Bodies
    shard: np.ndarray

    @property
    def distinct(self) -> list[bytes]:
        """The texts as bytes."""
        return [w.tobytes()[: c + LENGTH - 1] for w, c in zip(self.bodies.words, self.bodies.count.tolist())]

    def places(self) -> bytes:
        """What ``finish`` needs to know of the runs."""
        r = self.runs
        order = np.lexsort((r.start, r.text))
        parts = (np.diff(r.text[order], prepend=0), np.diff(r.start[order], prepend=0), r.count[order], self.number[order])
        return _small(*(p.astype(k) for p, k in zip(parts, PLACES)), np.unique(self.shard))


def candidates(payload: bytes, repeated: dict[int, bytes], shards: int) -> Block:
    """The strings of a block whose anchors stand in more than one document."""
    docs = unpacked(payload)
    texts, ids = docs.column("text").to_pylist(), docs.column("id").to_numpy()
    runs = anchored(texts)
    asked, place, _ = _numbered(_full(runs.key, shards))
    known, hot = repeated_within(place, ids[runs.text], len(asked)), np.zeros(len(asked), bool)
    for shard, s, e in _by_shard((asked >> np.uint64(32)).astype(np.int64)):
        told = np.frombuffer(repeated[shard], np.uint8)
        here, size = told[: -(-(e - s) // 8)], e - s
        known[s:e] |= np.unpackbits(here, count=size).astype(bool)
        if len(told) > len(here):
            hot[s:e] = np.unpackbits(told[len(here) :], count=size).astype(bool)
    known, hot = known[place], hot[place]
    plain, alone = runs.pick(known & ~hot), runs.pick(known & hot).singly()
    runs = Runs(*(np.concatenate([getattr(plain, f.name), getattr(alone, f.name)]) for f in fields(Runs)))
    word = words_at(np.frombuffer(b"".join([*texts, bytes(8 * WORDS)]), np.uint8), "<")
    size = np.array([len(t) for t in texts], np.int64)
    at = (np.cumsum(size) - size)[runs.text] + runs.start
    words = np.column_stack([word[at + 8 * k] & KEEP[k][runs.count] for k in range(WORDS)])
    bodies, number, _ = Bodies(words, runs.count, runs.anchor, ids[runs.text]).merged()
    # The hash of a lone string is that of its bytes, since equal strings have equal anchors.
    first = np.full(len(bodies.count), len(number))
    np.minimum.at(first, number, np.arange(len(number)))
    own = _mixed(bodies.words.T)
    of = _shard(np.where(first < len(plain.key), runs.key[first], own ^ (own >> np.uint64(31))), shards)
    order = np.argsort(of, kind="stable")
    new_number = np.empty(len(order), np.int64)
    new_number[order] = np.arange(len(order))
    return Block(runs, new_number[number], bodies.pick(order), of[order])


def smallest(bodies: Bodies) -> np.ndarray:
    """For each string in the texts, in order: the smallest id of the texts that hold it."""
    word = words_at(bodies.words.view(np.uint8).ravel(), "<")
    at = np.arange(len(bodies.count)) * 8 * WORDS + bodies.anchor
    _, number, _ = _numbered(_mixed([word[at + k] for k in (0, 8, 16)]))
    # A text that shares its anchor with no other shares no string with it.
    several = np.flatnonzero(np.bincount(number)[number] > 1)
    out = np.repeat(bodies.least, bodies.count)
    if len(several):
        first = np.cumsum(bodies.count) - bodies.count
        out[_spread(first[several], bodies.count[several])] = _sorted(bodies.pick(several))
    return out


def _sorted(bodies: Bodies) -> np.ndarray:
    """``smallest`` by sorting the suffixes."""
    n, ids = len(bodies.count), bodies.least
    size = bodies.count + LENGTH - 1
    pad = -bodies.anchor % PERIOD
    begin = np.arange(n) * PLACE + pad
    data = np.zeros(n * PLACE + 64, np.uint8)
    for k in range(WORDS):
        words_at(data, "<")[begin + 8 * k] = bodies.words[:, k]
    word = words_at(data)
    # Ranks of the cover positions by the bytes that follow.
    cover = (np.arange(0, PLACE, PERIOD)[:, None] + np.array(COVER)).ravel()
    sample = (np.arange(n)[:, None] * PLACE + cover).ravel()
    home = np.repeat(np.arange(n), len(cover))
    sample = sample[(sample >= begin[home]) & (sample + SAMPLE <= (begin + size)[home])]
    keys = [word[sample + k].astype(np.uint64) for k in (0, 8, 16, 24, 32, SAMPLE - 8)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(sample), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    rank = np.zeros(n * PLACE + 64, np.int32)
    rank[sample[order]] = np.cumsum(new)
    next_cover = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])
    owner = np.repeat(np.arange(n), bodies.count)
    at = _spread(begin, bodies.count)
    out = np.empty(len(at), np.int64)
    bucket = data[at]
    by_bucket = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[by_bucket], np.arange(257))
    for s, e in zip(edges, edges[1:]):
        if s == e:
            continue
        here = by_bucket[s:e]
        i = at[here]
        residue = i % PERIOD
        named = rank[i + next_cover[residue]].astype(np.int64) * PERIOD + residue
        keys = [word[i].astype(np.uint64), named, word[i + LENGTH - 8].astype(np.uint64)]
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        new[0] = True
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        group = np.cumsum(new) - 1
        least = np.minimum.reduceat(ids[owner[here]][order], np.flatnonzero(new))
        out[here[order]] = least[group]
    return out


def cut(text: bytes, starts: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The text without the bytes of the strings that begin at ``starts``, and the removed spans (start, end)."""
    if not len(starts):
        return text, np.zeros((0, 2), np.int64)
    starts = np.sort(starts)
    new = np.flatnonzero(np.append(True, starts[1:] > starts[:-1] + LENGTH))
    spans = np.column_stack([starts[new], starts[np.append(new[1:] - 1, len(starts) - 1)] + LENGTH])
    kept, done = [], 0
    for s, e in spans.tolist():
        kept.append(text[done:s])
        done = e
    return b"".join([*kept, text[done:]]), spans


def removed(docs: DataFrame, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, spans (start and end in bytes), kept (the remaining bytes), one row per row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = text_or_empty().cast("binary")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID)))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(16, -(-total // shard_bytes))
    packs = staged(blocks(docs.select("doc_id", order.alias("id"), text.alias("text")), block_bytes))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, payload in zip(b.column("block").to_pylist(), b.column("payload").to_pylist()):
                runs = anchored(unpacked(payload).column("text").to_pylist())
                asked, place, _ = _numbered(_full(runs.key, shards))
                around = surroundings(runs, asked, shards, place)
                parts = list(_by_shard((asked >> np.uint64(32)).astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(parts), pa.int64()), pa.array([p[0] for p in parts], pa.int64()),
                     pa.array([asked[s:e].astype("<u4").tobytes() + around[s:e].tobytes() for _, s, e in parts], pa.binary())],
                    ["block", "shard", "data"],
                )

    def meet(table: pa.Table) -> pa.Table:
        data = table.column("data").to_pylist()
        hashes = [np.frombuffer(d, "<u4", len(d) // 6) for d in data]
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        around = np.concatenate([np.frombuffer(d, "<u2", offset=len(d) // 6 * 4) for d in data]).astype(np.int64)[order]
        twice = every[first][np.diff(np.append(first, len(every))) > 1]
        crowded = every[first][np.add.reduceat(around, first) > hot]
        marks = [twice, crowded] if len(crowded) else [twice]
        bits = [b"".join(np.packbits(np.isin(h, m, assume_unique=True)).tobytes() for m in marks) for h in hashes]
        return table.select(["block", "shard"]).append_column("data", pa.array(bits, pa.binary()))

    schema = "block long, shard long, data binary"
    shared = staged(packs.mapInArrow(ask, schema).groupBy("shard").applyInArrow(meet, schema))

    def as_map(table: pa.Table) -> dict[int, bytes]:
        return dict(zip(table.column("shard").to_pylist(), table.column("data").to_pylist()))

    def send(block: pa.Table, answer: pa.Table) -> pa.Table:
        rows: dict[str, list] = {"block": [], "shard": [], "data": []}
        for number, payload in zip(block.column("block").to_pylist(), block.column("payload").to_pylist()):
            c = candidates(payload, as_map(answer), shards)
            parts = [(shard, c.bodies.pick(slice(s, e)).data()) for shard, s, e in _by_shard(c.shard)]
            # Where the runs stand goes past the shards, as a group of its own.
            for shard, data in [*parts, (-1 - number, c.places())]:
                for name, value in (("block", number), ("shard", shard), ("data", data)):
                    rows[name].append(value)
        return pa.table({"block": pa.array(rows["block"], pa.int64()), "shard": pa.array(rows["shard"], pa.int64()), "data": pa.array(rows["data"], pa.binary())})

    def sort(table: pa.Table) -> pa.Table:
        if table.column("shard")[0].as_py() < 0:
            return table.select(["block", "shard", "data"])
        parts = [Bodies.of(d) for d in table.column("data").to_pylist()]
        # Texts that several blocks sent are sorted once, under their smallest id.
        every, which, _ = Bodies(*(np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(Bodies))).merged()
        least = smallest(every)
        first = np.cumsum(every.count) - every.count
        answers, done = [], 0
        for p in parts:
            mine = which[done : done + len(p.count)]
            told = least[_spread(first[mine], p.count)]
            # Neighbouring strings whose smallest document is the same are told as one.
            new = np.flatnonzero(np.append(True, told[1:] != told[:-1]))
            answers.append(_small(told[new], np.diff(np.append(new, len(told))).astype(np.uint32)))
            done += len(p.count)
        return table.select(["block", "shard"]).append_column("data", pa.array(answers, pa.binary()))

    sent = packs.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(send, schema)
    answers = staged(sent.groupBy("shard").applyInArrow(sort, schema))

    def finish(block: pa.Table, answer: pa.Table) -> pa.Table:
        told = as_map(answer)
        out = []
        for number, payload in zip(block.column("block").to_pylist(), block.column("payload").to_pylist()):
            docs = unpacked(payload)
            texts, ids = docs.column("text").to_pylist(), docs.column("id").to_numpy()
            *places, homes = _large(told[-1 - number], *PLACES, np.int64)
            text, begin, count, body = (p.astype(np.int64) for p in places)
            text, begin = np.cumsum(text), np.cumsum(begin)
            size = np.zeros(body.max(initial=-1) + 1, np.int64)
            size[body] = count
            parts = [_large(told[shard], np.int64, np.uint32) for shard in homes.tolist()]
            per_string = np.concatenate([np.zeros(0, np.int64), *(np.repeat(i, n) for i, n in parts)])
            goes = per_string[_spread((np.cumsum(size) - size)[body], count)] < np.repeat(ids[text], count)
            start, owner = _spread(begin, count)[goes], np.repeat(text, count)[goes]
            edges = np.searchsorted(owner, np.arange(len(texts) + 1))
            cuts = [cut(t, start[s:e]) for t, s, e in zip(texts, edges, edges[1:])]
            spans = np.concatenate([np.zeros((0, 2), np.int64), *(c for _, c in cuts)])
            offsets = np.cumsum([0, *(len(c) for _, c in cuts)]).astype(np.int32)
            out.append(
                pa.table(
                    {"doc_id": docs.column("doc_id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                     "spans": pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([spans[:, 0], spans[:, 1]], ["start", "end"])),
                     "kept": pa.array([k for k, _ in cuts], pa.binary())}
                )
            )
        return pa.concat_tables(out)

    return packs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        finish, f"doc_id {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    )


def digested(cuts: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return cuts.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
