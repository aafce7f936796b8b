"""Mixture-controlled packing of documents into training sequences.

Sources are queues of tokens, served by deficit round robin: a window of ``sequences`` sequences gives each source that
still has tokens its share, and the fraction of a token that it could not give is carried to the next window. The state
of the queues at any window boundary has a closed form: token ``j`` of a source of rate ``r`` is due at ``(j - 1/2)/r``,
tokens are served in the order they are due, and a source that runs dry leaves its share to the others. So each task
finds the cuts of its documents from the sources' totals alone, and no window waits for another.

Queues are put together from chunks, which tasks number while they tokenize; a running sum over chunk totals says where
a chunk's part of a queue starts. Without given shares, sources are served in proportion to their tokens, and every
window has the mixture of the corpus. Documents in training order (``in_order``) keep it: queues follow the order of the
files and rows as they were written, files are cut into stretches, and at any time a source is served in proportion to its
tokens in the stretch that training has come to. The state then follows from the sources' totals by stretch. Documents are cut at window and sequence ends; only the last sequence is short.

Null texts are empty and hold the end token only; null sources are a source of their own. Repeated rows are documents
of their own. An empty table gives no pieces. Other columns are not read. The driver holds one total per source, and in
training order a row per file and at most ``MOST_CELLS`` totals by stretch and source.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, Window, functions as F

from premia.llm.common import ship, staged, text_or_empty

ship(__name__)

SEQUENCE = 4096
WINDOW_SEQUENCES = 16
END_ID = 2
CACHED_WORDS = 600_000
#: Rows of a stretch of the training order, at least, and the most totals by stretch and source.
STRETCH_ROWS = 32
MOST_CELLS = 1 << 20


#: What the pre-tokenizer makes of a lower-case word whose characters all lie below U+0180.
_LETTERS = "a-zªµºß-öø-ſ"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9²³¹¼½¾]|[^{_LETTERS}0-9²³¹¼½¾]+")
#: Characters outside that range, white space within it, a letter that changes its length, and marks of special tokens.
UNUSUAL = re.compile("[^\x00-\u017f]|[\x85\xa0\u0130]|<\\|")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordIds(dict):
    """Ids, as little-endian bytes, of white-space separated words. The vocabulary's words never cross white space.

    Words seen for the first time are split into the pre-tokenizer's pieces, which are remembered as well, so that
    case and punctuation cost little; unusual words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() < 1 << 16 else "<u4")
        self.pieces: dict[str, bytes] = {}
        self.letters = dict(enumerate(byte_letters()))

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def of_piece(self, piece: str) -> bytes:
        spelt = piece.encode().decode("latin-1").translate(self.letters)
        out = self.pieces[piece] = self.packed([t.id for t in self.model.tokenize(spelt)])
        return out

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
            self.pieces.clear()
        text = word.decode()
        if UNUSUAL.search(text):
            out = self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        else:
            known = self.pieces
            out = b"".join([known.get(p) or self.of_piece(p) for p in PIECES.findall(text.lower())])
        self[word] = out
        return out

    def of(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


@dataclass(frozen=True)
class Order:
    """Files in the order they were written: number of each, and the stretches of its rows."""

    number: dict[str, int]
    first: list[int]  # stretch of each file's first row
    rows: int  # of a stretch
    stretches: int


def placed(docs: DataFrame) -> DataFrame:
    """The documents' ids, sources and texts with the file and row they stand in, written first if they are not a table of files."""
    wanted = ["doc_id", "source", "text"]
    place = F.col("_metadata.file_path").alias("its_file"), F.col("_metadata.row_index").alias("its_row")
    try:
        return docs.select(*wanted, *place)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
        return staged(docs.select(*wanted)).select(*wanted, *place)


def order_of(rows: DataFrame) -> Order:
    """Tasks number the files they write, and the parts of a file after ``.c``; files named otherwise go first, by name."""
    found = rows.groupBy("its_file").agg((F.max("its_row") + 1).alias("n")).collect()

    def written(r: Row) -> tuple:
        name = r["its_file"].rsplit("/", 1)[-1]
        m = re.match(r"part-(\d+)(?:.*?\.?-?c(\d+)\.)?", name)
        return (int(m[1]), int(m[2] or 0), r["its_file"]) if m else (-1, 0, r["its_file"])

    found.sort(key=written)
    sources = rows.select(F.approx_count_distinct("source")).first()[0] + 1
    total = sum(r["n"] for r in found)
    size = max(STRETCH_ROWS, -(-total * sources // MOST_CELLS))
    first = [0]
    for r in found:
        first.append(first[-1] + -(-r["n"] // size))
    return Order({r["its_file"]: i for i, r in enumerate(found)}, first[:-1], size, first[-1])


def tokenized(docs: DataFrame, vocabulary_path: str, end_id: int = END_ID, order: Order | None = None) -> DataFrame:
    """chunk, stretch, source, doc_id, before (tokens of the source earlier in the chunk), tokens, width, ids.

    Chunks are numbered by task, or with an order by file and row; without an order all is one stretch.
    """

    def neighbours(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
        """Chunk, stretches and rows that follow each other in one file."""
        file = np.array([order.number[f] for f in b.column("its_file").to_pylist()], np.int64)
        row = b.column("its_row").to_numpy()
        edges = np.flatnonzero((np.diff(file, prepend=-1, append=-1) != 0) | (np.diff(row, prepend=-1, append=-1) != 1))
        for s, e in zip(edges, np.append(edges[1:], len(row))):
            if s < e:
                yield int((file[s] << 40) | row[s]), order.first[file[s]] + row[s:e] // order.rows, b.slice(s, e - s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(vocabulary_path)
        end = np.array([end_id], words.kind).tobytes()
        width = words.kind.itemsize
        chunk = TaskContext.get().partitionId() << 32

        def chunks() -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
            for i, b in enumerate(batches):
                if order is None:
                    yield chunk + i, np.zeros(b.num_rows, np.int64), b
                elif b.num_rows:
                    yield from neighbours(b)

        for here, stretch, b in chunks():
            served: dict[str | None, int] = {}
            before, tokens, ids = [], [], []
            for source, text in zip(b.column("source").to_pylist(), b.column("text").to_pylist()):
                ids.append(words.of(text) + end)
                tokens.append(len(ids[-1]) // width)
                before.append(served.get(source, 0))
                served[source] = before[-1] + tokens[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([here] * len(ids), pa.int64()), pa.array(stretch, pa.int64()), b.column("source"), b.column("doc_id"), pa.array(before, pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array([width] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                ["chunk", "stretch", "source", "doc_id", "before", "tokens", "width", "ids"],
            )

    place = [] if order is None else ["its_file", "its_row"]
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), text_or_empty().cast("binary").alias("text"), *place)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"chunk long, stretch long, source string, doc_id {kind}, before long, tokens long, width int, ids binary"
    )


def on_curve(v: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """Tokens of each source that are due when ``v`` stretches are done; ``curve`` has those at the stretches' ends."""
    i = np.clip(v.astype(np.int64), 0, len(curve) - 2)
    return np.floor(curve[i] + np.clip(v - i, 0, 1)[:, None] * (curve[i + 1] - curve[i]) + 0.5).astype(np.int64)


def served(windows: np.ndarray, totals: np.ndarray, rates: np.ndarray, window: int, curve: np.ndarray | None = None) -> np.ndarray:
    """Tokens of each source in the first ``w`` windows, a row for each ``w``; rows sum to ``w`` whole windows."""
    want = np.minimum(windows * window, totals.sum())

    def due(v: np.ndarray) -> np.ndarray:
        return np.minimum(totals, np.floor(v[:, None] * rates + 0.5).astype(np.int64)) if curve is None else on_curve(v, curve)

    low = np.zeros(len(windows))
    high = np.full(len(windows), float((totals / rates).max()) * (1 + 1e-9) + 1 if curve is None else float(len(curve)))
    for _ in range(90):
        mid = (low + high) / 2
        enough = due(mid).sum(axis=1) >= want
        high, low = np.where(enough, mid, high), np.where(enough, low, mid)
    before, after = due(low), due(high)
    # What is due at the same moment is served in the order of the sources.
    step = after - before
    ahead = np.cumsum(step, axis=1) - step
    return before + np.clip((want - before.sum(axis=1))[:, None] - ahead, 0, step)


def pieces(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    shares: Mapping[str | None, float] | None = None,
    sequence: int = SEQUENCE,
    sequences: int = WINDOW_SEQUENCES,
    end_id: int = END_ID,
    in_order: bool = False,
) -> DataFrame:
    """doc_id, source, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32), one row per piece.

    ``shares`` are target proportions by source; by default each source's part of all tokens. ``in_order`` says that the
    documents are in training order, whose changing proportions are kept instead.
    """
    if in_order and shares is not None:
        raise ValueError("documents in training order bring their own shares")
    docs = placed(docs) if in_order else docs
    order = order_of(docs) if in_order else None
    rows = staged(tokenized(docs, vocabulary_path or vocabulary(), end_id, order))
    by_chunk = rows.groupBy("source", "chunk").agg(F.sum("tokens").alias("words"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(
        by_chunk.select(
            F.col("source").alias("s"), F.col("chunk").alias("c"), "words", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("queue_start")
        )
    )
    found = starts.groupBy("s").agg(F.sum("words").alias("total")).orderBy(F.col("s").asc_nulls_last()).collect()
    totals = np.array([r["total"] for r in found], np.int64)
    window = sequence * sequences
    weight = totals.astype(float) if shares is None else np.array([float(shares[r["s"]]) for r in found])
    if len(weight) and weight.min() <= 0:
        raise ValueError("every source needs a share above 0")
    rates = weight / weight.sum() * window
    number = {r["s"]: i for i, r in enumerate(found)}
    curve = None
    if order is not None and len(found):
        curve = np.zeros((order.stretches + 1, len(found)), np.int64)
        for r in rows.groupBy("stretch", "source").agg(F.sum("tokens").alias("tokens")).collect():
            curve[r["stretch"] + 1, number[r["source"]]] = r["tokens"]
        curve = np.cumsum(curve, axis=0)
    # Tokens that come before the one at place x of its source, up to rounding.
    if curve is None:
        ahead = lambda x, s: np.minimum(totals, np.floor(((x + 0.5) / rates[s])[:, None] * rates + 0.5)).sum(axis=1)
    else:

        def ahead(x: np.ndarray, s: np.ndarray) -> np.ndarray:
            v = np.zeros(len(x))
            for k in np.unique(s):
                v[s == k] = np.interp(x[s == k] + 0.5, curve[:, k], np.arange(len(curve)))
            return on_curve(v, curve).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            source = np.array([number[s] for s in b.column("source").to_pylist()])
            first = b.column("queue_start").to_numpy() + b.column("before").to_numpy()
            tokens = b.column("tokens").to_numpy()
            # Windows that the document can touch: the order of service gives them up to rounding.
            at = lambda x: ahead(x, source) // window
            # The sources' roundings add up to at most half a token each.
            slack = 1 + len(totals) // window
            lowest = np.maximum(at(first).astype(np.int64) - slack, 0)
            highest = at(first + tokens - 1).astype(np.int64) + slack
            asked = np.unique(np.concatenate([np.arange(a, z + 2) for a, z in zip(lowest, highest)]))
            state = served(asked, totals, rates, window, curve)
            lies = np.cumsum(state, axis=1) - state  # tokens of the sources ahead
            out: dict[str, list] = {k: [] for k in ("row", "start", "length", "position")}
            for i in range(b.num_rows):
                s, f, n = source[i], first[i], tokens[i]
                lo, hi = np.searchsorted(asked, (lowest[i], highest[i] + 1))
                bound = state[lo : hi + 1, s]
                k = int(np.searchsorted(bound, f, side="right")) - 1
                done = 0
                while done < n:
                    x, w = f + done, lo + k
                    # Offset of the source's part in its window, then of the token in that part.
                    position = int(asked[w]) * window + (lies[w + 1, s] - lies[w, s]) + (x - state[w, s])
                    length = min(n - done, bound[k + 1] - x, sequence - position % sequence)
                    if length > 0:
                        for name, value in (("row", i), ("start", done), ("length", length), ("position", position)):
                            out[name].append(int(value))
                        done += length
                    if f + done >= bound[k + 1]:
                        k += 1
            row, start, length, position = (np.array(out[k], np.int64) for k in ("row", "start", "length", "position"))
            width, ids = b.column("width").to_pylist(), b.column("ids").to_pylist()
            cut = [
                np.frombuffer(ids[r], f"<u{width[r]}", n, s * width[r]).astype("<u4").tobytes()
                for r, s, n in zip(out["row"], out["start"], out["length"])
            ]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(take), b.column("source").take(take), pa.array(start), pa.array(length),
                 b.column("tokens").take(take), pa.array(position // sequence), pa.array(position % sequence), pa.array(cut, pa.binary())],
                ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    joined = rows.join(starts, rows["source"].eqNullSafe(starts["s"]) & (rows["chunk"] == starts["c"]))
    joined = joined.select("doc_id", "source", "queue_start", "before", "tokens", "width", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        run,
        f"doc_id {kind}, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )


def digested(packed: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def sequences_of(packed: DataFrame, sequence: int = SEQUENCE, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids, used: each sequence's ids in order, padded unless its length is a power of two."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("used"))
    pad = F.lit(bytearray(pad_id.to_bytes(4, "little")))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    missing = F.when(power, 0).otherwise(sequence - F.col("used")).cast("int")
    ids = F.concat(F.aggregate("parts", F.lit(bytearray()), lambda a, p: F.concat(a, p["ids"])), F.unhex(F.repeat(F.hex(pad), missing)))
    return parts.select("sequence_id", ids.alias("ids"), "used")
