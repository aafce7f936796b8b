"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into segments of ``SEGMENT`` bytes. A chunk is ``SPAN`` adjacent segments, chunks start at
every segment and so overlap and cover the whole text. Filters are learned over fixed byte features; their responses are
max-pooled and averaged over all chunks and a small dense layer combines them into one probability. Long texts are worked
off in slices that pool into the same result.

The network is fitted on the driver, on at most ``per_class`` labelled texts of each label and ``TRAIN_BYTES`` bytes
each, chosen by a hash of their ids; every text is scored whole. Labels, language, source and id are never inputs.

Null texts count as empty and get a score like any other. Labels that are null, or of documents that do not exist, are
not used; of several labels of an id the lowest counts. With labels of one kind only, or none, every score is their
share (one half without any). Repeated rows are scored one by one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from premia.llm.common import bucket, fresh, ship, text_or_empty

ship(__name__)

SEGMENT = 8
SPAN = 4
FILTERS = 32
HIDDEN = 16
SLICE = 1 << 18
TRAIN_BYTES = 16_384
HELD_OUT = 5
THRESHOLD = 0.3


def byte_features() -> np.ndarray:
    """A row per byte: its kind, and a few fixed random numbers to tell bytes of one kind apart. Row 0 is padding."""
    code = np.arange(256)
    kinds = [
        (code >= 65) & (code <= 90), (code >= 97) & (code <= 122), (code >= 48) & (code <= 57),
        (code == 32), (code == 10), (code >= 128),
        ((code > 32) & (code < 48)) | ((code > 57) & (code < 65)) | ((code > 90) & (code < 97)) | ((code > 122) & (code < 127)),
    ]
    noise = np.random.default_rng(0).normal(0, 0.7, (256, 5))
    out = np.column_stack([*kinds, noise]).astype(np.float32)
    out[0] = 0
    return out


FEATURES = 12


@dataclass
class Net:
    """Weights: filters (SEGMENT * FEATURES, SPAN * FILTERS), and the dense layers over the pooled responses."""

    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    table: np.ndarray

    @staticmethod
    def start(seed: int = 1) -> Net:
        rng = np.random.default_rng(seed)
        width = SEGMENT * FEATURES
        scale = (2 / (width * SPAN)) ** 0.5
        return Net(
            rng.normal(0, scale, (width, SPAN * FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
            rng.normal(0, (1 / FILTERS) ** 0.5, (2 * FILTERS, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
            rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN).astype(np.float32), 0.0, byte_features(),
        )

    def segments(self, parts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segment features of several byte arrays, and the first and last chunk of each."""
        counts = np.array([max(1, -(-len(p) // SEGMENT)) for p in parts])
        first = np.cumsum(np.append(0, counts + SPAN - 1))[:-1]
        flat = np.zeros((first[-1] + counts[-1] + SPAN - 1) * SEGMENT, np.uint8)
        for p, f in zip(parts, first):
            flat[f * SEGMENT : f * SEGMENT + len(p)] = p
        return self.table[flat].reshape(-1, SEGMENT * FEATURES), first, counts

    def respond(self, x: np.ndarray) -> np.ndarray:
        """Filter responses of the chunk that starts at each segment; the last SPAN - 1 have no chunk."""
        y = x @ self.filters
        n = len(x) - SPAN + 1
        total = self.bias + y[:n, :FILTERS]
        for j in range(1, SPAN):
            total += y[j : j + n, j * FILTERS : (j + 1) * FILTERS]
        return np.maximum(total, 0, out=total)

    def head(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled @ self.dense + self.dense_bias, 0) @ self.out + self.out_bias

    def pooled(self, texts: Sequence[bytes]) -> np.ndarray:
        """Largest and mean response of each filter over all chunks of each text."""
        top, total, count = (np.zeros((len(texts), n), np.float64) for n in (FILTERS, FILTERS, 1))
        waiting: list[np.ndarray] = []
        owners: list[int] = []
        sizes: list[int] = []

        def flush() -> None:
            if not owners:
                return
            x, first, _ = self.segments(waiting)
            r = self.respond(x)
            ends = np.minimum(first + sizes, len(r))
            for f, e, i in zip(first, ends, owners):
                np.maximum(top[i], r[f:e].max(axis=0), out=top[i])
                total[i] += r[f:e].sum(axis=0)
                count[i] += e - f
            waiting.clear(), owners.clear(), sizes.clear()

        held = 0
        for i, text in enumerate(texts):
            data = np.frombuffer(text, np.uint8)
            for s in range(0, max(1, len(data)), SLICE):
                # A slice sees the bytes after it that its last chunks reach into.
                part = data[s : s + SLICE + (SPAN - 1) * SEGMENT]
                waiting.append(part)
                owners.append(i)
                sizes.append(max(1, -(-len(data[s : s + SLICE]) // SEGMENT)))
                held += len(part)
                if held >= SLICE:
                    flush()
                    held = 0
        flush()
        return np.hstack([top, total / count])

    def probability(self, texts: Sequence[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.head(self.pooled(texts)), -30, 30)))


def fit(texts: Sequence[bytes], labels: np.ndarray, odds: float, epochs: int = 6, rate: float = 0.003, seed: int = 1) -> Net:
    """Adam on balanced batches; then the output is moved to the odds of label 1 among all labels."""
    net, rng = Net.start(seed), np.random.default_rng(seed)
    names = ["filters", "bias", "dense", "dense_bias", "out", "out_bias"]
    moments = {n: [np.zeros_like(getattr(net, n), dtype=np.float64) for _ in range(2)] for n in names}
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    step, size = 0, 32
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for s in range(0, len(order), size):
            pick = order[s : s + size]
            x, first, counts = net.segments([np.frombuffer(texts[i], np.uint8) for i in pick])
            r = net.respond(x)
            best = np.stack([f + r[f : f + c].argmax(axis=0) for f, c in zip(first, counts)])
            top = np.take_along_axis(r, best, axis=0)
            mean = np.stack([r[f : f + c].mean(axis=0) for f, c in zip(first, counts)])
            pooled = np.hstack([top, mean])
            hidden = np.maximum(pooled @ net.dense + net.dense_bias, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias, -30, 30)))
            error = ((p - labels[pick]) * weight[pick] / len(pick)).astype(np.float32)
            d_hidden = np.outer(error, net.out) * (hidden > 0)
            d_pooled = d_hidden @ net.dense.T
            d_r = np.zeros_like(r)
            np.add.at(d_r, (best, np.arange(FILTERS)[None, :]), d_pooled[:, :FILTERS])
            for k, (f, c) in enumerate(zip(first, counts)):
                d_r[f : f + c] += d_pooled[k, FILTERS:] / c
            d_r *= r > 0
            wide = np.zeros((len(x), SPAN * FILTERS), np.float32)
            for j in range(SPAN):
                wide[j : j + len(d_r), j * FILTERS : (j + 1) * FILTERS] = d_r
            grads = {
                "filters": x.T @ wide, "bias": d_r.sum(axis=0), "dense": pooled.T @ d_hidden, "dense_bias": d_hidden.sum(axis=0),
                "out": hidden.T @ error, "out_bias": error.sum(),
            }
            step += 1
            speed = rate * (1 - 0.9 * epoch / epochs)
            for n in names:
                g, (m, v) = grads[n], moments[n]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                move = speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                new = getattr(net, n) - move
                setattr(net, n, float(new) if n == "out_bias" else new.astype(np.float32))
    net.out_bias += float(np.log(odds))
    return net


def sample(docs: DataFrame, labels: DataFrame, per_class: int, label: str = "quality") -> tuple[list[bytes], np.ndarray, float]:
    """At most ``per_class`` texts of each label, their labels, and the odds of label 1 among the usable labels."""
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (bucket(F.col("doc_id"), HELD_OUT) != 0))
    usable = usable.groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}
    odds = counts.get(1, 0) / counts.get(0, 1) if counts.get(0) else 1.0
    texts = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    rows = []
    for y in (0, 1):
        chosen = usable.where(F.col("y") == y).orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(per_class)
        met = texts.join(F.broadcast(chosen), "doc_id").where(F.octet_length("text") <= TRAIN_BYTES)
        rows += [(r["doc_id"], bytes(r["text"]), y) for r in met.dropDuplicates(["doc_id"]).limit(per_class).collect()]
    rows.sort()
    return [r[1] for r in rows], np.array([r[2] for r in rows]), odds


def train(docs: DataFrame, labels: DataFrame, per_class: int = 900) -> Net:
    texts, y, odds = sample(docs, labels, per_class)
    if len(set(y.tolist())) < 2:
        net = Net.start()
        share = float(y.mean()) if len(y) else 0.5
        net.out[:], net.out_bias = 0, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return net
    return fit(texts, y, odds)


def scored(docs: DataFrame, net: Net, columns: Sequence[str] = ("doc_id",), name: str = "score") -> DataFrame:
    """The given columns of every row and the score of its whole text."""
    (text,) = fresh(docs.select(*columns), "text_bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = net.probability(b.column(text).to_pylist())
            keep = [b.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(p, pa.float64())], [*columns, name])

    rows = docs.select(*columns, text_or_empty().cast("binary").alias(text))
    return rows.mapInArrow(run, rows.drop(text).schema.add(name, "double"))


def classified(docs: DataFrame, labels: DataFrame, per_class: int = 900) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    out = scored(docs, train(docs, labels, per_class))
    return out.select(
        "doc_id", (bucket(F.col("doc_id"), HELD_OUT) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, per_class: int = 900) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with the same columns."""
    (name,) = fresh(docs, "score")
    return scored(docs, train(docs, labels, per_class), docs.columns, name).where(F.col(name) >= THRESHOLD).select(*docs.columns)
