"""Language-model scoring by logistic context mixing.

The model predicts the bytes of a normalised text (A-Z lower-cased, a space after each word, an end byte) bit by bit.
For each order the model knows how often either bit followed the last bytes and the bits of the current byte so far.
The orders' logits are mixed by a weight set that a gate picks from the bit's place and the highest order that has
seen the context; an adaptive map then refines the mixed probability. The bits' costs add up to the bytes' and tokens'.
Within a document the byte model is mixed online with the corpus frequency of the next whole word and its frequency in
the document so far: the mixing weights are averaged over ``WORD_SHARES`` and ``OWN_SHARES``, each pair as likely as it
has predicted the document so far.

What the model needs of the corpus are counts of byte runs of ``ORDER + 1``. Each block of documents sends its distinct
runs to shards, whose number grows with the corpus; runs with the same three bytes before the last share a shard. So a
shard has the exact counts of its contexts of orders 3 and more, without tables. Contexts of orders 0 to 2 are limited in
number by the alphabet; their counts are tables, summed in a tree of tasks and broadcast. Weights are learned online, in
small batches, by each task on its shards and then averaged; a run predicts itself from the counts without one
occurrence of its own. Last, each shard works out the cost of every distinct run once and tells it to the blocks.

The baseline is a unigram model with add-one smoothing. Texts are kept in blocks; a block sends its distinct words to
shards, too, and hears the corpus counts of its own words.

Null texts are empty and consist of the end alone. Null ids count as empty text in the split. Repeated rows are
documents of their own. Without training documents every bit has probability one half. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from premia.llm.common import bucket, ship, staged, text_or_empty
from premia.llm.text_blocks import blocks, packed, unpacked

ship(__name__)

ORDER = 5
ORDERS = (0, 1, 2, 3, 4, 5)
#: log2 of the slots of the tables of the first orders; those below ``HASHED`` have a slot for each case, and order 2
#: four million for the contexts of two bytes. Higher orders have no tables.
SLOT_BITS = (8, 16, 22)
LOW = len(SLOT_BITS)
HASHED = 2
PIECE_BITS = 16
#: Tables that one task adds up.
FAN_IN = 64
#: Runs whose counts are held at once.
CHUNK = 1 << 17
GATES = len(ORDERS) + 1
SETS = 8 * GATES
STEPS = 33
PRIOR = 0.4
BLOCK_BYTES = 4 << 20
#: Bytes of text for each shard of words and runs.
SHARD_BYTES = 8 << 20
BATCH = 2048
SPLIT, SPLIT_HELD_OUT = 7, 2
START = b"\n" * ORDER
WORD_SHARES = (0.05, 0.25, 0.5, 0.75, 0.95)
OWN_SHARES = (0.02, 0.2)


# --- words and byte runs --------------------------------------------------------------------------------------


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words; bytes methods know ASCII letters and white space only."""
    return text.lower().split()


def vocabulary(texts: list[bytes]) -> tuple[dict[bytes, int], list[np.ndarray]]:
    """Numbers of the distinct words in the order they appear, and each text as such numbers."""
    known: dict[bytes, int] = {}
    number = known.setdefault
    return known, [np.array([number(w, len(known)) for w in tokens(t)], np.int64) for t in texts]


def runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte runs of ORDER + 1 (as integers, last byte lowest) at each byte of the normalised texts, and their starts."""
    flat, lengths = [], []
    for t in texts:
        flat += [START, b" ".join([*tokens(t), b"\n"])]
        lengths.append(len(flat[-1]))
    data = b"".join([*flat, b"\0" * (8 - ORDER - 1)])
    # The eight bytes from each place on, without those beyond the run.
    key = np.ndarray((max(0, len(data) - 7),), ">u8", data, strides=(1,)).astype(np.uint64) >> np.uint64(8 * (8 - ORDER - 1))
    lengths = np.array(lengths)
    first = np.cumsum(lengths + ORDER) - lengths - ORDER  # of a text's first byte, counted in runs
    inside = np.ones(len(key), bool)
    for k in range(ORDER):  # runs that end within the start of the next text
        inside[(first[1:] - ORDER + k)] = False
    return key[inside], np.cumsum(lengths) - lengths


# --- the model -----------------------------------------------------------------------------------------------


@dataclass
class Model:
    tables: list[np.ndarray]  # of the first orders: uint16 (slots, 2), how often bit 0 and bit 1 came
    weights: np.ndarray  # (SETS, orders), float32
    refine: np.ndarray  # (SETS, STEPS), float32

    @staticmethod
    def start() -> Model:
        grid = np.linspace(-8, 8, STEPS)
        return Model(
            [np.zeros((1 << b, 2), np.uint16) for b in SLOT_BITS],
            np.full((SETS, len(ORDERS)), 0.3, np.float32),
            np.tile(1 / (1 + np.exp(-grid)), (SETS, 1)).astype(np.float32),
        )


def contexts(keys: np.ndarray) -> list[np.ndarray]:
    """The bytes before the last one, for the first orders: hashed, or in place for the bits of the last one below them."""
    out = []
    for order in ORDERS[:LOW]:
        before = (keys >> np.uint64(8)) & np.uint64((1 << 8 * order) - 1)
        if order < HASHED:
            out.append(before << np.uint64(8))
            continue
        h = before * np.uint64(0x9E3779B97F4A7C15)
        out.append((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    return out


def steps(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each of the last byte's bits: its place, the bits before it with a leading 1, the bit."""
    byte = keys & np.uint64(255)
    for place in range(8):
        node = np.uint64(1 << place) | (byte >> np.uint64(8 - place))
        yield place, node, ((byte >> np.uint64(7 - place)) & np.uint64(1)).astype(np.int64)


def slots(found: list[np.ndarray], node: np.ndarray) -> Iterator[np.ndarray]:
    """Slots of the contexts and the bits of the byte so far, for the first orders."""
    mixed = node * np.uint64(0x94D049BB133111EB)
    for order, size, context in zip(ORDERS, SLOT_BITS, found):
        yield (context | node if order < HASHED else (context ^ mixed) >> np.uint64(64 - size)).view(np.int64)


def grouped(keys: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the runs in parts of about ``CHUNK``; runs with the same three bytes before the last stay together."""
    context = (keys >> np.uint64(8)) & np.uint64(0xFFFFFF)
    order = np.argsort(context, kind="stable")
    context = context[order]
    edges = np.flatnonzero(np.append(context[1:] != context[:-1], True)) + 1
    done = 0
    while done < len(keys):
        end = edges[min(np.searchsorted(edges, done + CHUNK), len(edges) - 1)]
        yield order[done:end]
        done = end


def own_counts(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each bit's place and run, how often bit 0 and bit 1 came after the contexts of the higher orders.

    The runs are distinct and all that came with their contexts.
    """
    out = np.zeros((8, len(keys), 2, len(ORDERS) - LOW), np.float32)
    for i, order in enumerate(ORDERS[LOW:]):
        value = keys & np.uint64((1 << 8 * (order + 1)) - 1)
        at = np.argsort(value, kind="stable")
        value, n = value[at], counts[at].astype(np.float64)
        for place in range(8):
            node = value >> np.uint64(8 - place)
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))[: len(value)]
            one = n * ((value >> np.uint64(7 - place)) & np.uint64(1)).astype(np.float64)
            size = np.diff(np.append(first, len(value)))
            ones, both = (np.add.reduceat(x, first) if len(first) else x for x in (one, n))
            out[place, at, 0, i], out[place, at, 1, i] = np.repeat(both - ones, size), np.repeat(ones, size)
    return out


def counted(tables: list[np.ndarray], hashes: list[np.ndarray], own: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often bit 0 and bit 1 came, by run and order; ``own`` are the runs' counts at this place of the bit."""
    pairs = np.empty((len(node), 2, len(ORDERS)), np.float32)
    for i, at in enumerate(slots(hashes, node)):
        pairs[:, :, i] = tables[i][at]
    pairs[:, :, LOW:] = own
    return pairs[:, 0], pairs[:, 1]


def judged(zeros: np.ndarray, ones: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
    """Logits of all orders, and the weight set: of the bit's place and the highest order that knows the context."""
    x = np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)))
    gate = np.zeros(len(x), np.int64)
    for i in range(len(ORDERS)):
        gate[zeros[:, i] + ones[:, i] > 0] = i + 1
    return x, gate + place * GATES


def left_out(zeros: np.ndarray, ones: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counts without one occurrence of the run itself."""
    one = (bit == 1)[:, None]
    return np.maximum(zeros - ~one, 0), np.maximum(ones - one, 0)


def mix(weights: np.ndarray, x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return np.clip(np.einsum("ij,ij->i", x, weights[chosen]), -12, 12)


def on_grid(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower grid point and how far the logit lies above it."""
    at = (np.clip(logit, -8, 8) + 8) * ((STEPS - 1) / 16)
    low = np.minimum(at.astype(np.int64), STEPS - 2)
    return low, (at - low).astype(np.float32)


def bits(model: Model, keys: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
    """Cost in bits of each run's last byte after the bytes before it.

    ``counts`` tells how often each of the distinct runs came in training, and may be 0; see :func:`own_counts`. Without it
    only the tables know of the training.
    """
    counts = np.zeros(len(keys), np.int64) if counts is None else counts
    own, hashes, total = own_counts(keys, counts), contexts(keys), np.zeros(len(keys))
    flat = model.refine.ravel()
    for place, node, bit in steps(keys):
        x, chosen = judged(*counted(model.tables, hashes, own[place], node), place)
        logit = mix(model.weights, x, chosen)
        low, above = on_grid(logit)
        at = chosen * STEPS + low
        refined = flat[at] * (1 - above) + flat[at + 1] * above
        p = np.clip((1 / (1 + np.exp(-logit)) + refined) / 2, 1e-6, 1 - 1e-6).astype(np.float64)
        total -= np.log2(np.where(bit == 1, p, 1 - p))
    return total


def learn(tables: list[np.ndarray], weights: np.ndarray, squares: np.ndarray, keys: np.ndarray, counts: np.ndarray, rounds: int = 2, rate: float = 0.05) -> None:
    """Online steps of the weights over the runs, in small batches, each run as often as it came.

    ``squares`` holds the sums of squared gradients that scale the steps.
    """
    own = own_counts(keys, counts)
    rng = np.random.default_rng(len(keys))
    order = np.concatenate([rng.permutation(len(keys)) for _ in range(rounds)])
    for s in range(0, len(order), BATCH):
        pick = order[s : s + BATCH]
        k, n = keys[pick], counts[pick].astype(np.float64)
        hashes = contexts(k)
        for place, node, bit in steps(k):
            x, chosen = judged(*left_out(*counted(tables, hashes, own[place, pick], node), bit), place)
            wrong = n * (bit - 1 / (1 + np.exp(-mix(weights, x, chosen))))
            mass = np.bincount(chosen, n, SETS)
            met = mass > 0
            for i in range(len(ORDERS)):
                g = np.bincount(chosen, wrong * x[:, i], SETS)[met] / mass[met]
                squares[met, i] += g * g
                weights[met, i] += rate * g / np.sqrt(squares[met, i])


def add_counts(tables: list[np.ndarray], keys: np.ndarray, counts: np.ndarray) -> None:
    """Add what the runs say to dense tables of counts."""
    hashes = contexts(keys)
    for _, node, bit in steps(keys):
        for i, at in enumerate(slots(hashes, node)):
            np.add.at(tables[i].reshape(-1), at * 2 + bit, counts)


def train(runs_by_shard: DataFrame, shards: int | None = None) -> Model:
    """The model of byte runs and their counts; see :func:`merged_runs`. Shards are counted if their number is not given."""
    runs_by_shard = runs_by_shard.select("data")
    shards = runs_by_shard.count() if shards is None else shards
    model = Model.start()
    spark = runs_by_shard.sparkSession

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in batches:
            for data in b.column("data").to_pylist():
                t = unpacked(data)
                keys, counts = t.column("run").to_numpy().view(np.uint64), t.column("n").to_numpy().astype(np.float64)
                keys, counts = keys[counts > 0], counts[counts > 0]
                for part in grouped(keys):
                    yield keys[part], counts[part]

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = [np.zeros((1 << b, 2), np.float32) for b in SLOT_BITS]
        for keys, counts in unpack(batches):
            add_counts(dense, keys, counts.astype(np.float32))
        task = TaskContext.get().partitionId()
        for which, table in enumerate(dense):
            for s in range(0, len(table), 1 << PIECE_BITS):
                part = table[s : s + (1 << PIECE_BITS)].ravel()
                if part.any():
                    yield row(which, s >> PIECE_BITS, task, part)

    def row(which: int, piece: int, task: int, part: np.ndarray) -> pa.RecordBatch:
        cell = np.flatnonzero(part)
        data = packed(pa.table({"cell": cell.astype(np.uint32), "n": part[cell].astype(np.float64)}))
        places = [pa.array([n], pa.int32()) for n in (which, piece, task)]
        return pa.RecordBatch.from_arrays([*places, pa.array([data], pa.binary())], ["which", "piece", "task", "data"])

    def total_of(table: pa.Table) -> tuple[int, np.ndarray]:
        which = table.column("which")[0].as_py()
        total = np.zeros(min(1 << PIECE_BITS, 1 << SLOT_BITS[which]) * 2)
        for data in table.column("data").to_pylist():
            t = unpacked(data)
            total[t.column("cell").to_numpy()] += t.column("n").to_numpy()
        return which, total

    def added(table: pa.Table) -> pa.Table:
        which, total = total_of(table)
        return pa.Table.from_batches([row(which, table.column("piece")[0].as_py(), table.column("task")[0].as_py(), total)])

    def summed(table: pa.Table) -> pa.Table:
        which, total = total_of(table)
        total = total.reshape(-1, 2)
        # Counters are 16 bits wide; larger pairs keep their ratio.
        total *= np.minimum(1, 65_535 / np.maximum(total.max(axis=1, keepdims=True), 1))
        short = np.ceil(total).astype("<u2").tobytes()
        return pa.table({"which": pa.array([which], pa.int32()), "piece": table.column("piece")[:1], "counts": pa.array([short])})

    # One row per piece of the tables, whose size is fixed; a task adds up FAN_IN tasks' rows.
    schema = "which int, piece int, task int, data binary"
    parts, tasks = runs_by_shard.mapInArrow(tables, schema), shards
    while tasks > FAN_IN:
        parts = parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int")).groupBy("which", "piece", "task").applyInArrow(added, schema)
        tasks = -(-tasks // FAN_IN)
    for r in parts.groupBy("which", "piece").applyInArrow(summed, "which int, piece int, counts binary").toLocalIterator():
        at = r["piece"] << PIECE_BITS
        counts = np.frombuffer(r["counts"], "<u2").reshape(-1, 2)
        model.tables[r["which"]][at : at + len(counts)] = counts
    shared = spark.sparkContext.broadcast(model.tables)
    start = Model([], model.weights, model.refine)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, mass = start.weights.copy(), 0.0
        squares = np.full(weights.shape, 1e-6)
        for keys, counts in unpack(batches):
            learn(shared.value, weights, squares, keys, counts)
            mass += float(counts.sum())
        if mass:
            at = np.arange(weights.size)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weights.ravel().astype(float) * mass), pa.array(np.full(len(at), mass))], ["at", "w", "mass"])

    sums = runs_by_shard.mapInArrow(weigh, "at long, w double, mass double").groupBy("at").agg(F.sum("w").alias("w"), F.sum("mass").alias("mass"))
    for r in sums.collect():
        model.weights.ravel()[r["at"]] = r["w"] / r["mass"]
    weighed = model.weights

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = np.zeros((2, SETS * STEPS))
        for keys, counts in unpack(batches):
            hashes, own = contexts(keys), own_counts(keys, counts)
            for place, node, bit in steps(keys):
                x, chosen = judged(*left_out(*counted(shared.value, hashes, own[place], node), bit), place)
                low, above = on_grid(mix(weighed, x, chosen))
                for point, share in ((low, 1 - above), (low + 1, above)):
                    cell = chosen * STEPS + point
                    tally[0] += np.bincount(cell, counts * share, SETS * STEPS)
                    tally[1] += np.bincount(cell, counts * share * bit, SETS * STEPS)
        at = np.flatnonzero(tally[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(tally[0][at]), pa.array(tally[1][at])], ["at", "n", "ones"])

    cells = runs_by_shard.mapInArrow(measure, "at long, n double, ones double").groupBy("at").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    flat = model.refine.ravel()
    for r in cells.collect():
        flat[r["at"]] = (r["ones"] + 20 * flat[r["at"]]) / (r["n"] + 20)
    model.refine = flat.reshape(SETS, STEPS)
    shared.unpersist()
    return model


# --- counting and scoring ------------------------------------------------------------------------------------


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
    for s, e in zip(edges, edges[1:]):
        yield int(shard[s]), int(s), int(e)


def _run_order(unique: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct runs by shard and value: their places, their shards."""
    context = ((unique >> np.uint64(8)) & np.uint64(0xFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    shard = ((context >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((unique, shard))
    return order, shard[order]


def merged_runs(blocks_of_text: DataFrame, shards: int) -> DataFrame:
    """shard, data, blocks, asked: the distinct byte runs of all documents with their counts in the training documents,
    by shard, and which of them each block has.

    Runs with the same three bytes before the last share a shard.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, payload in zip(b.column("block").to_pylist(), b.column("payload").to_pylist()):
                docs = unpacked(payload)
                keys, first = runs(docs.column("text").to_pylist())
                learnt = ~np.array(docs.column("held_out").to_pylist(), bool)
                codes, unique = pd.factorize(keys)
                n = np.bincount(codes, np.repeat(learnt, np.diff(np.append(first, len(keys)))), len(unique))
                order, shard = _run_order(unique, shards)
                unique, n = unique[order].view(np.int64), n[order].astype(np.int32)
                parts = list(_by_shard(shard))
                data = [packed(pa.table({"run": np.diff(unique[s:e], prepend=0), "n": n[s:e]})) for _, s, e in parts]
                rows = [pa.array([p[0] for p in parts], pa.int64()), pa.array([block] * len(parts), pa.int64()), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(rows, ["shard", "block", "data"])

    def meet(table: pa.Table) -> pa.Table:
        asked = table.column("data").to_pylist()
        parts = [unpacked(d) for d in asked]
        run = np.concatenate([np.cumsum(p.column("run").to_numpy()) for p in parts])
        codes, unique = pd.factorize(run, sort=True)
        n = np.bincount(codes, np.concatenate([p.column("n").to_numpy() for p in parts]), len(unique)).astype(np.int64)
        # The blocks' counts have served; only their runs are kept.
        only = [packed(p.select(["run"])) for p in parts]
        return pa.table(
            {"shard": table.column("shard")[:1], "data": pa.array([packed(pa.table({"run": unique, "n": n}))], pa.binary()),
             "blocks": pa.array([table.column("block").to_pylist()], pa.list_(pa.int64())), "asked": pa.array([only], pa.list_(pa.binary()))}
        )

    asks = blocks_of_text.mapInArrow(ask, "shard long, block long, data binary")
    return asks.groupBy("shard").applyInArrow(meet, "shard long, data binary, blocks array<long>, asked array<binary>")


def run_costs(runs_by_shard: DataFrame, model: Broadcast[Model]) -> DataFrame:
    """block, shard, data: the cost of each run that a block has, in its order."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, data, numbers, asked in zip(*(b.column(c).to_pylist() for c in ("shard", "data", "blocks", "asked"))):
                known = unpacked(data)
                run, n = known.column("run").to_numpy(), known.column("n").to_numpy()
                cost = np.empty(len(run), np.float32)
                for part in grouped(run.view(np.uint64)):
                    cost[part] = bits(model.value, run[part].view(np.uint64), n[part])
                for s in range(0, len(numbers), 64):
                    told = [cost[np.searchsorted(run, np.cumsum(unpacked(d).column("run").to_numpy()))] for d in asked[s : s + 64]]
                    rows = [pa.array(numbers[s : s + 64], pa.int64()), pa.array([shard] * len(told), pa.int64()), pa.array([packed(pa.table({"cost": c})) for c in told], pa.binary())]
                    yield pa.RecordBatch.from_arrays(rows, ["block", "shard", "data"])

    return runs_by_shard.mapInArrow(tell, "block long, shard long, data binary")


def _word_order(known: dict[bytes, int], shards: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """A block's words by shard and then as they appeared, their numbers, their shards."""
    words = list(known)
    shard = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % shards
    order = np.argsort(shard, kind="stable")
    return [words[i] for i in order], order, shard[order]


def word_counts(blocks_of_text: DataFrame, shards: int) -> DataFrame:
    """block, shard, data, tokens, words: for each block its words' counts in all training documents, by shard.

    Rows without a block tell how many training tokens and distinct training words a shard has.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, payload in zip(b.column("block").to_pylist(), b.column("payload").to_pylist()):
                docs = unpacked(payload)
                known, numbers = vocabulary(docs.column("text").to_pylist())
                learnt = [x for x, h in zip(numbers, docs.column("held_out").to_pylist()) if not h]
                n = np.bincount(np.concatenate(learnt), minlength=len(known)) if learnt else np.zeros(len(known), np.int64)
                words, order, shard = _word_order(known, shards)
                n = n[order].astype(np.int32)
                parts = list(_by_shard(shard))
                data = [packed(pa.table({"word": pa.array(words[s:e], pa.binary()), "n": n[s:e]})) for _, s, e in parts]
                rows = [pa.array([block] * len(parts), pa.int64()), pa.array([p[0] for p in parts], pa.int64()), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(rows, ["block", "shard", "data"])

    def meet(table: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        number = known.setdefault
        parts = [unpacked(d) for d in table.column("data").to_pylist()]
        which = [np.array([number(w, len(known)) for w in p.column("word").to_pylist()], np.int64) for p in parts]
        c = np.bincount(np.concatenate(which), np.concatenate([p.column("n").to_numpy() for p in parts]), len(known)).astype(np.int64)
        answers = [packed(pa.table({"c": c[w]})) for w in which]
        shard = table.column("shard").to_pylist()
        return pa.table(
            {"block": pa.array([*table.column("block").to_pylist(), None], pa.int64()), "shard": pa.array([*shard, shard[0]], pa.int64()),
             "data": pa.array([*answers, None], pa.binary()), "tokens": pa.array([None] * len(parts) + [int(c.sum())], pa.int64()),
             "words": pa.array([None] * len(parts) + [int((c > 0).sum())], pa.int64())}
        )

    asked = blocks_of_text.mapInArrow(ask, "block long, shard long, data binary")
    return asked.groupBy("shard").applyInArrow(meet, "block long, shard long, data binary, tokens long, words long")


def _earlier(every: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Share of each token among the earlier ones of its text; texts of the given sizes follow each other."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(text * (every.max(initial=0) + 1) + every, kind="stable")
    new = np.flatnonzero(np.append(True, np.diff(every[order]).astype(bool) | np.diff(text[order]).astype(bool)))
    place = np.arange(len(every))
    came = np.empty(len(every))
    came[order] = place - np.repeat(new, np.diff(np.append(new, len(every))))
    return came / np.maximum(place - np.repeat(np.cumsum(sizes) - sizes, sizes), 1)


def mixed_words(of_word: np.ndarray, spelt: np.ndarray, again: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Logarithms of the probability of each text, one row per pair of shares; texts begin at ``starts``.

    Per token the logarithms of its probability as a word of the corpus, by its bytes and as a word of the text so far,
    of which at least that by bytes is finite.
    """
    # Shares of the likeliest of the three, so that a long word's probabilities stay in range.
    top = np.maximum(np.maximum(of_word, spelt), again)
    word, byte, own = (np.exp(x - top) for x in (of_word, spelt, again))
    base, sums = np.add.reduceat(top, starts), []
    for a in WORD_SHARES:
        either = a * word + (1 - a) * byte
        sums += [base + np.add.reduceat(np.log(b * own + (1 - b) * either), starts) for b in OWN_SHARES]
    return sums


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte of every document.

    ``score`` is the model's log10 probability of the normalised text, ``base_score`` the baseline's of its tokens.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    held_out = (bucket(F.col("doc_id"), SPLIT) == SPLIT_HELD_OUT).alias("held_out")
    text = text_or_empty().cast("binary").alias("text")
    rows = docs.select("doc_id", held_out, text)
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count_if(~F.col("held_out")).alias("ends")).first()
    shards, ends = max(16, -(-(size["bytes"] or 0) // SHARD_BYTES)), size["ends"]
    texts_in_blocks = staged(blocks(rows, BLOCK_BYTES))
    counts = staged(word_counts(texts_in_blocks, shards))
    told = counts.agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).first()
    total, distinct = (told["tokens"] or 0) + ends, (told["words"] or 0) + (ends > 0)
    met = staged(merged_runs(texts_in_blocks, shards))
    model = docs.sparkSession.sparkContext.broadcast(train(met, shards))
    replies = counts.where("block is not null").select("block", "shard", "data", F.lit(0).alias("kind"))
    replies = replies.unionByName(run_costs(met, model).withColumn("kind", F.lit(1)))

    def score(block: pa.Table, reply: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score", "n_bytes")}
        answers = dict(zip(zip(reply.column("kind").to_pylist(), reply.column("shard").to_pylist()), reply.column("data").to_pylist()))
        (docs_here,) = [unpacked(p) for p in block.column("payload").to_pylist()]
        texts = docs_here.column("text").to_pylist()
        known, numbers = vocabulary(texts)
        words, order, shard = _word_order(known, shards)
        c = np.zeros(len(known), np.int64)
        if words:
            c[order] = np.concatenate([unpacked(answers[0, s]).column("c").to_numpy() for s, _, _ in _by_shard(shard)])
        gain, floor = np.log10(c + 1), np.log10(total + distinct + 1)
        for x in numbers:
            out["n_tokens"].append(len(x) + 1)
            out["n_known"].append(int((c[x] > 0).sum()) + (ends > 0))
            out["base_score"].append(float(gain[x].sum() + np.log10(ends + 1) - (len(x) + 1) * floor))
        keys, first = runs(texts)
        codes, unique = pd.factorize(keys)
        del keys
        order, shard = _run_order(unique, shards)
        cost = np.empty(len(unique))
        cost[order] = np.concatenate([unpacked(answers[1, s]).column("cost").to_numpy() for s, _, _ in _by_shard(shard)])
        # Tokens: each word with its space, then the end; number len(known) is the end.
        every = np.concatenate([y for x in numbers for y in (x, [len(known)])])
        length = np.append(np.array([len(w) + 1 for w in known], np.int64), 1)[every]
        # Natural logarithms, as a long word's probability is below the least float.
        spelt = np.add.reduceat(cost[codes], np.cumsum(length) - length) * -np.log(2)
        with np.errstate(divide="ignore"):
            of_word = np.log(np.append(c, ends) / max(total, 1))[every]
        starts = np.cumsum(out["n_tokens"]) - out["n_tokens"]
        with np.errstate(divide="ignore"):
            again = np.log(_earlier(every, np.array(out["n_tokens"])))
        sums = mixed_words(of_word, spelt, again, starts)
        out["score"] = ((np.logaddexp.reduce(sums) - np.log(len(sums))) / np.log(10)).tolist()
        out["n_bytes"] = np.diff(np.append(first, len(codes))).tolist()
        return pa.table(
            {"doc_id": docs_here.column("doc_id"), "held_out": docs_here.column("held_out"), "n_tokens": pa.array(out["n_tokens"], pa.int64()),
             "n_known": pa.array(out["n_known"], pa.int64()), "train_tokens": pa.array([total] * len(texts), pa.int64()),
             "base_score": pa.array(out["base_score"], pa.float64()), "score": pa.array(out["score"], pa.float64()),
             "n_bytes": pa.array(out["n_bytes"], pa.int64())}
        )

    out = texts_in_blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        score,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long",
    )
    return out.withColumn("bits_per_byte", -F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes"))
