"""SimHash near-dedup by bit-sliced comparison.

Fingerprints are 64-bit majorities of the hashes of word shingles. Two fingerprints that differ in at most ``radius``
bits agree in all bits of some ``m - radius`` of ``m`` blocks, so each fingerprint is filed once for every choice of
such blocks; ``m`` grows with the number of fingerprints so that buckets stay small, and no choice loses a link. Inside
a bucket fingerprints are stored as bit planes; one word operation adds one bit of 64 comparisons to carry-save
counters that overflow above the radius, and a query is abandoned once all its lanes have overflowed. Buckets above
``CHUNK`` are split by hash and their chunks meet pairwise, in tasks of their own. A bucket sends on a spanning forest
of its links, not the links. Components come from alternating star contractions over tables in the shared folder.

Equal fingerprints are compared once. Null texts are empty, empty texts have fingerprint zero and are linked like any
other. Null ids never name a component unless it has no other. Repeated rows are documents of their own. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from premia.llm.common import fresh, ship, staged, text_or_empty

ship(__name__)

SEED = 42
CHUNK = 4096
BLOCK = 512
HASHES_AT_ONCE = 65_536


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of each run of so many lower-case words; of the whole sequence if it is shorter."""
    parts = text.lower().split()  # bytes: A-Z only, split at \x20 and \x09-\x0D only
    if not parts:
        return []
    flat = b" ".join(parts)
    ends, at = [], -1
    for p in parts:
        at += len(p) + 1
        ends.append(at)
    last = ends[words - 1 :] or ends[-1:]
    starts = [0, *[e + 1 for e in ends[: len(last) - 1]]]
    digest = xxhash.xxh64_intdigest
    return [digest(flat[s:e], SEED) for s, e in zip(starts, last)]


def fingerprints_of(texts: list[bytes], words: int) -> np.ndarray:
    """uint64 per text; zero for texts without words."""
    ones, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    pending: list[np.ndarray] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if owners:
            bits = np.unpackbits(np.concatenate(pending).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            starts = np.cumsum([0, *map(len, pending[:-1])])
            np.add.at(ones, owners, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
            pending.clear(), owners.clear()
            held = 0

    for i, text in enumerate(texts):
        hashes = np.array(shingle_hashes(text, words), np.uint64)
        total[i] = len(hashes)
        for s in range(0, len(hashes), HASHES_AT_ONCE):
            piece = hashes[s : s + HASHES_AT_ONCE]
            pending.append(piece)
            owners.append(i)
            held += len(piece)
            if held >= HASHES_AT_ONCE:
                flush()
    flush()
    return np.packbits(ones * 2 > total[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long), text_hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprints_of(b.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(fp.view(np.int64)), b.column("text_hash")], ["doc_id", "fp", "text_hash"]
            )

    rows = docs.select("doc_id", text_or_empty().cast("binary").alias("text"), F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long, text_hash long")


def close_pairs(queries: np.ndarray, targets: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (query, target) of all pairs that differ in at most ``radius`` bits."""
    lanes = -(-len(targets) // 64) * 64
    bits = np.zeros((64, lanes), np.uint8)
    bits[:, : len(targets)] = np.unpackbits(targets.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    planes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    padding = np.packbits(np.arange(lanes) >= len(targets), bitorder="little").view(np.uint64)
    alive = np.arange(len(queries))
    asked = np.where(np.unpackbits(queries.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") > 0, ~np.uint64(0), np.uint64(0))
    # Counters start so that the first difference above the radius carries out of the highest one.
    digits = max(1, radius.bit_length())
    start = (1 << digits) - 1 - radius
    shape = (len(queries), planes.shape[1])
    count = [np.full(shape, ~np.uint64(0) if start >> d & 1 else np.uint64(0)) for d in range(digits)]
    over = np.repeat(padding[None, :], len(queries), axis=0)
    for b in range(0, 64, 2):
        x, y = planes[b][None, :] ^ asked[:, b, None], planes[b + 1][None, :] ^ asked[:, b + 1, None]
        xy = x ^ y
        carry = (x & y) | (count[0] & xy)
        count[0] ^= xy
        for d in range(1, digits):
            count[d], carry = count[d] ^ carry, count[d] & carry
        over |= carry
        if b % 8 == 6:
            open_rows = (over != ~np.uint64(0)).any(axis=1)
            if open_rows.sum() < 0.7 * len(alive):
                alive, asked, over, count = alive[open_rows], asked[open_rows], over[open_rows], [c[open_rows] for c in count]
                if not len(alive):
                    break
    if not len(alive):
        return alive, alive
    near = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, : len(targets)]
    q, t = np.nonzero(near)
    return alive[q], t


def forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a graph on n nodes."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return kept


def _masks(nodes: int, radius: int) -> list[int]:
    """Bits that a bucket's members share, one mask per choice of blocks."""
    m = radius + 1
    while m < 16 and nodes > BLOCK * 2 ** (64 * (m - radius) // m):
        m += 1
    edges = [64 * i // m for i in range(m + 1)]
    blocks = [((1 << (e - s)) - 1) << s for s, e in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, m - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(nodes: DataFrame, radius: int, chunk: int = CHUNK) -> DataFrame:
    """u, v: links of distinct fingerprints that span the components of the link graph."""
    masks = _masks(nodes.count(), radius)
    filed = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])
    rows = nodes.select("fp", F.explode(filed).alias("f")).select("fp", "f.choice", "f.key")
    large = rows.groupBy("choice", "key").count().where(F.col("count") > chunk)
    large = staged(large.select("choice", "key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")))
    rows = rows.join(large, ["choice", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("choice", "key", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine", "fp")
    group = ["choice", "key", "a", "b"]
    dealt = rows.repartition(*group).sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(fp: np.ndarray, mine: np.ndarray, two: bool) -> tuple[list[int], list[int]]:
            us: list[int] = []
            vs: list[int] = []
            left = np.flatnonzero(mine == mine.min()) if two else np.arange(len(fp))
            right = np.flatnonzero(mine != mine.min()) if two else left
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for s in range(0, len(left), BLOCK):
                part = left[s : s + BLOCK]
                q, t = close_pairs(fp[part], fp[right], radius)
                q, t = part[q], right[t]
                tree = forest(len(fp), q[q != t], t[q != t])
                found.append((np.array([e[0] for e in tree], np.int64), np.array([e[1] for e in tree], np.int64)))
            if found:
                for x, y in forest(len(fp), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])):
                    us.append(int(fp[x].view(np.int64)))
                    vs.append(int(fp[y].view(np.int64)))
            return us, vs

        # Small buckets share a comparison: a link across them is a link all the same.
        waiting: list[np.ndarray] = []
        group_fp: list[np.ndarray] = []
        group_mine: list[np.ndarray] = []
        current = None

        def batch(us: list[int], vs: list[int]) -> Iterator[pa.RecordBatch]:
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

        def drain() -> Iterator[pa.RecordBatch]:
            if waiting:
                fp = np.unique(np.concatenate(waiting))
                waiting.clear()
                yield from batch(*compare(fp, np.zeros(len(fp), np.int32), False))

        def close() -> Iterator[pa.RecordBatch]:
            if not group_fp:
                return
            fp, mine = np.concatenate(group_fp), np.concatenate(group_mine)
            group_fp.clear(), group_mine.clear()
            if len(fp) < 2:
                return
            if len(fp) >= BLOCK or current[2] != current[3]:
                two = current[2] != current[3]
                if not two or mine.min() != mine.max():
                    yield from batch(*compare(fp, mine, two))
                return
            if sum(map(len, waiting)) + len(fp) > BLOCK:
                yield from drain()
            waiting.append(fp)

        for b in batches:
            cols = [b.column(c).to_numpy() for c in group]
            fp, mine = b.column("fp").to_numpy().view(np.uint64), b.column("mine").to_numpy()
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1 if len(fp) else []
            bounds = [0, *change, len(fp)]
            for s, e in zip(bounds, bounds[1:]):
                if s == e:
                    continue
                key = tuple(int(c[s]) for c in cols)
                if key != current:
                    yield from close()
                    current = key
                group_fp.append(fp[s:e].copy())
                group_mine.append(mine[s:e].copy())
        yield from close()
        yield from drain()

    return dealt.mapInArrow(run, "u long, v long")


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges (u, v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    large = both.join(least, both["u"] == least["c"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = staged(large.where("u <> v").distinct())
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    moved = down.join(least, down["u"] == least["c"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    small = moved.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return staged(small.where("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """u, root: the least node of the component, for every node that is not a root itself."""
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    edges = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = mark(edges)
    while seen[0]:
        edges = _stars(edges)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select("u", F.col("v").alias("root"))


def grouped(docs: DataFrame, words: int = 4, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """doc_id, fp, text_hash, root (the component), component_id (its smallest doc_id)."""
    prints = staged(fingerprints(docs, words))
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes, radius, chunk))
    named = nodes.join(roots, nodes["fp"] == roots["u"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = staged(named)
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = staged(named.select("fp", "root").join(ids, "root"))
    return prints.join(of_print, "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def representatives(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` with one document of each component, that of the smallest id, with the same columns."""
    key, hashed, mine = fresh(docs, "its_id", "its_hash", "own_hash")
    first = grouped(docs, words, radius).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k")
    )
    stay = first.select(F.col("k.doc_id").alias(key), F.col("k.text_hash").alias(hashed))
    rows = docs.withColumn(mine, F.xxhash64("text"))
    rows = rows.join(stay, rows["doc_id"].eqNullSafe(stay[key]) & (rows[mine] == stay[hashed]), "left_semi")
    return rows.dropDuplicates(["doc_id", mine]).select(*docs.columns)
