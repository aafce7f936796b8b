"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of a fixed number of characters. Distinct blocks are sorted and numbered; then
adjacent pairs of names are sorted and numbered in turn, until each text has one name. Two texts have the same number
of rounds and the same name exactly if they are equal: no hash decides it. Blocks are sorted by a 64-bit hash, and by
their text where two different blocks share one, so block texts are shuffled once, after each task has merged its own.
Everything else moves integers. Only DataFrame operations are used.

Null texts count as empty. Rows with the same doc_id and equal text are one document, counted in ``group_size``; null
ids are an id of their own that is smaller than none (it stays only if its group has no other). An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from premia.llm.common import SPACES, fresh, staged, text_or_empty

BLOCK = 4096


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), SPACES, " ")


def digest(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


def _blocks(docs: DataFrame, size: int, hashed: Callable[[Column], Column]) -> DataFrame:
    """doc_id, sha, total, idx, block, h: one row per block; an empty text is one empty block."""
    norm = docs.select("doc_id", normalised().alias("norm"))
    cut = F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    cut = F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(cut)
    rows = norm.select("doc_id", F.unhex(digest(F.col("norm"))).alias("sha"), cut.alias("cut"))
    rows = rows.select("doc_id", "sha", F.size("cut").alias("total"), F.posexplode("cut").alias("idx", "block"))
    return rows.withColumn("h", hashed(F.col("block")))


def _numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """Integer names in sort order, kept in the shared folder so that every reader sees the same ones."""
    return staged(distinct.orderBy(*order).withColumn("name", F.monotonically_increasing_id()))


def identities(docs: DataFrame, block: int = BLOCK, hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """doc_id, sha, copies, rounds, name: one row per doc_id and text; (rounds, name) is the text's identity.

    ``hashed`` only orders blocks; any function of the block gives the same groups.
    """
    blocks = _blocks(docs, block, hashed)
    texts = blocks.groupBy("h").agg(F.collect_set("block").alias("texts"))  # more than one only if hashes clash
    listed = texts.select("h", F.size("texts").alias("kinds"), F.posexplode(F.array_sort("texts")).alias("k", "text"))
    names = _numbered(listed.withColumn("text", F.when(F.col("kinds") > 1, F.col("text"))), "h", "k")
    keys = ["doc_id", "sha", "total", "idx", "h"]
    rows = staged(blocks.groupBy(*keys).agg(F.count("*").alias("copies")))
    named = rows.join(names.where("kinds = 1").select("h", "name"), "h")
    clashes = names.where("kinds > 1")
    if not clashes.isEmpty():
        by_text = blocks.join(clashes.select("h", F.col("text").alias("block"), "name"), ["h", "block"])
        named = named.unionByName(by_text.groupBy(*keys, "name").agg(F.count("*").alias("copies")))
    level = staged(named.select("doc_id", "sha", "copies", "total", F.col("idx").cast("long").alias("idx"), "name"))
    done, rounds = [], 0
    while True:
        done.append(level.where("total = 1").select("doc_id", "sha", "copies", F.lit(rounds).alias("rounds"), "name"))
        longer = level.where("total > 1")
        if longer.isEmpty():
            break
        half = F.floor(F.col("idx") / 2)
        pairs = longer.groupBy("doc_id", "sha", "copies", "total", half.alias("idx")).agg(
            F.max(F.when(F.col("idx") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("idx") % 2 == 1, F.col("name"))), F.lit(-1).cast("long")).alias("right"),
        )
        pairs = staged(pairs)
        numbered = _numbered(pairs.select("left", "right").distinct(), "left", "right")
        joined = pairs.join(numbered, ["left", "right"])
        level = staged(joined.select("doc_id", "sha", "copies", F.ceil(F.col("total") / 2).alias("total"), "idx", "name"))
        rounds += 1
    out = done[0]
    for frame in done[1:]:
        out = out.unionByName(frame)
    return out


def groups(docs: DataFrame, block: int = BLOCK, hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per doc_id and text, dropped ones too."""
    known = staged(identities(docs, block, hashed))
    kept = staged(
        known.groupBy("rounds", "name").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    )
    return known.join(kept, ["rounds", "name"]).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with the same columns."""
    key, sha, mine = fresh(docs, "its_id", "its_sha", "own_sha")
    stay = groups(docs, block).where("kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(sha))
    rows = docs.withColumn(mine, digest(normalised()))
    rows = rows.join(stay, rows["doc_id"].eqNullSafe(stay[key]) & (rows[mine] == stay[sha]), "left_semi")
    return rows.dropDuplicates(["doc_id", mine]).select(*docs.columns)
