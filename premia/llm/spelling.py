"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words are held in a trie whose nodes are named by a hash of the way to them and whose edges are rows of a table. States
(word, position, node, edits) go down the trie level by level, all words at once: at each level the states are joined with
the level's edges on the node. A state without an edit stays on its word's own way and puts out one state per other edge: the
edge's letter replaces the word's next one or stands before it. A state with an edit has to follow the word's letters. One
that arrives at the end of a word with nothing left has found a neighbour.

An edit lies in the second half of the word or, read backwards, in the second half of the reversed word. So every word is
walked in both directions, and edits are made only below its middle, where the trie is sparse: nothing ever stands at the
root, which all words share. Of two words one edit apart one finds the other (the shorter one adds a letter, the one with
the lesser letter replaces it), and both learn of it.

There is one level per letter of the longest word, so words of more than ``LONGEST`` letters go another way: the hashes of
a word without each of its letters, found in one pass, meet the same hashes of others. What shares one is at most one row per
letter of the alphabet. All neighbours are checked by their distance, so a clash of hashes adds nothing.

Word counts are summed within each task before they are shuffled. Null texts hold no words, a null id counts as
empty text in the hash, repeated rows count as often as they come, equal counts are told apart by the words. Empty tables and
tables without words give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from premia.llm.common import ascii_lower, ship, staged, text_or_empty

ship(__name__)

# Fixed value: the letters of words.
RUN = r"[a-zÀ-ÿ]+"
LONGEST = 40


def words(docs: DataFrame, spoilt: int, least_length: int, least_count: int) -> DataFrame:
    """word, n: runs of letters with their counts; of every ``spoilt``-th run of a document, by hash, a letter is deleted."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("its_id"),
        F.explode(F.regexp_extract_all(ascii_lower(text_or_empty("text")), F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= least_length)
    h = F.crc32(F.concat_ws(":", "its_id", "run").cast("binary"))
    hashed = runs.select("run", F.when(h % spoilt == 0, (h % F.length("run")).cast("int")).alias("at"))
    word = F.when(F.col("at").isNull(), F.col("run")).otherwise(F.overlay("run", F.lit(""), F.col("at") + 1, F.lit(1)))
    return (
        hashed.select(word.alias("word"))
        .where(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_count)
    )


# --- trie ----------------------------------------------------------------------------------------------------


def node(way: Column, direction: Column) -> Column:
    return F.xxhash64(way, direction)


def read_both_ways(vocabulary: DataFrame) -> DataFrame:
    """word, direction, way: the word forwards (0) and backwards (1), with its length."""
    ways = F.posexplode(F.array("word", F.reverse("word"))).alias("direction", "way")
    return vocabulary.select("word", F.length("word").alias("length"), ways)


def edges(both: DataFrame, depth: int) -> DataFrame:
    """A level of the trie: node, letter, child; a word's end is an edge without a letter, with the word.

    Only below the middle of words shorter by one letter: no state comes to what lies above.
    """
    letter = F.substring("way", depth + 1, 1)
    middle = F.floor((F.col("length") - 1 + F.col("direction")) / 2)
    return (
        both.where((F.col("length") >= depth) & (middle <= depth))
        .select(
            node(F.substring("way", 1, depth), F.col("direction")).alias("node"),
            letter.alias("letter"),
            node(F.substring("way", 1, depth + 1), F.col("direction")).alias("child"),
            F.when(letter == "", F.col("word")).alias("end"),
        )
        .repartition("node")
        .distinct()
    )


STATE = ("word", "rest", "node", "edits")


def untouched(both: DataFrame, depth: int) -> DataFrame:
    """States without an edit at this depth: words whose middle is not below it."""
    middle = F.floor((F.col("length") + F.col("direction")) / 2)
    return both.where((F.col("length") >= depth) & (middle <= depth)).select(
        "word",
        F.expr(f"substring(way, {depth + 1})").alias("rest"),
        node(F.substring("way", 1, depth), F.col("direction")).alias("node"),
        F.lit(0).alias("edits"),
    )


def stepped(states: DataFrame, level: DataFrame) -> DataFrame:
    """States with an edit one level further down, and those that arrived (``near`` is the word they found)."""
    head, tail = F.substring("rest", 1, 1), F.expr("substring(rest, 2)")
    edited, follows = F.col("edits") == 1, F.col("letter") == F.substring("rest", 1, 1)
    met = states.join(level.withColumnRenamed("node", "at"), (F.col("node") == F.col("at")) & (edited == follows))
    met = met.where(edited | (F.col("letter") != ""))

    def state(rest: Column, near: Column) -> Column:
        return F.struct(rest.alias("rest"), near.alias("near"))

    none = F.lit(None).cast("string")
    replaced = F.when((head != "") & (head < F.col("letter")), state(tail, none))
    onward = F.when(edited, F.array(state(tail, F.col("end")))).otherwise(F.array(state(F.col("rest"), none), replaced))
    return (
        met.select("word", F.col("child").alias("node"), F.lit(1).alias("edits"), F.explode(F.array_compact(onward)).alias("s"))
        .select("word", "s.rest", "node", "edits", "s.near")
    )


def trie_neighbours(vocabulary: DataFrame) -> DataFrame:
    """word, near: words of up to ``LONGEST`` letters that are one edit apart, each pair once or more."""
    both = read_both_ways(vocabulary.where(F.length("word") <= LONGEST))
    ends = vocabulary.where(F.length("word") <= LONGEST).agg(F.min(F.length("word")), F.max(F.length("word"))).first()
    if ends[0] is None:
        return vocabulary.sparkSession.createDataFrame([], "word string, near string")
    found, states = [], None
    for depth in range(ends[0] // 2, ends[1] + 1):
        here = untouched(both, depth)
        if states is not None:
            here = here.unionByName(states)
        out = staged(stepped(here, edges(both, depth)))
        found.append(out.where("near is not null").select("word", "near"))
        states = out.where("near is null").select(*STATE)
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    return pairs


# --- words beyond the trie -----------------------------------------------------------------------------------

PRIME, BASE = (1 << 61) - 1, 1_000_003


def shortened(word: str) -> Iterator[tuple[int, int]]:
    """Hash of the word (place -1) and of the word without each of its letters, by place."""
    whole, power = 0, 1
    for c in word:
        whole = (whole * BASE + ord(c)) % PRIME
    yield -1, whole
    # Backwards: what stands behind the letter keeps its powers, what stands before it loses one.
    behind, inverse, before = 0, pow(BASE, PRIME - 2, PRIME), whole
    for i in range(len(word) - 1, -1, -1):
        before = (before - ord(word[i])) * inverse % PRIME
        yield i, (before * power + behind) % PRIME
        behind = (behind + ord(word[i]) * power) % PRIME
        power = power * BASE % PRIME


def long_neighbours(vocabulary: DataFrame) -> DataFrame:
    """word, near: as :func:`trie_neighbours`, for pairs whose longer word has more than ``LONGEST`` letters."""
    long = vocabulary.where(F.length("word") >= LONGEST).select("word", F.xxhash64("word").alias("name"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for word, name in zip(b.column("word"), b.column("name")):
                rows, name = [], name.as_py()
                for row in shortened(word.as_py()):
                    rows.append((name, *row))
                    if len(rows) == 1 << 16:
                        yield table(rows)
                        rows = []
                if rows:
                    yield table(rows)

    def table(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["name", "place", "hash"])

    cut = staged(long.mapInArrow(run, "name long, place long, hash long"))
    other = cut.select(F.col("name").alias("near"), F.col("place").alias("its_place"), F.col("hash").alias("its_hash"))
    # A letter replaced at one place, or added at any.
    replaced = cut.join(other, (F.col("hash") == F.col("its_hash")) & (F.col("place") == F.col("its_place")) & (F.col("name") < F.col("near")))
    added = cut.where("place < 0").join(other.where("its_place >= 0"), F.col("hash") == F.col("its_hash"))
    names = replaced.where("place >= 0").select("name", "near").unionByName(added.select("name", "near")).distinct()
    spelled = long.select(F.col("name").alias("near"), F.col("word").alias("near_word"))
    return names.join(long, "name").join(spelled, "near").select("word", F.col("near_word").alias("near"))


# --- forms ---------------------------------------------------------------------------------------------------


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """word, near: every two words whose distance is one, both ways round, once."""
    pairs = trie_neighbours(vocabulary).unionByName(long_neighbours(vocabulary))
    pairs = pairs.select(F.least("word", "near").alias("word"), F.greatest("word", "near").alias("near")).distinct()
    pairs = pairs.where(F.levenshtein("word", "near", 1) == 1)
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for words that have a form: the last of their chain of forms, by doubling steps.

    A form is at least twice as frequent as its word, so there are no rings and few rounds.
    """
    reached = staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not reached.where("moved").isEmpty():
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reached = staged(
            reached.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            )
        )
    return reached.select("word", "root")


def variants(docs: DataFrame, spoilt: int = 97, least_length: int = 5, least_count: int = 3, ratio: int = 2) -> DataFrame:
    """One row per word: its form (the most frequent near word, if ``ratio`` times as frequent), root and near words."""
    return grouped(staged(words(docs, spoilt, least_length, least_count)), ratio)


def grouped(vocabulary: DataFrame, ratio: int = 2) -> DataFrame:
    near = neighbours(vocabulary).join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    chosen = F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best"))
    formed = staged(
        vocabulary.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            chosen["near"].alias("form"),
            (-chosen["n"]).alias("form_n"),
        )
    )
    last = roots(formed.where("form is not null"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
