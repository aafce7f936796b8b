"""Document fingerprints from closed syncmers.

A text is a sequence of tokens: words, single ideographs, single marks. Of a word of more than ``LONG_WORD`` characters, as
in scripts without spaces or encoded data, all but the last ``LONG_WORD`` characters are tokens of their own. A run of
``K`` tokens is an anchor if the least of its inner runs of ``S`` tokens, by hash, is its first or its last one; whether a
run is an anchor depends on the run alone, so equal passages have equal anchors wherever they stand. The first and the last
run of a text are anchors as well, and a text shorter than ``K`` tokens is one anchor. A fingerprint lists the anchors'
hashes in text order; anchors also carry their token positions. Only column expressions are used.

:func:`with_next` puts each document beside the next one by id. Ids are cut into ranges at quantiles, texts move once,
to their range, and the first document of a range is also sent to the range before.

Null texts are empty and have no anchors; two texts without anchors have likeness 1, one against none 0. Null ids come
last; rows with equal ids follow each other in the order of their text's hash. After the last document comes the first,
so a single row is its own next document. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from premia.llm.common import text_or_empty

K = 6
S = 2
RANGE_ROWS = 2048
MOST_RANGES = 50_000
LONG_WORD = 32
_SINGLE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"
# Letters of the Latin script are listed first, as a look at a character's script is slow.
_LATIN = r"A-Za-z0-9\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
_LETTER = rf"[[{_LATIN}][\p{{L}}\p{{M}}\p{{N}}&&[^{_SINGLE}]]]"
TOKEN = rf"{_LETTER}{{1,{LONG_WORD}}}+(?!{_LETTER})|{_LETTER}|[^\s\p{{L}}\p{{M}}\p{{N}}]|[{_SINGLE}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<hash: long, at: int>>: 32-bit hashes of the anchors and the tokens they begin at, from 0."""
    inner = k - s + 1

    def cells(a: Column, i: Column, n: int) -> list[Column]:
        """``n`` elements from place ``i`` on; a slice would copy, and hashes to the same."""
        return [F.get(a, i + (j - 1)) for j in range(n)]

    def of(h: Column) -> Column:
        last = F.size(h) - k + 1

        def chosen(g: Column) -> Column:
            def edge(i: Column) -> Column:
                first, *between, final = cells(g, i, inner) if inner > 1 else [F.get(g, i - 1)] * 2
                outer = F.least(first, final)
                return (i == 1) | (i == last) | F.lit(not between) | (outer <= (F.least(*between) if between[1:] else between[0] if between else outer))

            at = F.filter(F.sequence(F.lit(1), last), edge)
            low = lambda i: F.xxhash64(*cells(h, i, k)).bitwiseAND(F.lit(0xFFFFFFFF))
            return F.transform(at, lambda i: F.struct(low(i).alias("hash"), (i - 1).alias("at")))

        inside = F.transform(F.sequence(F.lit(1), F.size(h) - s + 1), lambda i: F.xxhash64(*cells(h, i, s)))
        whole = F.array(F.struct(F.xxhash64(h).bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash"), F.lit(0).alias("at")))
        return F.when(F.size(h) >= k, let(inside, chosen)).when(F.size(h) > 0, whole).otherwise(F.slice(whole, 1, 0))

    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return let(F.transform(tokens, lambda t: F.xxhash64(t)), of)


def fingerprint(found: Column) -> Column:
    """Eight hex digits for each anchor, in text order."""
    return F.array_join(F.transform(found, lambda a: F.lpad(F.lower(F.hex(a["hash"])), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of common anchors (Dice) of two arrays of distinct hashes."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(2 * F.size(F.array_intersect(a, b)) / both)


def _ranges(docs: DataFrame, rows: int) -> list[int]:
    """First ids of the ranges, the least id first; at most ``MOST_RANGES`` of them."""
    key = F.col("doc_id").cast("long")
    total, least = docs.agg(F.count(key), F.min(key)).first()
    n = min(MOST_RANGES, -(-total // rows))
    if n <= 1:
        return [least] if total else []
    cuts = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n)).first()[0]
    return sorted({least, *cuts})


def _range_of(key: Column, starts: list[int]) -> Column:
    """Number of the range an id lies in; found among the first of every ``wide`` ranges, then among those ranges."""
    wide = max(1, int(len(starts) ** 0.5))
    counted = lambda among: F.size(F.filter(among, lambda s: s <= key))
    coarse = counted(F.array(*map(F.lit, starts[::wide]))) - 1
    every = F.array(*map(F.lit, starts))
    return let(coarse, lambda c: c * wide + counted(F.slice(every, c * wide + 1, wide)) - 1)


def with_next(docs: DataFrame, columns: Callable[[DataFrame], DataFrame], rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text, and what ``columns`` adds, each also of the next document as ``next_...``.

    ``columns`` is applied where the range's rows have met, and must not change rows.
    """
    key = F.col("doc_id").cast("long")
    starts = _ranges(docs, rows)
    last = max(0, len(starts) - 1)
    plain = docs.select("doc_id", text_or_empty().alias("text"))
    place = lambda n, turn: F.struct(F.lit(n).cast("int").alias("n") if isinstance(n, int) else n.cast("int").alias("n"), F.lit(turn).alias("turn"))
    if starts:
        mine = F.when(key.isNull(), last).otherwise(_range_of(key, starts))
        placed = plain.withColumn("mine", mine)
        opens = F.array_contains(F.slice(F.array(*map(F.lit, starts)), F.col("mine") + 1, 1), key)
        wraps = F.when(opens & (F.col("mine") == 0), F.array(place(last, 2))).otherwise(F.array().cast("array<struct<n:int,turn:int>>"))
        before = F.when(opens & (F.col("mine") > 0), F.array(place(F.col("mine") - 1, 1))).otherwise(F.array().cast("array<struct<n:int,turn:int>>"))
        places = F.concat(F.array(place(F.col("mine"), 0)), F.coalesce(before, F.array().cast("array<struct<n:int,turn:int>>")),
                          F.coalesce(wraps, F.array().cast("array<struct<n:int,turn:int>>")))
    else:
        placed, places = plain.withColumn("mine", F.lit(0)), F.array(place(0, 0))
    met = placed.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", F.col("p.n").alias("n"), F.col("p.turn").alias("turn"))
    rich = columns(met.repartition("n"))
    order = Window.partitionBy("n").orderBy("turn", key.isNull(), key, F.xxhash64("text"))
    first = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    more = [c for c in rich.columns if c not in ("doc_id", "n", "turn")]
    after = [F.coalesce(F.lead(c).over(order), F.first(c).over(first)).alias(f"next_{c}") for c in more]
    return rich.select("doc_id", *more, *after, "turn").where("turn = 0").drop("turn")


def compared(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """doc_id, n_chars, edited (text), anchors, edited_anchors, near_edited, near_next, one row per row of ``docs``."""
    pairs = with_next(docs, lambda d: d.withColumn("anchors", anchors(F.col("text"), k, s)))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = pairs.select(
        "doc_id", n.cast("long").alias("n_chars"), "anchors", "next_anchors",
        F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"),
    )
    found = edited.withColumn("edited_anchors", anchors(F.col("edited"), k, s))
    kinds = {c: F.array_distinct(F.col(c)["hash"]) for c in ("anchors", "edited_anchors", "next_anchors")}
    return found.select(
        "doc_id", "n_chars", "edited", "anchors", "edited_anchors",
        likeness(kinds["anchors"], kinds["edited_anchors"]).alias("near_edited"),
        likeness(kinds["anchors"], kinds["next_anchors"]).alias("near_next"),
    )


def digested(found: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"), fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
