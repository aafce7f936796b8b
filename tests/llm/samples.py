"""Small tables with everything that can be odd about documents."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators might use for columns of their own.
CLASHING = "score string, name long, h long, at string, its_id long, block string, fp string, TEXT_BYTES long, start long, n int"
LONG = " ".join(f"word{i}" for i in range(40_000))
PASSAGE = "this very passage of well over fifty bytes stands in several documents of the table"

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "a"),
    (2, "the quick  brown fox jumps over the lazy dog", "en", "a"),
    (3, "The quick brown fox jumps over the lazy dog", "en", None),
    (3, "The quick brown fox jumps over the lazy dog", "en", None),  # repeated row
    (4, None, None, "b"),
    (5, "", "en", "b"),
    (6, "   \n\t ", "en", "b"),
    (None, "no id here but a mail to someone@example.com", "en", "c"),
    (None, "The quick brown fox jumps over the lazy dog", None, "c"),
    (7, f"One. {PASSAGE} End.", "en", "a"),
    (8, f"Two: {PASSAGE}!", "en", "a"),
    (9, LONG, "en", "a"),
    (10, LONG + " tail", "en", "b"),
    (11, "漢字の文章 é😀 +49 30 1234567 x 4111 1111 1111 1111", "ja", "d"),
    (12, "a", "en", "d"),
    (13, "a", "en", "d"),
    (13, "another text under the same id", "en", "d"),
    (-5, "negative id", "en", "z"),
]


def messy(spark: SparkSession, rows=ROWS) -> DataFrame:
    schema = f"{DOCUMENTS}, {CLASHING}"
    extra = ("s", 1, 2, "a", 3, "b", "f", 4, 5, 6)
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *extra) for i, t, lang, s in rows], schema)


def empty(spark: SparkSession) -> DataFrame:
    return messy(spark, [])


def folder(tables: dict[str, DataFrame]) -> str:
    """The tables as Parquet, as the queries read them."""
    path = Path(tempfile.mkdtemp(prefix="llm-"))
    for name, df in tables.items():
        df.write.parquet(str(path / f"{name}.parquet"))
    return str(path)
