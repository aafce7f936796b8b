"""What the operators share: text rules, staged tables, column names."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from premia.session import shared_dir, tune

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def staged(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts the lineage: if an executor is lost, later steps read the files instead of computing them again.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of columns of the same name."""
    condition = F.lit(True)
    for n in names:
        condition = condition & left[n].eqNullSafe(right[n])
    return condition


def bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that the frame does not use, in any case."""
    used, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in used:
            n += "_"
        used.add(n.lower())
        out.append(n)
    return out


#: Documents can be long: batches for Python are bounded by rows and by bytes.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the operators count on."""
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return tune(spark)


def ship(module: str) -> None:
    """Send a module's functions along with the tasks that call them, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
