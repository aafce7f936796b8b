"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_key(*parts: Column) -> Column:
    """A surrogate key from the business key and version start.

    The same row gets the same key in every run and on every executor, with no shared counter. The key has
    128 bits: with billions of rows two 64-bit hashes would be likely to collide.
    """
    texts = [F.coalesce(part.cast("string"), F.lit("\x00")) for part in parts]
    return F.md5(F.concat_ws("\x1f", *texts))
