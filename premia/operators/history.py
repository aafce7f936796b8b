"""Slowly changing dimensions of type 1 (overwrite) and type 2 (keep versions)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from premia.functions import hash_key
from premia.functions.dates import EARLIEST_START, OPEN_END
from premia.operators.relational import same_keys
from premia.operators.standardize import project_to
from premia.schemas import TABLES

# A change in one of these opens a new customer version.
CUSTOMER_COMPARE = ("customer_name", "customer_segment", "marital_status", "region")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if two rows share a key. Runs one aggregation."""
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1)
    if not twice.isEmpty():
        raise ValueError(f"duplicate keys in {list(keys)}")


def _differs(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(Column.__or__, [~left[c].eqNullSafe(right[c]) for c in cols])


def scd_type_1(source: DataFrame, target: DataFrame, key: str, check_unique: bool = True) -> DataFrame:
    """Overwrite target columns with the non-null source values of the same key and append new keys.

    Columns that only the source has are null on rows already there. A repeated source key is an error.
    """
    if check_unique:
        assert_unique(source, [key])
    s_names = {c: f"s{i}" for i, c in enumerate(source.columns)}
    t_names = {c: f"t{i}" for i, c in enumerate(target.columns)}
    given = source.toDF(*s_names.values()).withColumn("given", F.lit(True))
    known = target.toDF(*t_names.values()).withColumn("known", F.lit(True))
    joined = known.join(given, known[t_names[key]].eqNullSafe(given[s_names[key]]), "full")
    kept = [
        (F.coalesce(s_names[c], t) if c in s_names else F.col(t)).alias(c) for c, t in t_names.items()
    ]
    added = [F.when(F.col("known").isNull(), F.col(n)).alias(c) for c, n in s_names.items() if c not in t_names]
    return joined.select(*kept, *added)


def _starts(new: DataFrame, as_of: dt.date, new_key_start: str) -> Column:
    """Start of the first version of a key: the load date, or the date the feed gives."""
    if new_key_start == "as_of":
        return F.lit(as_of)
    if new_key_start != "effective":
        raise ValueError(f"new_key_start {new_key_start!r}: use 'as_of' or 'effective'")
    if "effective_start_dt" not in new.columns:
        return F.lit(EARLIEST_START)
    return F.coalesce(new["effective_start_dt"], F.lit(EARLIEST_START))


def scd_type_2(
    new: DataFrame,
    existing: DataFrame,
    join_keys: Sequence[str],
    compare_cols: Sequence[str],
    as_of: dt.date,
    sk: str = "customer_sk",
    new_key_start: str = "as_of",
) -> tuple[DataFrame, DataFrame | None]:
    """Compare a batch with the current versions: rows to insert, and keys of versions to expire.

    A key not there yet and a key with a changed column each give an insert; a changed key also gives an
    expiry. Keys absent from the batch stay as they are. Without the ``sk`` column there is nothing to name
    the expired rows by, and the second result is None.
    """
    old = existing.withColumn("_matched", F.lit(True))
    joined = new.join(old, same_keys(new, old, join_keys, join_keys), "left")
    is_new = old["_matched"].isNull()
    changed = old["_matched"].isNotNull() & _differs(new, old, compare_cols)
    start = F.when(is_new, _starts(new, as_of, new_key_start)).otherwise(F.lit(as_of))
    version = {"current_flag": F.lit(1), "eff_start_dt": start, "eff_end_dt": F.lit(OPEN_END)}
    kept = [new[c] for c in new.columns if c not in version]
    inserts = joined.filter(is_new | changed).select(*kept, *[e.alias(n) for n, e in version.items()])
    if sk not in existing.columns:
        return inserts, None
    expired = joined.filter(changed).select(
        old[sk], F.lit(0).alias("current_flag"), F.lit(as_of).alias("eff_end_dt")
    )
    return inserts, expired


def first_load(new: DataFrame) -> DataFrame:
    """All rows become current versions from the date the feed gives, else from 1900."""
    return new.withColumns(
        {
            "current_flag": F.lit(1),
            "eff_start_dt": _starts(new, EARLIEST_START, "effective"),
            "eff_end_dt": F.lit(OPEN_END),
        }
    )


def customer_key(customer_id: Column, start: Column) -> Column:
    return hash_key(customer_id, start)


def apply_customer_batch(
    current: DataFrame,
    batch: DataFrame,
    as_of: dt.date,
    created_at: Column,
    compare_cols: Sequence[str] = CUSTOMER_COMPARE,
    new_key_start: str = "effective",
) -> DataFrame:
    """Current customer versions and a batch to the versions after it, in one join.

    ``current`` has one row per customer, as has ``batch``. The result holds every row that is current after
    the batch and every row the batch expires; rows expired earlier never change and take no part. Both sides
    are unique by customer, so no key can be hot.
    """
    schema = TABLES["dim_customer"]
    old = project_to(current, schema).withColumn("_matched", F.lit(True))
    new = batch.withColumn("_given", F.lit(True))
    joined = old.join(new, old["customer_id"].eqNullSafe(new["customer_id"]), "full")
    given, matched = new["_given"].isNotNull(), old["_matched"].isNotNull()
    changed = given & matched & _differs(new, old, compare_cols)

    start = F.when(matched, F.lit(as_of)).otherwise(_starts(new, as_of, new_key_start))
    opened = {
        "customer_sk": customer_key(new["customer_id"], start),
        "eff_start_dt": start,
        "eff_end_dt": F.lit(OPEN_END),
        "current_flag": F.lit(1),
        "created_at": created_at,
    }
    closed = {"eff_end_dt": F.lit(as_of), "current_flag": F.lit(0)}

    def row(exprs: dict[str, Column], side: DataFrame) -> Column:
        cells = {f: exprs[f.name] if f.name in exprs else side[f.name] for f in schema.fields}
        return F.struct([cell.cast(f.dataType).alias(f.name) for f, cell in cells.items()])

    rows = F.array_compact(
        F.array(
            F.when(matched & ~F.coalesce(changed, F.lit(False)), row({}, old)),
            F.when(changed, row(closed, old)),
            F.when(changed | (given & ~matched), row(opened, new)),
        )
    )
    return joined.select(F.inline(rows))
