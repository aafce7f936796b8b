"""Compare Spark results with the SQL twins on DuckDB."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Arrow types that both engines should agree on, by family.
_FAMILY = {"large_string": "string", "utf8": "string", "large_utf8": "string", "date32[day]": "date"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, Decimal):
        return value.normalize()
    return value


def _rows(arrow) -> tuple[dict[str, str], Counter]:
    names = sorted(arrow.column_names)
    kinds = {n: _FAMILY.get(str(arrow.schema.field(n).type), str(arrow.schema.field(n).type)) for n in names}
    columns = [[_cell(v) for v in arrow.column(n).to_pylist()] for n in names]
    return kinds, Counter(zip(*columns))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: columns, types, rows. Empty if nothing does."""
    mine_kinds, mine = _rows(df.toArrow())
    theirs_kinds, theirs = _rows(con.sql(sql).to_arrow_table())
    found = []
    if mine_kinds.keys() != theirs_kinds.keys():
        return [f"columns {sorted(mine_kinds)} / {sorted(theirs_kinds)}"]
    found += [f"type of {n}: {k} / {theirs_kinds[n]}" for n, k in mine_kinds.items() if k != theirs_kinds[n]]
    if mine != theirs:
        found.append(
            f"rows {mine.total()} / {theirs.total()}, only here {list((mine - theirs).items())[:2]}, "
            f"only there {list((theirs - mine).items())[:2]}"
        )
    if not mine:
        found.append("no rows")
    return found


if __name__ == "__main__":
    sys.path.insert(0, sys.path[0] + "/..")
    import __spark_entry__ as entry
    from premia.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            result = differences(run(spark, sf_dir), con, oracle[name])
        except Exception as error:  # report and go on with the next query
            result = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{name:22s} {time.perf_counter() - start:6.2f}s {'ok' if not result else result}", flush=True)
