"""Documents in compressed blocks that later steps can ask and answer as a whole."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from premia.llm.common import ship

ship(__name__)


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """block, payload: the rows of a task in blocks of about ``size`` bytes of their binary column ``text``.

    Stage the result: block numbers hold for one run of the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, parts = TaskContext.get().partitionId() << 32, 0, []

        def out() -> pa.RecordBatch:
            payload = packed(pa.Table.from_batches(parts))
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([payload], pa.binary())], ["block", "payload"])

        for b in batches:
            for s in range(0, b.num_rows, 64):
                part = b.slice(s, 64)
                held += sum(map(len, part.column("text").to_pylist()))
                parts.append(part)
                if held >= size:
                    yield out()
                    block, held, parts = block + 1, 0, []
        if parts:
            yield out()

    return rows.mapInArrow(run, "block long, payload binary")
