"""Delimited files in zip archives: a task per member, cells parsed by Spark.

Archives are read as binary files, so they may lie wherever Spark reads. Their directories are opened where the archive
is read; the members' compressed bytes are dealt out in chunks, and the task that gets a member inflates it as a stream,
cuts it into records and checks it against the directory. A task holds an archive's compressed bytes at most (2 GB, the limit
of the reader), and beyond that no more than a chunk and a record.
"""

from __future__ import annotations

import itertools
import sys
import zipfile
import zlib
from codecs import getincrementaldecoder
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from premia.operators.standardize import blank_cells, snake_case

# Tasks get these functions by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 4 << 20
PIECE = 1 << 20
ROWS = 2_000
CHUNKS = "path string, member string, n long, method long, crc long, problem string, chunk binary"


class Damaged(ValueError):
    """A member that cannot be read to its end."""


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, content)`` of the zip archives in a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select("path", "content")


def _batch(rows: Sequence[tuple], names: Sequence[str], kinds: Sequence[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(names))


def member_chunks(archives: DataFrame, wanted: Callable[[str, str], bool]) -> DataFrame:
    """The compressed bytes of the members in chunks, each member with its rows in one task and in order.

    An archive or member whose directory entry is no good comes as one row with a ``problem``.
    """
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def of_archive(path: str, content: pa.Buffer) -> Iterator[tuple]:
        try:
            infos = zipfile.ZipFile(pa.BufferReader(content)).infolist()
        except zipfile.BadZipFile as error:
            yield path, None, 0, 0, 0, f"BadZipFile: {error}", b""
            return
        for info in infos:
            # Files in sub-folders of an archive are no files of the folder it lies in.
            if "/" in info.filename or not info.filename.endswith(".csv") or not wanted(path, info.filename):
                continue
            at = info.header_offset
            head = content.slice(at, 30).to_pybytes() if at + 30 <= content.size else b""
            problem = None
            if head[:4] != b"PK\x03\x04":
                problem = "BadZipFile: no entry where the directory says"
            elif info.flag_bits & 1:
                problem = "NotImplementedError: encrypted"
            elif info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                problem = f"NotImplementedError: compression {info.compress_type}"
            start = at + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little")
            size = 0 if problem else max(min(info.compress_size, content.size - start), 0)
            for n, s in enumerate(range(0, size, CHUNK) or (0,)):
                piece = content.slice(start + s, min(CHUNK, size - s)).to_pybytes() if size else b""
                yield path, info.filename, n, info.compress_type, info.CRC, problem, piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path"), b.column("content")):
                for row in of_archive(path.as_py(), content.as_buffer()):
                    yield _batch([row], names, kinds)

    return archives.mapInArrow(run, CHUNKS).repartition("path", "member").sortWithinPartitions("path", "member", "n")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, Iterator[dict]]]:
    rows = (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist())
    for (path, member), its in itertools.groupby(rows, key=lambda r: (r["path"], r["member"])):
        yield path, member, its


def _text(chunks: Iterator[dict]) -> Iterator[str]:
    """The member's text in pieces; :class:`Damaged` if it is not what the directory says."""
    decoder, crc, inflate, said = getincrementaldecoder("utf-8-sig")(), 0, None, 0
    try:
        for row in chunks:
            if row["problem"]:
                raise Damaged(row["problem"])
            said, data = row["crc"], row["chunk"]
            if row["method"] == zipfile.ZIP_STORED:
                pieces = (data[s : s + PIECE] for s in range(0, len(data), PIECE))
            else:
                inflate = inflate or zlib.decompressobj(-zlib.MAX_WBITS)
                pieces = _inflated(inflate, data)
            for piece in pieces:
                crc = zlib.crc32(piece, crc)
                yield decoder.decode(piece)
        yield decoder.decode(b"", True)
    except (zlib.error, UnicodeError) as error:
        raise Damaged(f"{type(error).__name__}: {error}") from error
    if inflate is not None and not inflate.eof:
        raise Damaged("EOFError: the data ends early")
    if crc != said:
        raise Damaged("BadZipFile: wrong checksum")


def _inflated(inflate, data: bytes) -> Iterator[bytes]:
    while data and not inflate.eof:
        yield inflate.decompress(data, PIECE)
        data = inflate.unconsumed_tail


def records(pieces: Iterator[str], quote: str) -> Iterator[str]:
    """Records of delimited text: lines, put together while a quote is open. Empty lines are left out."""
    line: list[str] = []
    held: list[str] = []
    odd = 0

    def closed(end: bool = False) -> Iterator[str]:
        nonlocal odd, line, held
        whole, line = "".join(line), []
        odd ^= whole.count(quote) & 1
        held.append(whole)
        if not odd or end:
            record, held = "\n".join(held), []
            record = record.removesuffix("\r")
            if record:
                yield record

    for piece in pieces:
        first, *rest = piece.split("\n")
        line.append(first)
        for more in rest:
            yield from closed()
            line = [more]
    if line or held:
        yield from closed(end=True)


def scanned(archives: DataFrame, quote: str) -> DataFrame:
    """``(path, member, header, problem)`` of all delimited files, each read to its end; the header as it is written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, member, chunks in _members(batches):
            header, problem = "", None
            try:
                its = records(_text(chunks), quote)
                header = next(its, "")
                for _ in its:
                    pass
            except Damaged as error:
                header, problem = "", str(error)
            yield _batch([(path, member, header, problem)], ["path", "member", "header", "problem"], [pa.string()] * 4)

    return member_chunks(archives, lambda path, name: True).mapInArrow(run, "path string, member string, header string, problem string")


def read_members(
    archives: DataFrame, headers: Mapping[tuple[str, str], tuple[str, ...]], options: Mapping[str, str], quote: str
) -> DataFrame:
    """The rows of the given members ``{(path, name): header}``, as snake-case text columns plus ``source_file``.

    Of names that a header holds twice the first counts. A damaged member stops the job.
    """
    layouts = sorted(set(headers.values()))
    layout_of = {member: layouts.index(header) for member, header in headers.items()}
    sources = sorted({path for path, _ in headers})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["source_file", "layout", "record"], [pa.string(), pa.int32(), pa.string()]
        for path, member, chunks in _members(batches):
            its = records(_text(chunks), quote)
            next(its, None)
            layout = layout_of[path, member]
            while rows := [(member, layout, r) for r in itertools.islice(its, ROWS)]:
                yield _batch(rows, names, kinds)

    chunks = member_chunks(archives.where(F.col("path").isin(sources)), lambda path, name: (path, name) in layout_of)
    lines = chunks.mapInArrow(run, "source_file string, layout int, record string")
    width = max(map(len, layouts))
    cells = F.from_csv("record", ", ".join(f"c{i} string" for i in range(width)), dict(options))
    parsed = lines.select("source_file", "layout", cells.alias("cells"))
    columns = [[snake_case(c) for c in header] for header in layouts]

    def cell(name: str) -> Column:
        value = F.lit(None).cast("string")
        for i, its in enumerate(columns):
            if name in its:
                value = F.when(F.col("layout") == i, F.col(f"cells.c{its.index(name)}")).otherwise(value)
        return value

    names = list(dict.fromkeys(n for its in columns for n in its))
    return blank_cells(parsed.select(*[cell(n).alias(n) for n in names], "source_file"))

