"""Delimited files: single, whole folders with drifting headers, archives, daily batches."""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from fnmatch import fnmatchcase
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from premia.operators.relational import union_outer
from premia.operators.standardize import blank_cells, snake_case
from premia.sources.archives import archives_in, read_members, scanned

log = logging.getLogger(__name__)

# Fixed value: how a file name tells its day.
DAY_OF_FILE = r"(?i)day(\d+)\.csv$"


def _texts(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, **options) -> DataFrame:
    """A delimited file with a header; all columns are text unless a schema is given.

    Quotes within quoted cells are doubled. Line breaks in cells need ``multiLine=True``, with which a file can
    no longer be split among tasks.
    """
    reader = spark.read.options(**{"header": True, "escape": '"', **options})
    return (reader.schema(schema) if schema else reader).csv(path)


def _logical(path: str) -> str:
    """The file a path belongs to: a folder named ``*.csv``, as Spark writes it, counts as one file."""
    parent = path.rsplit("/", 1)[0]
    return parent if parent.endswith(".csv") else path


def _base(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> list[str]:
    """Sorted paths of a folder, by the file index that every Spark reader builds."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    try:
        found = reader.load(folder if recursive else f"{folder.rstrip('/')}/{pattern}").inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    paths = sorted(unquote(p) for p in found)
    if recursive:
        return [p for p in paths if fnmatchcase(_base(_logical(p)), pattern)]
    here = re.sub(r"^\w+:/*", "", folder).strip("/")
    return [p for p in paths if _logical(p).rsplit("/", 1)[0].endswith(here)]


def _csv_options(options: Mapping) -> dict[str, str]:
    """What a plain csv parser needs to know of reader options."""
    return {"delimiter": options.get("sep", options.get("delimiter", ",")), "quotechar": options.get("quote", '"')}


def _headers(spark: SparkSession, paths: Sequence[str], options: Mapping) -> dict[tuple[str, ...], list[str]]:
    """Paths by header, from the first lines of all files in one job; empty files are left out."""
    lines = spark.read.text(list(paths)).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.filter("file_block_start = 0").withColumn("at", F.monotonically_increasing_id())
    first = lines.groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(first.groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("paths")).collect()):
        columns = next(csv.reader([row["header"].lstrip("\ufeff")], **_csv_options(options)), [])
        if columns:
            found.setdefault(tuple(columns), []).extend(unquote(p) for p in row["paths"])
    return found


def source_name(path: Column) -> Column:
    """The name of the file a path belongs to, see :func:`_logical`."""
    return F.regexp_extract(path, r"([^/]+\.csv)(/[^/]+)?$", 1)


def read_files(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame | None:
    """Files with any headers as one frame of snake-case text columns plus ``source_file``.

    One scan per distinct header, with columns taken by position; columns of all files meet by name. Spelled-out
    missing values become null. A file that cannot be read to its end stops the job.
    """
    frames = []
    for columns, group in _headers(spark, paths, options).items():
        by_place = _texts(f"c{i}" for i in range(len(columns)))
        scan = read_csv(spark, group, by_place, enforceSchema=True, **options)
        placed = scan.select(*by_place.names, source_name(F.col("_metadata.file_path")).alias("source_file"))
        names = [snake_case(c) for c in columns]
        kept = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in names[:i]]
        frames.append(blank_cells(placed.select(*kept, "source_file")))
    return union_outer(frames) if frames else None


@dataclass(frozen=True)
class Member:
    """A file in an archive, or an archive that cannot be opened (without a name)."""

    path: str
    name: str | None
    header: tuple[str, ...]
    problem: str | None


_ARCHIVE_OPTIONS = {"sep", "delimiter", "quote", "header"}


def scan_archives(spark: SparkSession, folder: str, **options) -> list[Member]:
    """All delimited files in the archives of a folder, in one job; a row per member reaches the driver.

    Give the result to the functions below to read the archives once more only, for their rows.
    """
    if not list_files(spark, folder, "*.zip"):
        return []
    unknown = set(options) - _ARCHIVE_OPTIONS
    if unknown:
        raise ValueError(f"options {sorted(unknown)} do not apply to files in archives")
    parser = _csv_options(options)
    found = scanned(archives_in(spark, folder), parser["quotechar"]).collect()
    members = (
        Member(r["path"], r["member"], tuple(next(csv.reader([r["header"]], **parser), ())), r["problem"]) for r in found
    )
    return sorted(members, key=lambda m: (m.path, m.name or ""))


def rejected_files(members: Iterable[Member]) -> list[tuple[str, str]]:
    """``(file, reason)`` of archives and members that cannot be read."""
    return [(f"{_base(m.path)}/{m.name}" if m.name else _base(m.path), m.problem) for m in members if m.problem]


def read_folder(
    spark: SparkSession,
    folder: str,
    pattern: str = "*",
    recursive: bool = False,
    on_damage: str = "skip",
    members: Sequence[Member] | None = None,
    wanted: Callable[[str], bool] = lambda name: True,
    **options,
) -> DataFrame | None:
    """Delimited files of a folder, plain or in zip archives, as one frame; None if there are none.

    A file that lies there both plain and in an archive is read from the archive, and one that several archives hold
    from the last by name. A damaged member or archive is left out whole, see :func:`rejected_files`, or with
    ``on_damage='fail'`` stops the read; a plain file that cannot be read always does. ``wanted`` chooses among names.
    """
    if on_damage not in ("skip", "fail"):
        raise ValueError(f"on_damage {on_damage!r}: use 'skip' or 'fail'")
    members = scan_archives(spark, folder, **options) if members is None else members
    damaged = rejected_files(members)
    if damaged and on_damage == "fail":
        raise ValueError(f"cannot be read: {damaged}")
    for file, reason in damaged:
        log.warning("left out %s: %s", file, reason)
    zipped = [m for m in members if not m.problem and fnmatchcase(m.name, pattern) and wanted(m.name)]
    taken_from = {m.name: m.path for m in zipped}
    paths = [p for p in list_files(spark, folder, pattern, recursive) if _logical(p).endswith(".csv")]
    plain = sorted({f for p in paths if _base(f := _logical(p)) not in taken_from and wanted(_base(f))})
    frames = [read_files(spark, plain, **options) if plain else None]
    if zipped:
        headers = {(m.path, m.name): m.header for m in zipped if m.header and taken_from[m.name] == m.path}
        parser = _csv_options(options)
        how = {"sep": parser["delimiter"], "quote": parser["quotechar"], "escape": '"'}
        frames.append(read_members(archives_in(spark, folder), headers, how, parser["quotechar"]) if headers else None)
    frames = [f for f in frames if f is not None]
    return union_outer(frames) if frames else None


def file_headers(
    spark: SparkSession, folder: str, pattern: str = "*", members: Sequence[Member] | None = None, **options
) -> DataFrame:
    """``(source_file, batch_day, position, written, column_name)``: every header cell of a folder's files, positions from 0.

    Files are those that :func:`read_folder` reads, plain or archived. Their first lines are read in one job; the driver
    holds a header per file.
    """
    members = scan_archives(spark, folder, **options) if members is None else members
    headers = {m.name: m.header for m in members if not m.problem and m.header and fnmatchcase(m.name, pattern)}
    archived = set(headers)
    plain = sorted({f for p in list_files(spark, folder, pattern) if (f := _logical(p)).endswith(".csv")})
    for columns, group in (_headers(spark, plain, options) if plain else {}).items():
        headers.update({name: columns for p in group if (name := _base(_logical(p))) not in archived})
    cells = [(n, day_of(n), i, c, snake_case(c)) for n, columns in sorted(headers.items()) for i, c in enumerate(columns)]
    return spark.createDataFrame(cells, "source_file string, batch_day int, position int, written string, column_name string")


def batch_day(source_file: Column) -> Column:
    """The day number in a file name, null without one."""
    return F.regexp_extract(source_file, DAY_OF_FILE, 1).try_cast("int")


def day_of(name: str) -> int | None:
    """The same for a name on the driver."""
    found = re.search(DAY_OF_FILE, name)
    return int(found.group(1)) if found else None


def find_days(spark: SparkSession, folder: str, members: Sequence[Member] | None = None) -> list[int]:
    """Days that the files of a folder belong to, in ascending order."""
    members = scan_archives(spark, folder) if members is None else members
    names = [_base(_logical(p)) for p in list_files(spark, folder, "*_day*.csv")] + [m.name for m in members if m.name and not m.problem]
    return sorted({d for n in names if "_day" in n and (d := day_of(n)) is not None})


def read_day(spark: SparkSession, folder: str, day: int, **options) -> DataFrame | None:
    """The files of one day, whatever way its number is written."""
    return read_folder(spark, folder, "*_day*.csv", wanted=lambda name: day_of(name) == day, **options)
