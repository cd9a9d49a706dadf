"""Timetable zips: the lines of the wanted members, parsed like the unpacked files.

An archive is read once, for all its tables.  The task that reads it only cuts out the members, still
packed; each member is then unpacked by a task of its own.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
import zlib
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline import scratch
from tramline.functions.text import blank_to_null, missing_to_null
from tramline.sources.timetable import SUFFIX, finished

MEMBERS_SCHEMA = "archive string, member string, part int, deflated boolean, bytes binary"
LINES_SCHEMA = "archive string, table_name string, header string, line string"
BATCH_LINES = 10_000
BLOCK_CHARS = 1 << 16
# Packed bytes of one row.
PART_BYTES = 1 << 22
# Length of a member's own header without its name and extra field, and where their lengths are.
LOCAL_HEADER, LENGTHS_AT = 30, 26
# No quoted field is cut: the parser's own limit is switched off.
CSV_OPTIONS = {"escape": '"', "maxCharsPerColumn": "-1"}
_QUOTE_OPENS = re.compile(r'(?:^|,)"')


def read_archives(spark: SparkSession, pattern: str) -> DataFrame:
    """Archives as (path, content), one row per file.

    The file source takes archives below 2 GB.
    """
    return spark.read.format("binaryFile").load(pattern).select("path", "content")


def _is_open(line: str, is_open: bool) -> bool:
    """Whether a quoted field is open after the line; two quotes inside one are a character."""
    at = 0
    while True:
        if is_open:
            at = line.find('"', at)
            if at < 0:
                return True
            is_open = line.startswith('""', at)
            at += 1 + is_open
        else:
            opening = _QUOTE_OPENS.search(line, at)
            if opening is None:
                return False
            is_open, at = True, opening.end()


def _records(lines: Iterator[str]) -> Iterator[str]:
    """Physical lines, joined while a quoted field is open."""
    parts: list[str] = []
    for line in lines:
        is_open = _is_open(line, bool(parts))
        parts.append(line)
        if not is_open:
            yield "\n".join(parts)
            parts = []
    if parts:
        yield "\n".join(parts)


def table_of(member: str) -> str:
    return member.rsplit("/", 1)[-1].removesuffix(SUFFIX)


def _packed(content: bytes, member: zipfile.ZipInfo) -> tuple[bool, bytes]:
    """Whether the bytes of a member are deflated, and the bytes as they lie in the archive."""
    start = member.header_offset
    name = int.from_bytes(content[start + LENGTHS_AT : start + LENGTHS_AT + 2], "little")
    extra = int.from_bytes(content[start + LENGTHS_AT + 2 : start + LENGTHS_AT + 4], "little")
    at = start + LOCAL_HEADER + name + extra
    return member.compress_type == zipfile.ZIP_DEFLATED, content[at : at + member.compress_size]


def archive_members(archives: DataFrame, tables: Sequence[str] | None = None) -> DataFrame:
    """(archive, member, part, deflated, bytes): text tables in parts, still packed."""
    wanted = None if tables is None else frozenset(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, value in zip(*batch.columns, strict=True):
                content = value.as_py()
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.infolist():
                        name = member.filename
                        if not name.endswith(SUFFIX):
                            continue
                        if wanted is not None and table_of(name) not in wanted:
                            continue
                        if member.compress_type in (zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED):
                            deflated, packed = _packed(content, member)
                        else:
                            deflated, packed = False, archive.read(member)
                        for part, at in enumerate(range(0, max(len(packed), 1), PART_BYTES)):
                            row = (path.as_py(), name, part, deflated, packed[at : at + PART_BYTES])
                            types = (pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.binary())
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([v], t) for v, t in zip(row, types, strict=True)],
                                names=["archive", "member", "part", "deflated", "bytes"],
                            )

    return archives.select("path", "content").mapInArrow(run, MEMBERS_SCHEMA)


class _Unpacked(io.RawIOBase):
    """The text of a member out of its packed parts, a little at a time."""

    def __init__(self, parts: Iterator[tuple[bool, bytes]]):
        self.parts = parts
        self.inflate = zlib.decompressobj(-zlib.MAX_WBITS)
        self.packed, self.plain = b"", b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.plain:
            if self.packed:
                self.plain = self.inflate.decompress(self.packed, len(buffer))
                self.packed = self.inflate.unconsumed_tail
                continue
            deflated, data = next(self.parts, (None, b""))
            if deflated is None:
                self.plain = self.inflate.flush()
                if not self.plain:
                    return 0
            elif deflated:
                self.packed = data
            else:
                self.plain = data
        size = min(len(buffer), len(self.plain))
        buffer[:size] = self.plain[:size]
        self.plain = self.plain[size:]
        return size


def _lines(text: io.TextIOBase) -> Iterator[str]:
    """Lines without their ends, cut out of blocks."""
    parts: list[str] = []
    while block := text.read(BLOCK_CHARS):
        first, *more = block.split("\n")
        parts.append(first)
        if more:
            yield "".join(parts)
            yield from more[:-1]
            parts = more[-1:]
    if any(parts):
        yield "".join(parts)


def _batch(key: tuple[str, str, str], lines: list[str | None]) -> pa.RecordBatch:
    names = [part.split()[0] for part in LINES_SCHEMA.split(", ")]
    same = [pa.repeat(pa.scalar(value, pa.string()), len(lines)) for value in key]
    return pa.RecordBatch.from_arrays([*same, pa.array(lines, pa.string())], names=names)


def expand_archives(
    archives: DataFrame, tables: Sequence[str] | None = None, multiline: bool = False
) -> DataFrame:
    """(path, content) to one row per data line of the wanted tables, text as it stands.

    Members are dealt to tasks of their own and leave in batches of lines, never whole;
    blank lines are none.  Each member also gives one row without a line, for its header.
    `multiline` keeps line breaks inside quoted fields in one row.
    """

    def parts_of(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                archive, member, _, deflated, data = (v.as_py() for v in row)
                yield (archive, member), (deflated, data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (archive, member), rows in groupby(parts_of(batches), key=lambda row: row[0]):
            raw = io.BufferedReader(_Unpacked(part for _, part in rows), 1 << 16)
            lines = _lines(io.TextIOWrapper(raw, encoding="utf-8-sig"))
            lines = _records(lines) if multiline else lines
            key = archive, table_of(member), next(lines, "")
            yield _batch(key, [None])
            filled = (line for line in lines if line and not line.isspace())
            while pending := list(islice(filled, BATCH_LINES)):
                yield _batch(key, pending)

    return (
        archive_members(archives, tables)
        .repartition("archive", "member")
        .sortWithinPartitions("archive", "member", "part")
        .mapInArrow(run, LINES_SCHEMA)
    )


def stored_lines(archives: DataFrame, multiline: bool = False) -> DataFrame:
    """Lines of all tables, written once by table name: each table reads its own folder."""
    spark = archives.sparkSession
    folder = scratch.new_folder(spark, "archive-lines")
    lines = expand_archives(archives, None, multiline)
    lines.write.partitionBy("table_name").parquet(folder)
    # An archive without tables leaves no folder to find the name in.
    return spark.read.schema(lines.schema).parquet(folder)


def archive_table(
    lines: DataFrame, table: str, headers: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """One table out of expanded lines, by header name, every column text.

    `headers` are the header lines that occur; where they differ, a column that a file
    lacks is NULL.  Empty text and missing marks are NULL.  `columns` picks some.
    """
    own = lines.filter((F.col("table_name") == table) & F.col("line").isNotNull())
    parts = []
    for header in dict.fromkeys(headers):
        names = next(csv.reader([header]))
        ddl = ", ".join("`" + name.replace("`", "``") + "` string" for name in names)
        fields = F.from_csv("line", ddl, CSV_OPTIONS)
        parts.append(
            own.filter(F.col("header") == header)
            .select("archive", fields.alias("fields"))
            .select("archive", *(blank_to_null(F.col(f"fields.`{n}`")).alias(n) for n in names))
        )
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    kept = missing_to_null(united)
    if columns is None:
        return kept
    absent = {c: F.lit(None).cast("string") for c in columns if c not in kept.columns}
    return kept.withColumns(absent).select("archive", *columns)


def load_archives(
    spark: SparkSession,
    pattern: str,
    types: Mapping[str, T.StructType] | None = None,
    multiline: bool = False,
) -> dict[str, DataFrame]:
    """Every text table of the zips a glob names, as `load_timetable` gives the files of a folder.

    All tables come from one pass over the archives.  `multiline` takes line breaks inside
    quoted fields.
    """
    return archive_tables(read_archives(spark, pattern), types, multiline)


def archive_tables(
    archives: DataFrame,
    types: Mapping[str, T.StructType] | None = None,
    multiline: bool = False,
) -> dict[str, DataFrame]:
    """Every text table of (path, content) rows, by name."""
    lines = stored_lines(archives, multiline)
    # One row per distinct header of a table.
    found: dict[str, list[str]] = {}
    headers = lines.filter(F.col("line").isNull()).select("table_name", "header").distinct()
    for row in headers.collect():
        found.setdefault(row.table_name, []).append(row.header)
    return {
        name: finished(archive_table(lines, name, sorted(own)).drop("archive"), name, types)
        for name, own in sorted(found.items())
        if any(own)
    }
