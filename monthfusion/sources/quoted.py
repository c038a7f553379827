"""Line breaks within quoted cells of CSV files that many tasks read.

A reader that starts in the middle of a file cannot tell whether a line break ends a
record.  So byte ranges are looked at first, each for both cases, begun within quotes or
not: how many quotes it has, how many line breaks then are within quotes, and how many
quotes then open a cell that has begun before.  The quotes of the ranges before tell
which case holds.  Files without a line break within quotes are read as usual.  In others
each range gives the records that begin in it, read to their end, and Spark parses those.

A quote that is never closed makes one malformed record of the rest of its file.  Files
with quotes inside unquoted cells, and compressed ones, have no record borders that
quotes alone tell; if line breaks may be within quotes, one task reads such a file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthfusion.functions import literal, quoted
from monthfusion.sources.paths import literal_path, plain_uri
from monthfusion.sources.scratch import scratch_dir
from monthfusion.sources.shipping import ship_package
from monthfusion.sources.store import COMPRESSED, blocks, reachable

QUOTE, BREAK = ord('"'), ord("\n")
#: Bytes behind which a quote opens a cell, or stands for itself in one.
_BEFORE = np.zeros(256, bool)
_BEFORE[[ord(","), ord("\n"), ord("\r"), QUOTE]] = True
#: Bytes that may be part of a spelling of numbers that Spark's reader takes and contracts refuse:
#: control characters, and in a number's place ``d``, ``f`` (suffixes) and ``x`` (hexadecimal).
_CONTROL, _LETTER = 1, 2
_ODD = np.zeros(256, np.uint8)
_ODD[:32] = _CONTROL
_ODD[[ord("\t"), BREAK, ord("\r")]] = 0
_ODD[[ord(c) for c in "dDfFxX"]] = _LETTER
_IN_NUMBER = np.zeros(256, bool)
_IN_NUMBER[[ord(c) for c in "0123456789."]] = True
#: Files that Spark reads unpacked and the look as they are.
_PACKED = (".deflate", ".snappy")
BOM = "﻿".encode()
#: Bytes of a range.
RANGE = 1 << 25
#: How a file with line breaks within quotes is read.
SPLIT, WHOLE = "split", "whole"

_LOOK = "path string, start long, quotes long, inside_0 long, inside_1 long, stray_0 long, stray_1 long, odd long"


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _LOOK.split(", ")]
    for batch in batches:
        rows = []
        for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
            counts, before = np.zeros(6, np.int64), None
            # The byte before the range tells whether its first quote opens a cell.
            for data in blocks(path, max(start - 1, 0), end):
                if before is None:
                    mark = b"\n" if not start else b""  # stands for what precedes a file, and its byte order mark
                    data = mark + data.removeprefix(BOM) if mark else data
                    before, data = data[0], data[1:]
                part = np.frombuffer(data, np.uint8)
                quotes = np.flatnonzero(part == QUOTE)
                within = np.searchsorted(quotes, np.flatnonzero(part == BREAK)) & 1
                odds = np.flatnonzero(_ODD[part])
                letters = odds[_ODD[part[odds]] == _LETTER]
                spelled = _IN_NUMBER[np.where(letters > 0, part[letters - 1], before)]
                opens = ~_BEFORE[np.concatenate(([before], part[:-1]))[quotes]]
                odd = int(counts[0]) & 1
                seen = [len(quotes), (within != odd).sum(), (within == odd).sum(), opens[odd::2].sum(), opens[1 - odd :: 2].sum(), len(odds) - len(letters) + spelled.sum()]
                counts += np.array(seen)
                before = data[-1] if data else before
            rows.append((path, start, *counts.tolist()))
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)


def _ranges(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, start, end, length, lineage) of the byte ranges of all files."""
    files = spark.read.format("binaryFile").load([literal_path(p) for p in paths]).where("length > 0")
    packed = " OR ".join(f"endswith(path, '{x}')" for x in COMPRESSED)
    step = f"if({packed}, length, {RANGE}L)"
    rows = files.selectExpr(
        "path", "length", "_metadata.file_path AS source_file", "_metadata.file_size AS source_file_size",
        "_metadata.file_modification_time AS source_modification_time", f"explode(sequence(0L, length - 1, {step})) AS start", f"{step} AS step",
    )
    tasks = max(1, spark.sparkContext.defaultParallelism)
    return rows.selectExpr("*", "least(start + step, length) AS end").repartition(tasks, "path", "start")


class QuotedBreaks:
    """What a look at some files found; ``kind`` has the files that need more than lines."""

    def __init__(self, spark: SparkSession, paths: list[str]):
        self.spark = spark
        self.kind: dict[str, str] = {}
        self.odd: set[str] | None = None  # not known
        if not paths or not reachable(paths[0]):
            return
        ship_package(spark)
        self.folder = scratch_dir(spark, "quotes")
        _ranges(spark, paths).select("path", "start", "end").mapInArrow(_look, _LOOK).write.parquet(self.folder)
        files = self.looked_at().groupBy("path").agg(F.sum("inside").alias("inside"), F.sum("stray").alias("stray"), F.sum("quotes").alias("quotes"), F.sum("odd").alias("odd"))
        # Files with line breaks within quotes, of paths that the driver knows.
        found = files.selectExpr("*", "inside > 0 OR quotes % 2 = 1 AS torn").where("torn OR odd > 0").collect()
        self.kind = {plain_uri(r.path): WHOLE if r.stray or r.path.endswith(COMPRESSED) else SPLIT for r in found if r.torn}
        self.odd = {plain_uri(r.path) for r in found if r.odd}

    def kind_of(self, path: str) -> str | None:
        return self.kind.get(plain_uri(path))

    def plain_numbers(self, path: str) -> bool:
        """Whether Spark's reader takes no spelling of numbers in the lines of this file but decimal
        ones, blanks around them, and those that are not finite."""
        if self.odd is None or path.endswith(_PACKED):
            return False
        return plain_uri(path) not in self.odd and self.kind_of(path) is None

    def looked_at(self) -> DataFrame:
        """Ranges with ``open`` (1: it begins within quotes) and what then holds."""
        earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        rows = self.spark.read.schema(_LOOK).parquet(self.folder).withColumn("open", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
        return rows.selectExpr("path", "start", "open", "quotes", "if(open = 0, inside_0, inside_1) AS inside", "if(open = 0, stray_0, stray_1) AS stray", "odd")

    def records(self, names: tuple[str, ...], paths: list[str], malformed: str) -> DataFrame:
        """Records of files of the kind ``split``, as text columns ``names`` and ``malformed``,
        with lineage."""
        ranges = _ranges(self.spark, paths)
        opened = self.looked_at().select("path", "start", "open")
        found = ranges.join(opened, ["path", "start"]).select(*_RECORD_INPUT).mapInArrow(_records, _RECORDS)
        schema = ", ".join(f"{quoted(n)} string" for n in (*names, malformed))
        options = f"map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', {literal(malformed)})"
        parsed = found.selectExpr("*", f"from_csv(record, {literal(schema)}, {options}) AS cells")
        return parsed.selectExpr(
            *(f"CASE WHEN closed THEN cells.{quoted(n)} END AS {quoted(n)}" for n in names),
            f"CASE WHEN closed THEN cells.{quoted(malformed)} ELSE record END AS {quoted(malformed)}",
            "source_file",
            "source_file_size",
            "source_modification_time",
        )


_RECORD_INPUT = ["path", "start", "end", "length", "open", "source_file", "source_file_size", "source_modification_time"]
_RECORDS = "record string, closed boolean, source_file string, source_file_size long, source_modification_time timestamp"


def _borders(part: np.ndarray, opened: int) -> tuple[np.ndarray, int]:
    """Places of the line breaks that end a record, and whether quotes are open behind ``part``."""
    quotes = np.flatnonzero(part == QUOTE)
    breaks = np.flatnonzero(part == BREAK)
    return breaks[(np.searchsorted(quotes, breaks) & 1) == opened], (len(quotes) + opened) & 1


def range_records(path: str, start: int, end: int, length: int, opened: int) -> Iterator[tuple[bytes, bool]]:
    """Records that begin in a byte range, without the header, and whether their quotes close."""
    data = b"".join(blocks(path, max(start - 1, 0), end))
    first = start == 0
    before, data = (data[:1], data[1:]) if start else (b"\n", data)
    borders, still = _borders(np.frombuffer(data, np.uint8), opened)
    begins = borders + 1
    if first or (before == b"\n" and not opened):
        begins = np.concatenate(([0], begins))
    ends = borders[len(borders) - len(begins) + 1 :] if len(begins) else borders
    spans = list(zip(begins[: len(ends)].tolist(), ends.tolist(), strict=True))
    for a, b in spans:
        yield data[a:b], True
    if len(begins) > len(ends) and begins[-1] < len(data):
        tail = [data[begins[-1] :]]
        for more in blocks(path, end, length) if end < length else ():
            borders, behind = _borders(np.frombuffer(more, np.uint8), still)
            if len(borders):
                yield b"".join([*tail, more[: borders[0]]]), True
                return
            tail.append(more)
            still = behind
        yield b"".join(tail), not still


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, row in enumerate(batch.select(_RECORD_INPUT[:5]).to_pylist()):
            texts, closed = [], []
            header = row["start"] == 0
            size = 0

            def part() -> pa.RecordBatch:
                lineage = [pa.array([batch.column(c)[k].as_py()] * len(texts), batch.column(c).type) for c in _RECORD_INPUT[5:]]
                return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(closed), *lineage], names=[c.split()[0] for c in _RECORDS.split(", ")])

            for record, whole in range_records(row["path"], row["start"], row["end"], row["length"], row["open"]):
                text = record.decode(errors="replace").removesuffix("\r")
                if not text.strip():
                    continue  # a blank line is no record
                if header:
                    header = False
                    continue
                texts.append(text)
                closed.append(whole)
                size += len(record)
                if size > 1 << 23:
                    yield part()
                    texts, closed, size = [], [], 0
            if texts:
                yield part()
