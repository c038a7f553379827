"""CSV files read as text columns that are bound by header name.

Spark binds the columns of several CSV files by position.  Files whose headers
differ are therefore read in one scan per distinct header and united by name.  Headers
are looked up by tasks that read the first bytes of each file only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from monthfusion.functions import quoted
from monthfusion.sources.paths import literal_path, plain_uri
from monthfusion.sources.quoted import SPLIT, QuotedBreaks
from monthfusion.sources.shipping import ship_package
from monthfusion.sources.store import blocks, reachable

MALFORMED = "_malformed_record"
FILE_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
SCAN_ERRORS = (PySparkException, Py4JJavaError)


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file.

    Spark takes only the first line.  It skips a byte order mark, names blank
    cells by position and numbers repeated names.
    """
    return tuple(spark.read.option("header", "true").csv(literal_path(path)).columns)


#: Bytes of a file that are read at once to find its first line.
HEAD = 1 << 12
_HEADS = "path string, line string, n_bytes long"


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, lines, sizes = batch.column("path").to_pylist(), [], []
        for path in paths:
            data, line, n = b"", None, 0
            for block in blocks(path, size=HEAD):
                n += len(block)
                *whole, data = re.split(b"\r\n|\n|\r", data + block)
                line = next((x for x in whole if x.strip(b" ")), None)
                if line is not None:
                    break
            if line is None and data.strip(b" "):
                line = data
            lines.append(None if line is None else line.decode(errors="replace"))
            sizes.append(n)
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(lines, pa.string()), pa.array(sizes, pa.int64())], names=["path", "line", "n_bytes"])


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, line, n_bytes): the first line of each file that is not blank, NULL without
    any, and how many bytes were read for it."""
    ship_package(spark)
    tasks = min(len(paths), 4 * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(tasks, 1)).mapInArrow(_heads, _HEADS)


def _first_lines_of_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The same for files that only Spark's readers can open: they read all lines."""
    lines = spark.read.text([literal_path(p) for p in paths]).selectExpr(
        "value", "_metadata.file_path AS path", "_metadata.file_block_start AS start", "monotonically_increasing_id() AS place"
    )
    return lines.where("start = 0 AND trim(value) != ''").groupBy("path").agg(F.min_by("value", "place").alias("line"))


def headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header; files without any line have the header ``()``.

    One job takes the first line of every file; column names are then looked up
    once for each distinct line.
    """
    if reachable(paths[0]):
        line = {r.path: r.line for r in first_lines(spark, paths).collect()}
    else:
        found = {plain_uri(unquote(r.path)): r.line for r in _first_lines_of_text(spark, paths).collect()}
        line = {p: found.get(plain_uri(p if ":" in p else f"file:{p}")) for p in paths}
    names: dict[str | None, tuple[str, ...]] = {None: ()}
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        found = line[path]
        if found not in names:
            names[found] = header(spark, path)
        groups.setdefault(names[found], []).append(path)
    return groups


def scan(
    spark: SparkSession, names: tuple[str, ...], paths: list[str], strict: bool, by_file: bool = False, numbers: Iterable[str] = ()
) -> DataFrame:
    """Text columns of files that share a header, with malformed lines and lineage.

    A line with too few or too many cells is kept whole in the malformed column
    too.  ``strict`` makes the scan fail on a file with another header.  ``by_file`` has
    one task read a file, so that cells may hold line breaks.  Columns in ``numbers`` are
    read as double; a line with other text there is malformed.
    """
    fields = [StructField(n, DoubleType() if n in numbers else StringType()) for n in (*names, MALFORMED)]
    reader = spark.read.schema(StructType(fields)).option("header", "true")
    reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    reader = reader.option("enforceSchema", str(not strict).lower()).option("multiLine", str(by_file).lower())
    return reader.csv([literal_path(p) for p in paths]).selectExpr(
        *(quoted(n) for n in (*names, MALFORMED)),
        "_metadata.file_path AS source_file",
        "_metadata.file_size AS source_file_size",
        "_metadata.file_modification_time AS source_modification_time",
    )


def same_name(names: Iterable[str], name: str) -> str | None:
    """The member of ``names`` equal to ``name`` but for case."""
    return next((n for n in names if n.lower() == name.lower()), None)


def unite(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_groups(spark: SparkSession, groups: dict[tuple[str, ...], list[str]], breaks: QuotedBreaks | None = None) -> DataFrame:
    """All files, each group by its header; quoted cells may hold line breaks."""
    breaks = breaks or QuotedBreaks(spark, [p for paths in groups.values() for p in paths])
    frames = []
    for names, paths in groups.items():
        kinds: dict[str | None, list[str]] = {}
        for p in paths:
            kinds.setdefault(breaks.kind_of(p), []).append(p)
        for kind, some in kinds.items():
            split = kind == SPLIT
            frames.append(breaks.records(names, some, MALFORMED) if split else scan(spark, names, some, strict=False, by_file=kind is not None))
    return unite(frames)


def scan_numbers(spark: SparkSession, groups: dict[tuple[str, ...], list[str]], breaks: QuotedBreaks, numbers: Iterable[str]) -> DataFrame | None:
    """All files with some columns read as double; None if a file may spell numbers in ways
    that only a look at the text can refuse, or has line breaks within cells."""
    if not all(breaks.plain_numbers(p) for paths in groups.values() for p in paths):
        return None
    return unite([scan(spark, names, paths, strict=False, numbers=numbers) for names, paths in groups.items()])


def file_paths(spark: SparkSession, path: str, pattern: str | None = None) -> list[str]:
    """Names of the files in a folder, or of one file; empty files are files too.

    Spark lists them, and leaves out names that begin with ``_`` or ``.``.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        listing = listing.option("pathGlobFilter", pattern)
    try:
        found = sorted(unquote(p) for p in listing.load(path).inputFiles())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = []
    if not found:
        raise FileNotFoundError(path)
    return found


def read_text(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """All CSV files of a folder (or one file) as text columns."""
    groups = headers(spark, file_paths(spark, path, pattern))
    groups.pop((), None)  # without a header there are no rows
    if not groups:
        raise FileNotFoundError(f"no CSV header in {path}")
    return scan_groups(spark, groups)
