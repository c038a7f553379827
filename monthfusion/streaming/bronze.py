"""Append-only bronze tables fed from folders of CSV files.

The stream itself is a stream of *file names*: the file source's checkpoint
remembers which files were taken, so each is loaded once.  Every micro-batch of
files is then read with Spark's CSV reader and written to a folder of its own.
Loading a batch again after a lost driver overwrites that folder with the same
rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from monthfusion.contracts import SourceContract
from monthfusion.functions import literal, quoted
from monthfusion.functions.numbers import cast_text
from monthfusion.sources.csv_files import (
    FILE_LISTING,
    MALFORMED,
    SCAN_ERRORS,
    file_paths,
    header,
    headers,
    literal_path,
    plain_uri,
    same_name,
    scan,
    scan_groups,
)
from monthfusion.sources.paths import holds_data, numbered_folders, path_exists, sql_text
from monthfusion.sources.quoted import QuotedBreaks

RESCUED = "_rescued_data"
LINEAGE = (
    "source_type string, source_file string, source_file_size bigint, "
    "source_modification_time timestamp, ingested_at timestamp"
)
_COLUMN_LOG = "position int, column_name string, data_type string"
_FILES = "path string, length bigint, modification_time timestamp, batch_id bigint"
NO_AGE_LIMIT = "36500d"
_WIDER = ("int", "bigint", "double")
_RESERVED = {
    RESCUED,
    MALFORMED,
    "source_type",
    "source_file",
    "source_file_size",
    "source_modification_time",
    "ingested_at",
    "batch_id",
}


@dataclass(frozen=True)
class Landing:
    """A folder of CSV files holding one source."""

    name: str
    path: str
    pinned: dict[str, str] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)
    pattern: str | None = None
    files_per_batch: int = 1000

    @classmethod
    def of(cls, source: SourceContract, path: str, **options) -> "Landing":
        return cls(source.name, path, source.pinned_types, dict(source.renames), **options)


class BronzeTable:
    """Batches in folders, and a log of the columns seen so far."""

    def __init__(self, spark: SparkSession, root: str, landing: Landing):
        self.spark = spark
        self.landing = landing
        self.path = f"{root.rstrip('/')}/bronze_{landing.name}_source"
        self._columns_path = f"{self.path}/_columns"
        self._files_path = f"{self.path}/_files"
        self.checkpoint = f"{self.path}/_checkpoint"

    # -- schema -----------------------------------------------------------

    def tracked(self) -> dict[str, str]:
        """Type of every raw column seen so far, in order of appearance.

        A column keeps the type it was first given, by all files that lay in the
        folder when the first batch with that column was loaded.
        """
        if not path_exists(self.spark, self._columns_path):
            return {}
        rows = self.spark.read.schema(_COLUMN_LOG).json(self._columns_path).orderBy("position").collect()
        return {r.column_name: r.data_type for r in rows}

    def _track(self, known: dict[str, str], new: dict[str, str]) -> None:
        if new:
            rows = [(len(known) + i, c, t) for i, (c, t) in enumerate(new.items())]
            log = self.spark.createDataFrame(rows, _COLUMN_LOG)
            log.coalesce(1).write.mode("append").json(self._columns_path)

    def column_types(self) -> DataFrame:
        """Rows (column_name, data_type) of the tracked schema."""
        rows = list(self.tracked().items())
        return self.spark.createDataFrame(rows, "column_name string, data_type string")

    def schema(self, types: dict[str, str] | None = None) -> StructType:
        """Raw columns, rescued data, renamed columns, lineage."""
        raw = types or self.tracked() or dict(self.landing.pinned)
        renamed = {old: new for old, new in self.landing.renames.items() if old in raw}
        fields = [f"`{c}` {t}" for c, t in raw.items() if c not in renamed]
        fields.append(f"{RESCUED} string")
        fields += [f"`{new}` {raw[old]}" for old, new in renamed.items()]
        return StructType.fromDDL(", ".join([*fields, LINEAGE]))

    # -- rows -------------------------------------------------------------

    def read(self) -> DataFrame:
        """All rows.

        The tracked schema is applied as it is, so no file is opened to learn
        columns that were added later.
        """
        schema = self.schema()
        if not holds_data(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path).selectExpr(*_names(schema))

    def batches(self) -> list[int]:
        """Numbers of the batches that were written."""
        return numbered_folders(self.spark, self.path, "batch_id")

    def rows_after(self, batch_id: int) -> DataFrame:
        """The rows of later batches; files of others are not opened."""
        schema = self.schema()
        if not holds_data(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        with_batch = StructType([*schema.fields, StructField("batch_id", LongType())])
        rows = self.spark.read.schema(with_batch).parquet(self.path)
        return rows.where(f"batch_id > {batch_id}").selectExpr(*_names(schema))

    # -- files ------------------------------------------------------------

    def log_files(self, listing: DataFrame, batch_id: int) -> None:
        """Note the files of a batch as they were when it was loaded."""
        rows = listing.selectExpr("path", "length", "modificationTime AS modification_time")
        rows.write.mode("overwrite").parquet(f"{self._files_path}/batch_id={batch_id}")

    def loaded_files(self) -> DataFrame:
        """(path, length, modification_time, batch_id) of every file loaded so far."""
        if not holds_data(self.spark, self._files_path):
            return self.spark.createDataFrame([], _FILES)
        return self.spark.read.schema(_FILES).parquet(self._files_path)

    def changed_files(self) -> DataFrame:
        """Files that are not as they were when they were loaded, and those gone.

        They are not loaded again, as their rows are in the table.  Spark joins the
        folder's listing with the noted files; ``now_length`` is NULL for a file that is gone.
        """
        now = files_of(self.spark, self.landing).selectExpr("path", "length AS now_length", "modificationTime AS now_time")
        both = self.loaded_files().join(now, "path", "left")
        return both.where("NOT (length <=> now_length AND modification_time <=> now_time)")

    @property
    def comment(self) -> str:
        return f"Raw {self.landing.name} observations as delivered, with rescued data and lineage"

    def register(self, view: str) -> None:
        """Show the table, with its comment, in the session catalog."""
        schema = self.schema()
        target = ".".join(quoted(part) for part in view.split("."))
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {target} COMMENT {sql_text(self.comment)} AS"
            f" SELECT {', '.join(_names(schema))} FROM parquet.`{self.path}`"
        )

    def _write(self, text: DataFrame, types: dict[str, str], batch_id: int) -> None:
        rows = typed(text, types, self.landing)
        folder = f"{self.path}/batch_id={batch_id}"
        rows.selectExpr(*_names(self.schema(types))).write.mode("overwrite").parquet(folder)

    # -- loading ----------------------------------------------------------

    def load(self, paths: list[str], batch_id: int) -> None:
        """Load one batch of files; loading the same batch again replaces it.

        Files mostly share one header of known columns.  Such a batch is read
        with the header of its first file, and Spark checks the others as it
        opens them.  Only if that fails, or a column is new, or quoted cells hold line
        breaks, is the header of every file looked up.
        """
        known = self.tracked()
        breaks = QuotedBreaks(self.spark, paths)
        first = header(self.spark, paths[0])
        groups = None
        if first and not breaks.kind and all(same_name(known, n) for n in first):
            try:
                text = scan(self.spark, first, paths, strict=True)
                return self._write(text, known, batch_id)
            except SCAN_ERRORS:
                groups = headers(self.spark, paths)
                if groups == {first: paths}:
                    raise
        groups = groups or headers(self.spark, paths)
        groups.pop((), None)  # a file without a header has no rows
        if groups:
            new = self._new_columns(self._lying(groups, known, paths), known, multi_line=bool(breaks.kind))
            self._track(known, new)
            self._write(scan_groups(self.spark, groups, breaks), {**known, **new}, batch_id)

    def _lying(
        self, groups: dict[tuple[str, ...], list[str]], known: dict[str, str], paths: list[str]
    ) -> dict[tuple[str, ...], list[str]]:
        """Files that say how new columns are typed: all in the folder, not one batch's.

        Else types would depend on the number of files in a batch.  Files loaded
        before have none of the new columns.
        """
        typed_by = known or self.landing.pinned
        if all(same_name(typed_by, n) for names in groups for n in names):
            return groups
        every = [*file_paths(self.spark, self.landing.path, self.landing.pattern), *paths]
        found = headers(self.spark, sorted({plain_uri(p): p for p in every}.values(), key=plain_uri))
        found.pop((), None)
        return found

    def _new_columns(
        self, groups: dict[tuple[str, ...], list[str]], known: dict[str, str], multi_line: bool = False
    ) -> dict[str, str]:
        """Columns to add, typed by contract or by Spark's own inference."""
        pinned = {} if known else dict(self.landing.pinned)
        new: dict[str, str] = {}
        for names, paths in groups.items():
            taken = [n for n in names if n.lower() in _RESERVED]
            if taken:
                raise ValueError(f"column names {taken} are reserved; found in {paths[0]}")
            unknown = {n for n in names if not same_name((*known, *pinned), n)}
            if not unknown:
                continue
            reader = self.spark.read.option("header", "true").option("inferSchema", "true").option("multiLine", str(multi_line).lower())
            found = reader.csv([literal_path(p) for p in paths]).schema
            for name, field_ in zip(names, found.fields):
                if name in unknown:
                    held = same_name(new, name) or name
                    type_ = field_.dataType.simpleString()
                    new[held] = _common(new.get(held, type_), type_)
        return {**pinned, **new}


def _names(schema: StructType) -> list[str]:
    return [quoted(f.name) for f in schema.fields]


def _common(a: str, b: str) -> str:
    """Type that holds the values of both."""
    if a == b:
        return a
    if a in _WIDER and b in _WIDER:
        return max(a, b, key=_WIDER.index)
    return "string"


def typed(text: DataFrame, types: dict[str, str], landing: Landing) -> DataFrame:
    """Cast text columns to the tracked types, keeping what does not fit.

    The rescued-data column holds, as JSON, the original text of every value
    that could not be cast, a malformed line as a whole, and the file path.
    """
    present = tuple(text.columns)
    columns: dict[str, str] = {}
    misfits: list[str] = []
    for name, type_ in types.items():
        arrived = same_name(present, name)
        if arrived is None:
            columns[name] = f"CAST(NULL AS {type_})"
            continue
        columns[name] = cast_text(quoted(arrived), type_)
        if type_ != "string":
            unfit = f"CASE WHEN {columns[name]} IS NULL THEN {quoted(arrived)} END"
            misfits.append(_entry(name, unfit))
    misfits.append(_entry(MALFORMED, MALFORMED))
    kept = f"filter(array({', '.join(misfits)}), e -> e.value IS NOT NULL)"
    record = f"to_json(map_from_entries(concat({kept}, array({_entry('_file_path', 'source_file')}))))"

    return text.selectExpr(
        *(f"{v} AS {quoted(landing.renames.get(n, n))}" for n, v in columns.items()),
        f"CASE WHEN size({kept}) > 0 THEN {record} END AS {RESCUED}",
        f"{literal(landing.name)} AS source_type",
        "source_file",
        "source_file_size",
        "source_modification_time",
        "current_timestamp() AS ingested_at",
    )


def _entry(name: str, value: str) -> str:
    return f"named_struct('name', {literal(name)}, 'value', {value})"


def files_of(spark: SparkSession, landing: Landing) -> DataFrame:
    """The files in a landing folder now, without their content."""
    reader = spark.read.format("binaryFile").schema(FILE_LISTING).option("recursiveFileLookup", "true")
    if landing.pattern:
        reader = reader.option("pathGlobFilter", landing.pattern)
    return reader.load(literal_path(landing.path)).select("path", "length", "modificationTime")


def ingest(table: BronzeTable) -> StreamingQuery:
    """Start loading the files that were not loaded before, then stop.

    ``files_per_batch`` bounds what a batch hands to the driver: file names.
    """
    landing = table.landing
    # By default the file source passes over files a week older than the newest it
    # has seen; a backfill with kept times must be loaded too.
    reader = (
        table.spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", NO_AGE_LIMIT)
        .option("maxFilesPerTrigger", landing.files_per_batch)
    )
    if landing.pattern:
        reader = reader.option("pathGlobFilter", landing.pattern)
    files = reader.load(landing.path).select("path", "length", "modificationTime")

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.select("path").collect())
        if paths:
            table.load(paths, batch_id)
            table.log_files(batch, batch_id)

    return (
        files.writeStream.queryName(f"bronze_{landing.name}")
        .foreachBatch(load)
        .option("checkpointLocation", table.checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_ingest(tables: list[BronzeTable]) -> None:
    """Load all landing folders side by side and wait for the end."""
    running = [ingest(t) for t in tables]
    failures = []
    for query in running:
        try:
            query.awaitTermination()
        except Exception as e:  # the other queries must end too
            failures.append(e)
    if failures:
        raise failures[0]
