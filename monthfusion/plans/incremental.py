"""Collapsed sources kept up to date from new bronze batches alone.

What a collapse must know of a key is small and can be merged: least and largest value
of every compared column, number of rows, last file, latest load.  It is kept as a table
with one row per key.  An update collapses the rows of batches that came since, merges
them with that table by key, and writes the next version of it; earlier batches are not
read again.  Bronze is append-only, so the result is that of collapsing all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.contracts import SourceContract
from monthfusion.operators.collapse import finished_parts, merged_parts, parts_by_file, parts_by_key
from monthfusion.sources.paths import path_exists
from monthfusion.streaming.bronze import BronzeTable

_LOG = "version bigint, last_batch bigint"


class CollapseState:
    """Versions of the table of one source, and a log that names them and the last
    batch that each one holds.

    A version counts once its row is in the log, so an interrupted update leaves the
    earlier one in place, and the next update writes the same version again.
    """

    def __init__(self, spark: SparkSession, root: str, bronze: BronzeTable, source: SourceContract):
        self.spark, self.bronze, self.source = spark, bronze, source
        self.path = f"{root.rstrip('/')}/state_{source.name}"
        self._log_path = f"{self.path}/_versions"

    def current(self) -> tuple[int, int]:
        """Version and last batch; (0, -1) before the first update."""
        if not path_exists(self.spark, self._log_path):
            return 0, -1
        row = self.spark.read.schema(_LOG).json(self._log_path).agg(F.max("version"), F.max("last_batch")).first()
        return row[0], row[1]

    def _read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={version}")

    def new_parts(self, last_batch: int, version: int) -> DataFrame:
        """Rows per key of batches after ``last_batch``, from a table of rows per key and file."""
        folder = f"{self.path}/parts={version}"
        parts_by_file(self.bronze.rows_after(last_batch), self.source).write.mode("overwrite").parquet(folder)
        return parts_by_key(self.spark.read.parquet(folder), self.source)

    def advance(self) -> int:
        """Take in the batches that came since; returns the version that holds all."""
        version, last = self.current()
        newest = max(self.bronze.batches(), default=-1)
        if version and newest <= last:
            return version
        new = self.new_parts(last, version + 1)
        rows = merged_parts(self._read(version), new, self.source) if version else new
        rows.write.mode("overwrite").parquet(f"{self.path}/v={version + 1}")
        log = self.spark.createDataFrame([(version + 1, newest)], _LOG)
        log.coalesce(1).write.mode("append").json(self._log_path)
        return version + 1

    def collapsed(self) -> DataFrame:
        """The source up to date, one row per key, as ``collapse`` gives it with ``gate``."""
        return finished_parts(self._read(self.advance()), self.source)
