"""Tables replaced as a whole, and only by data that passes its rules."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from monthfusion.contracts import KEY
from monthfusion.functions import quoted
from monthfusion.operators.expectations import (
    Expectation,
    ExpectationFailed,
    failure_counts,
)
from monthfusion.sources.paths import path_exists, sql_text

_LOG = "version bigint, row_count bigint, comment string, published_at string"
EXAMPLES = 5


class PublishedTable:
    """A Parquet table in versioned folders with a log naming the current one.

    An update is written to a folder of its own while its rules are counted in
    the same job.  Readers see it only once a row for it is appended to the log,
    so a refused or interrupted update leaves the earlier version in place.
    Updates of one table must not run at the same time.
    """

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark = spark
        self.name = name
        self.path = f"{root.rstrip('/')}/{name}"
        self._log_path = f"{self.path}/_published"

    def versions(self) -> DataFrame:
        """One row per published version."""
        if path_exists(self.spark, self._log_path):
            return self.spark.read.schema(_LOG).json(self._log_path)
        return self.spark.createDataFrame([], _LOG)

    def _version_path(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def current_version(self) -> int | None:
        return self.versions().agg(F.max("version")).first()[0]

    def comment(self) -> str | None:
        return self.versions().agg(F.max_by("comment", "version")).first()[0]

    def read(self) -> DataFrame:
        """The current version."""
        version = self.current_version()
        if version is None:
            raise LookupError(f"{self.name} has no published version")
        return self.spark.read.parquet(self._version_path(version))

    def publish(
        self, df: DataFrame, expectations: list[Expectation] = (), comment: str | None = None
    ) -> int:
        """Write, check and publish; returns the version number."""
        version = (self.current_version() or 0) + 1
        staged = self._version_path(version)
        seen = Observation(f"{self.name}-{version}")
        counts = [F.count(F.lit(1)).alias("row_count"), *failure_counts(expectations)]
        df.observe(seen, *counts).write.mode("overwrite").parquet(staged)

        found = seen.get
        failed = {e.name: found[e.name] for e in expectations if found[e.name]}
        if failed:
            data = self.spark.read.parquet(staged)
            broken = [e for e in expectations if e.name in failed]
            raise ExpectationFailed(self.name, failed, {e.name: _examples(data, e) for e in broken})

        entry = (version, found["row_count"], comment, datetime.now(timezone.utc).isoformat())
        log = self.spark.createDataFrame([entry], _LOG)
        log.coalesce(1).write.mode("append").json(self._log_path)
        return version

    def register(self, view: str, column_comments: dict[str, str] | None = None) -> None:
        """Show the current version in the session catalog, with its comment and columns'."""
        target = ".".join(f"`{part}`" for part in view.split("."))
        path = self._version_path(self.current_version())
        told = column_comments or {}
        columns = ", ".join(quoted(c) + (f" COMMENT {sql_text(told[c])}" if c in told else "") for c in self.read().columns)
        comment = sql_text(self.comment() or "")
        self.spark.sql(f"CREATE OR REPLACE VIEW {target} ({columns}) COMMENT {comment} AS SELECT * FROM parquet.`{path}`")


def _examples(data: DataFrame, rule: Expectation) -> list[str]:
    keys = [c for c in KEY if c in data.columns]
    rows = data.where(rule.failed).select(*keys).limit(EXAMPLES).collect()
    return ["/".join(str(v) for v in row) for row in rows]
