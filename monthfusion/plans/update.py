"""The whole update: landing folders to the published fused table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from monthfusion.contracts import COUNTY_MONTH, FusionContract, SourceContract
from monthfusion.operators.collapse import distinct_value_max
from monthfusion.operators.expectations import (
    ExpectationFailed,
    gold_expectations,
    silver_expectations,
)
from monthfusion.operators.fuse import fuse
from monthfusion.plans.incremental import CollapseState
from monthfusion.sources.published import PublishedTable
from monthfusion.streaming.bronze import BronzeTable, Landing, run_ingest


@dataclass(frozen=True)
class Update:
    """Tables of one pipeline; ``run`` brings them up to date."""

    spark: SparkSession
    landing: dict[str, str]
    root: str
    contract: FusionContract = COUNTY_MONTH
    files_per_batch: int = 1000

    def bronze(self, name: str) -> BronzeTable:
        source = self.contract.source(name)
        landing = Landing.of(source, self.landing[name], files_per_batch=self.files_per_batch)
        return BronzeTable(self.spark, self.root, landing)

    def state(self, name: str) -> CollapseState:
        return CollapseState(self.spark, self.root, self.bronze(name), self.contract.source(name))

    def silver(self, name: str) -> PublishedTable:
        return PublishedTable(self.spark, self.root, f"silver_{name}")

    @property
    def gold(self) -> PublishedTable:
        return PublishedTable(self.spark, self.root, self.contract.gold_name)

    def run(self) -> DataFrame:
        """Load new files, bring every table up to date, return the fused one.

        Sources are collapsed from the batches that are new; the fused table is built
        from collapsed sources.

        A source that breaks its rules keeps its earlier silver version and
        stops the fused table from being rebuilt; the other sources are still
        published.
        """
        run_ingest([self.bronze(s.name) for s in self.contract.sources])
        with ThreadPoolExecutor(len(self.contract.sources)) as pool:
            refused = [e for e in pool.map(self._refused_silver, self.contract.sources) if e]
        if refused:
            raise refused[0]
        self._refresh_gold()
        return self.gold.read()

    def _refused_silver(self, source: SourceContract) -> ExpectationFailed | None:
        try:
            self._refresh_silver(source)
        except ExpectationFailed as e:
            return e
        return None

    def _refresh_silver(self, source: SourceContract) -> None:
        self.silver(source.name).publish(
            self.state(source.name).collapsed(),
            silver_expectations(source),
            comment=f"Validated {source.name} observations, one row per county and month",
        )

    def _refresh_gold(self) -> None:
        # Published silver has complete keys: its key rule refuses NULL parts.
        silver = {s.name: self.silver(s.name).read() for s in self.contract.sources}
        self.gold.publish(
            fuse(silver, self.contract, align="full"),
            gold_expectations(self.contract),
            comment="Activity and weather of all sources, one row per county and month",
        )

    def conflicting_keys(self, name: str) -> DataFrame:
        """Keys of a source that contradict themselves, with the exact count."""
        counts = distinct_value_max(self.bronze(name).read(), self.contract.source(name))
        return counts.where("distinct_value_max > 1")
