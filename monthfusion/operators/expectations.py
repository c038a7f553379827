"""Row rules that a dataset must satisfy before it is published."""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthfusion.contracts import FusionContract, SourceContract
from monthfusion.functions import literal, quoted


@dataclass(frozen=True)
class Expectation:
    """A named predicate, written as a SQL expression over one row.

    A row satisfies it only when the predicate is TRUE; NULL counts as failed.
    """

    name: str
    predicate: str

    @property
    def failed(self) -> str:
        return f"NOT coalesce({self.predicate}, false)"


class ExpectationFailed(Exception):
    """An update was refused; the published version is unchanged."""

    def __init__(self, dataset: str, failed: dict[str, int], examples: dict[str, list[str]]):
        self.dataset = dataset
        self.failed = failed
        self.examples = examples
        parts = [f"{r}: {n} rows, e.g. {', '.join(examples.get(r, []))}" for r, n in failed.items()]
        super().__init__(f"{dataset} violates {'; '.join(parts)}")


def _key_rule(name: str, years: tuple[int, int], months: tuple[int, int]) -> Expectation:
    return Expectation(
        name,
        f"year BETWEEN {years[0]} AND {years[1]}"
        f" AND month BETWEEN {months[0]} AND {months[1]}"
        " AND county IS NOT NULL",
    )


def silver_expectations(source: SourceContract) -> list[Expectation]:
    """Key in range, count not negative, key in agreement with itself."""
    return [
        _key_rule(f"valid_{source.name}_key", source.year_bounds, source.month_bounds),
        Expectation(f"valid_{source.name}_count", f"{source.count_column} >= 0"),
        Expectation(f"consistent_{source.name}_group", "distinct_value_max <= 1"),
    ]


def gold_expectations(contract: FusionContract) -> list[Expectation]:
    """Key in range, sources in agreement with each other."""
    agreements = [
        Expectation(f"consistent_cross_source_{a.name.removesuffix('_consistent')}", a.name)
        for a in contract.agreements
    ]
    return [_key_rule("valid_gold_key", contract.year_bounds, contract.month_bounds), *agreements]


def failure_counts(expectations: list[Expectation]) -> list[Column]:
    """Aggregates counting the failed rows of each rule, named after the rule."""
    return [F.expr(f"count_if({e.failed}) AS {quoted(e.name)}") for e in expectations]


def check(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """Rows (rule, failed_rows, total_rows); all rules share one aggregate."""
    counts = df.agg(F.count("*").alias("total_rows"), *failure_counts(expectations))
    rows = ", ".join(
        f"named_struct('rule', {literal(e.name)}, 'failed_rows', {quoted(e.name)})" for e in expectations
    )
    return counts.selectExpr(f"inline(array({rows}))", "total_rows")
