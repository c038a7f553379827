"""Checks a consumer runs on the fused table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.contracts import TableExpectation
from monthfusion.functions import literal, quoted


def column_presence(df: DataFrame, expected: TableExpectation) -> DataFrame:
    """Rows (column, present, filled) for every column the table must have.

    ``filled`` counts the rows with a value; absent columns have none.
    """
    present = [c for c in expected.columns if c in df.columns]
    filled = df.agg(*(F.expr(f"count({quoted(c)}) AS {quoted(c)}") for c in present))
    rows = ", ".join(
        f"named_struct('column', {literal(c)}, 'present', {str(c in present).lower()},"
        f" 'filled', {quoted(c) if c in present else '0L'})"
        for c in expected.columns
    )
    return filled.selectExpr(f"inline(array({rows}))")


def described_columns(spark: SparkSession, table: str) -> DataFrame:
    """Rows (column, type, comment) of a registered table, as the catalog describes it."""
    described = spark.sql(f"DESCRIBE TABLE {table}")
    # Notes on partitions follow the columns, under names that begin with '#'.
    columns = described.where("col_name != '' AND NOT startswith(col_name, '#')")
    return columns.selectExpr("col_name AS column", "data_type AS type", "comment")


def check_described(spark: SparkSession, table: str, expected: TableExpectation) -> DataFrame:
    """Rows (column, type, comment, filled) for every column that a registered table must
    have; an absent one has neither type nor comment, and no value in any row."""
    described = described_columns(spark, table)
    found = column_presence(spark.table(table), expected)
    return found.join(described, "column", "left").select("column", "type", "comment", "filled")


def _row(name: str, observed: str, expected: int | None) -> str:
    wanted = "NULL" if expected is None else str(expected)
    passed = "true" if expected is None else f"coalesce({observed} = {expected}, false)"
    return (
        f"named_struct('check', '{name}', 'observed', CAST({observed} AS BIGINT),"
        f" 'expected', CAST({wanted} AS BIGINT), 'passed', {passed})"
    )


def contract_checks(gold: DataFrame, expected: TableExpectation) -> DataFrame:
    """Rows (check, observed, expected, passed); one scan serves all checks.

    Rows are combined per key first, so repeated keys show as groups larger than
    one and the remaining checks run over keys.
    """
    null_key = " OR ".join(f"{quoted(k)} IS NULL" for k in expected.key)
    failed = " OR ".join(f"NOT {quoted(f)}" for f in expected.flags) or "false"
    keys = gold.groupBy(*expected.key).agg(
        F.expr("count(*) AS n"), F.expr(f"count_if({failed}) AS failed")
    )
    facts = keys.agg(
        F.expr("coalesce(sum(n), 0L) AS row_count"),
        F.expr("count_if(n > 1) AS duplicate_keys"),
        F.expr("min(year) AS first_year"),
        F.expr("max(year) AS last_year"),
        F.expr("count(DISTINCT county) AS county_count"),
        F.expr(f"coalesce(sum(CASE WHEN {null_key} THEN n END), 0L) AS null_keys"),
        F.expr("coalesce(sum(failed), 0L) AS failed_flags"),
    )
    missing = len(set(expected.columns) - set(gold.columns))
    rows = (
        _row("row_count", "row_count", expected.row_count),
        _row("unique_keys", "duplicate_keys", 0),
        _row("first_year", "first_year", expected.first_year),
        _row("last_year", "last_year", expected.last_year),
        _row("county_count", "county_count", expected.county_count),
        _row("null_keys", "null_keys", 0),
        _row("flags", "failed_flags", 0),
        _row("missing_columns", str(missing), 0),
    )
    return facts.selectExpr(f"inline(array({', '.join(rows)}))")
