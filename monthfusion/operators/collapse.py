"""Collapse repeated source rows to one row per year, month and county."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthfusion.contracts import SourceContract, attribute_order
from monthfusion.functions import quoted
from monthfusion.functions.keys import county_title, month_start
from monthfusion.functions.units import UNITS

EXACT = "exact"
GATE = "gate"

KEY_EXPRESSIONS = ("Year AS year", "Month AS month", f"{county_title('County')} AS county")


def compared_columns(source: SourceContract) -> list[str]:
    """Raw columns that must not vary within one key."""
    return [source.outcome, *(a.raw for a in source.attributes)]


def _columns(expressions: list[str]) -> list[Column]:
    return [F.expr(e) for e in expressions]


def _largest(values: list[str]) -> str:
    return f"greatest({', '.join(values)})" if len(values) > 1 else values[0]


def _exact_distinct(names: list[str]) -> str:
    return _largest([f"count(DISTINCT {quoted(c)})" for c in names]) + " AS distinct_value_max"


def _at_most_two(name: str) -> str:
    """Distinct values from a minimum and a maximum: 0, 1, or 2 for "several"."""
    low, high = f"min({quoted(name)})", f"max({quoted(name)})"
    return f"CASE WHEN {high} IS NULL THEN 0L WHEN {low} <=> {high} THEN 1L ELSE 2L END"


def distinct_value_max(
    bronze: DataFrame, source: SourceContract, columns: list[str] | None = None
) -> DataFrame:
    """Exact largest number of distinct values any compared column has per key.

    Repeats are removed first, with map-side combining and spread over key *and*
    values, so a key holding a large share of all rows is no single task.  What
    is left is about one row per key, and the per-column distinct counts (which
    Spark runs by expanding every row once per column) work on that only.

    The row count is part of the result on purpose: without it the optimizer
    sees that removing repeats changes no distinct count, drops that step and
    expands every raw row.
    """
    names = columns or compared_columns(source)
    unique = bronze.groupBy(*_columns(KEY_EXPRESSIONS), *_columns([quoted(c) for c in names])).agg(
        F.expr("count(*) AS n")
    )
    return unique.groupBy("year", "month", "county").agg(
        F.expr("sum(n) AS source_row_count"), F.expr(_exact_distinct(names))
    )


def _group(bronze: DataFrame, source: SourceContract, distinct: str) -> DataFrame:
    names = compared_columns(source)
    tops = [f"max({quoted(c)}) AS {quoted(c)}" for c in names]
    if distinct == GATE:
        return bronze.groupBy(*_columns(KEY_EXPRESSIONS)).agg(
            *_columns(tops),
            F.expr("count(*) AS source_row_count"),
            F.expr(_largest([_at_most_two(c) for c in names]) + " AS distinct_value_max"),
            F.expr("max(source_file) AS source_file"),
            F.expr("max(ingested_at) AS latest_ingested_at"),
        )
    if distinct != EXACT:
        raise ValueError(f"distinct must be {EXACT!r} or {GATE!r}, not {distinct!r}")
    unique = bronze.groupBy(*_columns(KEY_EXPRESSIONS), *_columns([quoted(c) for c in names])).agg(
        F.expr("count(*) AS n"),
        F.expr("max(source_file) AS file"),
        F.expr("max(ingested_at) AS at"),
    )
    return unique.groupBy("year", "month", "county").agg(
        *_columns(tops),
        F.expr("sum(n) AS source_row_count"),
        F.expr(_exact_distinct(names)),
        F.expr("max(file) AS source_file"),
        F.expr("max(at) AS latest_ingested_at"),
    )


# -- collapsing in parts ---------------------------------------------------

_KEY = ("year", "month", "county")


def _parts(source: SourceContract) -> dict[str, tuple[str, str]]:
    """Columns of a part: how raw rows give them, and how two values become one."""
    parts = {}
    for i, c in enumerate(compared_columns(source)):
        parts[f"low_{i}"] = (f"min({quoted(c)})", "least")
        parts[f"high_{i}"] = (f"max({quoted(c)})", "greatest")
    parts["source_row_count"] = ("count(*)", "sum")
    parts["latest_ingested_at"] = ("max(ingested_at)", "greatest")
    return parts


def parts_by_file(bronze: DataFrame, source: SourceContract) -> DataFrame:
    """One row per key and file: what a collapse needs to know of them.

    All values that are kept have a fixed width, so Spark combines rows in hash tables,
    and a key that holds a large share of all rows is spread over its files.
    """
    return bronze.groupBy(*_columns(KEY_EXPRESSIONS), "source_file").agg(
        *_columns([f"{e} AS {name}" for name, (e, _) in _parts(source).items()])
    )


_AGAIN = {"least": "min", "greatest": "max", "sum": "sum"}


def parts_by_key(by_file: DataFrame, source: SourceContract) -> DataFrame:
    """One row per key from rows per key and file.

    The last file name is found as the largest of numbers that are in the order of the
    names: a largest text would need sorted rows.  There is one number for each file.
    """
    order = Window.orderBy("source_file")
    numbers = by_file.select("source_file").distinct().select(F.col("source_file").alias("name"), F.row_number().over(order).alias("number"))
    numbered = by_file.join(numbers, F.col("source_file").eqNullSafe(F.col("name"))).drop("source_file", "name")
    combined = numbered.groupBy(*_KEY).agg(
        *_columns([f"{_AGAIN[how]}({name}) AS {name}" for name, (_, how) in _parts(source).items()]), F.max("number").alias("number")
    )
    return combined.join(numbers, "number").drop("number").withColumnRenamed("name", "source_file")


def merged_parts(old: DataFrame, new: DataFrame, source: SourceContract) -> DataFrame:
    """Rows of both, one per key; either has at most one row of a key."""
    a, b = old.alias("a"), new.alias("b")
    same = " AND ".join(f"a.{k} <=> b.{k}" for k in _KEY)
    both = {name: f"coalesce(a.{name} + b.{name}, a.{name}, b.{name})" if how == "sum" else f"{how}(a.{name}, b.{name})" for name, (_, how) in _parts(source).items()}
    both["source_file"] = "greatest(a.source_file, b.source_file)"
    # A joined row has its key from either side, NULL parts included.
    return a.join(b, F.expr(same), "full").selectExpr(
        *(f"coalesce(a.{k}, b.{k}) AS {k}" for k in _KEY), *(f"{e} AS {name}" for name, e in both.items())
    )


def finished_parts(parts: DataFrame, source: SourceContract) -> DataFrame:
    """What :func:`collapse` gives with ``gate`` for the rows behind these parts."""
    names = compared_columns(source)
    several = [
        f"CASE WHEN high_{i} IS NULL THEN 0L WHEN low_{i} <=> high_{i} THEN 1L ELSE 2L END" for i in range(len(names))
    ]
    grouped = parts.selectExpr(
        *_KEY,
        *(f"high_{i} AS {quoted(c)}" for i, c in enumerate(names)),
        "source_row_count",
        f"{_largest(several)} AS distinct_value_max",
        "source_file",
        "latest_ingested_at",
    )
    return _cleaned(grouped, source)


def collapse(bronze: DataFrame, source: SourceContract, distinct: str = EXACT) -> DataFrame:
    """One row per key: largest value of every column, units, lineage.

    ``distinct_value_max`` tells whether a key disagrees with itself.  ``exact``
    counts the distinct values.  ``gate`` derives 0, 1 or 2 ("several") from
    minimum and maximum with a single shuffle; it equals the exact count for
    every key that passes the rule "at most one", so it is what a fail-closed
    update needs.
    """
    return _cleaned(_group(bronze, source, distinct), source)


def _cleaned(grouped: DataFrame, source: SourceContract) -> DataFrame:
    """Grouped rows with cleaned names and types, units and lineage."""
    value = {
        a.name: f"CAST({quoted(a.raw)} AS {a.cast})" if a.cast else quoted(a.raw)
        for a in source.attributes
    }
    for d in source.derived:
        value[d.name] = UNITS[d.unit](*(value[c] for c in d.inputs))
    first, *rest = attribute_order(source)
    return grouped.selectExpr(
        "year",
        "month",
        f"{month_start('year', 'month')} AS observation_month",
        "county",
        f"{value[first]} AS {first}",
        f"{quoted(source.outcome)} AS {source.count_column}",
        *(f"{value[c]} AS {c}" for c in rest),
        "source_row_count",
        "distinct_value_max",
        "source_file",
        "latest_ingested_at",
    )
