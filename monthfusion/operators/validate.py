"""Check raw source files, read as text, against their contract."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from monthfusion.contracts import FusionContract, SourceContract
from monthfusion.functions import literal, quoted
from monthfusion.functions.keys import county_key
from monthfusion.functions.numbers import finite, is_blank, spelled, whole
from monthfusion.sources.csv_files import MALFORMED, file_paths, headers, scan_groups, scan_numbers
from monthfusion.sources.quoted import QuotedBreaks

EMPTY = "empty_required"
NOT_NUMBER = "nonnumeric"
NOT_FINITE = "nonfinite"
NEGATIVE = "negative"
YEAR_RANGE = "year_range"
MONTH_RANGE = "month_range"
MISSING_COLUMN = "missing_column"
NO_ROWS = "no_rows"
CONFLICT = "conflicting_group"

EXAMPLES = 5


class ValidationFailed(ValueError):
    """A source file violates its contract."""

    def __init__(self, source: str, message: str):
        self.source = source
        super().__init__(f"{source}: {message}")


@dataclass(frozen=True)
class Rule:
    """One way a value can be wrong; ``broken`` is never NULL."""

    name: str
    column: str
    broken: str


def missing_columns(columns: Iterable[str], source: SourceContract) -> list[str]:
    """Required columns that are absent, sorted."""
    return sorted(set(source.files.required_columns) - set(columns))


def require_columns(columns: Iterable[str], source: SourceContract) -> None:
    missing = missing_columns(columns, source)
    if missing:
        raise ValidationFailed(source.name, f"missing required columns: {', '.join(missing)}")


def missing_column_rows(df: DataFrame, source: SourceContract) -> DataFrame:
    """Rows (source, column, rows): absent columns and how many rows lack them."""
    absent = ", ".join(literal(c) for c in missing_columns(df.columns, source))
    return df.agg(F.count("*").alias("rows")).selectExpr(
        f"{literal(source.name)} AS source",
        f"explode(CAST(array({absent}) AS ARRAY<STRING>)) AS column",
        "rows",
    )


def _text(df: DataFrame, name: str) -> str:
    """A column, or NULL where the file has none of that name."""
    return quoted(name) if name in df.columns else "CAST(NULL AS STRING)"


def _numeric(source: SourceContract) -> list[str]:
    return ["Year", "Month", source.outcome, *source.files.numeric_columns]


def parsed(df: DataFrame, source: SourceContract) -> DataFrame:
    """The rows with the key's county and every checked number (``v_``) read.

    Steps of their own, so that each text is read once however many rules look
    at its number.  Code for so many columns in one method of a generated stage would be
    too long for the JVM to compile.  The county's has a part without generated code,
    so Spark evaluates this step by itself and in several methods.
    """
    read = df.selectExpr(
        "*",
        *(f"{spelled(_text(df, c))} AS {quoted('v_' + c)}" for c in _numeric(source)),
        f"{county_key(_text(df, 'County'))} AS county_key",
    )
    values = {f"v_{c}" for c in _numeric(source)}
    return read.selectExpr(*(f"{finite(quoted(c))} AS {quoted(c)}" if c in values else quoted(c) for c in read.columns))


def rules(df: DataFrame, source: SourceContract) -> list[Rule]:
    """Value rules over the :func:`parsed` rows of ``df``."""

    def value(c: str) -> str:
        return quoted("v_" + c)

    def unread(c: str, blank: bool) -> str:
        return f"({value(c)} IS NULL AND {'' if blank else 'NOT '}{is_blank(_text(df, c))})"

    def outside(name: str, c: str, bounds: tuple[int, int]) -> Rule:
        inside = f"coalesce({whole(value(c))} BETWEEN {bounds[0]} AND {bounds[1]}, false)"
        return Rule(name, c, f"({value(c)} IS NOT NULL AND NOT isnan({value(c)}) AND NOT {inside})")

    outcome = value(source.outcome)
    return [
        *(Rule(EMPTY, c, unread(c, blank=True)) for c in ("Year", "Month", source.outcome)),
        Rule(EMPTY, "County", is_blank(_text(df, "County"))),
        *(Rule(NOT_NUMBER, c, unread(c, blank=False)) for c in _numeric(source)),
        *(Rule(NOT_FINITE, c, f"coalesce(isnan({value(c)}), false)") for c in _numeric(source)),
        outside(YEAR_RANGE, "Year", source.files.year_bounds),
        outside(MONTH_RANGE, "Month", source.files.month_bounds),
        Rule(NEGATIVE, source.outcome, f"coalesce(NOT isnan({outcome}) AND {outcome} < 0, false)"),
    ]


def violations(df: DataFrame, source: SourceContract) -> DataFrame:
    """One row per wrong value: source, rule, column, value, key as delivered."""
    wrong = ", ".join(
        f"CASE WHEN {r.broken} THEN named_struct('rule', '{r.name}', 'column', {literal(r.column)},"
        f" 'value', {_text(df, r.column)}) END"
        for r in rules(df, source)
    )
    file = "source_file" if "source_file" in df.columns else "CAST(NULL AS STRING)"
    return parsed(df, source).selectExpr(
        f"{literal(source.name)} AS source",
        f"inline(array_compact(array({wrong})))",
        f"{_text(df, 'Year')} AS year",
        f"{_text(df, 'Month')} AS month",
        f"{_text(df, 'County')} AS county",
        f"{file} AS source_file",
    )


def violation_counts(df: DataFrame, source: SourceContract) -> DataFrame:
    """Rows (source, rule, column, rows) for the rules that are broken.

    All rules share one aggregate; no row is moved.
    """
    checked = rules(df, source)
    counts = parsed(df, source).agg(
        *(F.expr(f"count_if({r.broken}) AS r{i}") for i, r in enumerate(checked))
    )
    rows = ", ".join(
        f"named_struct('rule', '{r.name}', 'column', {literal(r.column)}, 'rows', r{i})"
        for i, r in enumerate(checked)
    )
    return counts.selectExpr(f"{literal(source.name)} AS source", f"inline(array({rows}))").where(
        "rows > 0"
    )


def empty_source(df: DataFrame, source: SourceContract) -> DataFrame:
    """One row (source, rule) when there is no data row, else none."""
    rows = df.limit(1).agg(F.count("*").alias("n"))
    return rows.where("n = 0").selectExpr(
        f"{literal(source.name)} AS source", f"'{NO_ROWS}' AS rule"
    )


def normalized(df: DataFrame, source: SourceContract) -> DataFrame:
    """Key and compared values as numbers; absent optional columns are NULL."""
    return _normalized(parsed(df, source), source)


def _normalized(read: DataFrame, source: SourceContract, *kept: str) -> DataFrame:
    names = (source.outcome, *source.files.numeric_columns)
    return read.selectExpr(
        f"{whole('v_Year')} AS year",
        f"{whole('v_Month')} AS month",
        "county_key AS county",
        *(f"{quoted('v_' + n)} AS {quoted(n)}" for n in names),
        *kept,
    )


def digest(names: Iterable[str]) -> tuple[str, str]:
    """Two hashes of 64 bits each of all values of a row, NULL being a value of its own.

    A hash passes over NULL, so the places of NULL values are hashed too.
    """
    values = ", ".join(quoted(n) for n in names)
    places = ", ".join(f"isnull({quoted(n)})" for n in names)
    return f"xxhash64({values}, {places})", f"xxhash64(1, {places}, {values})"


def _lacking(source: SourceContract) -> str:
    return " OR ".join(f"{quoted(n)} IS NULL" for n in source.files.numeric_columns)


def _groups(values: DataFrame, source: SourceContract) -> DataFrame:
    """Per key: rows, incomplete rows, whether its rows conflict.

    Rows of a key differ if least and largest digest do: two numbers a row stand for all
    of its columns.
    """
    return _combined(_told(values, source))


def _told(values: DataFrame, source: SourceContract, *kept: str) -> DataFrame:
    """What a row tells of its key: whether it is incomplete, and its digests."""
    first, second = digest((source.outcome, *source.files.numeric_columns))
    return values.selectExpr("year", "month", "county", f"{_lacking(source)} AS lacking", f"{first} AS d1", f"{second} AS d2", *kept)


def _combined(told: DataFrame) -> DataFrame:
    return told.groupBy("year", "month", "county").agg(
        F.count("*").alias("n"),
        F.expr("count_if(lacking) AS incomplete"),
        F.expr("min(d1) <> max(d1) OR min(d2) <> max(d2) AS conflict"),
    )


def incomplete_metadata(df: DataFrame, source: SourceContract) -> DataFrame:
    """One row (source, rows): rows lacking any compared attribute."""
    counted = normalized(df, source).agg(F.expr(f"count_if({_lacking(source)}) AS rows"))
    return counted.selectExpr(f"{literal(source.name)} AS source", "rows")


def conflict_groups(df: DataFrame, source: SourceContract) -> DataFrame:
    """Keys whose rows differ, with the number of different rows (variants).

    Counting works on rows made unique first, so a hot key is spread over tasks.
    """
    first, second = digest((source.outcome, *source.files.numeric_columns))
    return (
        normalized(df, source)
        .selectExpr("year", "month", "county", f"{first} AS d1", f"{second} AS d2")
        .distinct()
        .groupBy("year", "month", "county")
        .agg(F.count("*").alias("variants"))
        .where("variants > 1")
    )


def conflict_examples(df: DataFrame, source: SourceContract, limit: int = EXAMPLES) -> DataFrame:
    """The first conflicting keys in key order, as ``county YYYY-MM``."""
    groups = _groups(normalized(df, source), source).where("conflict")
    text = "concat(county, ' ', year, '-', lpad(month, 2, '0')) AS example"
    return groups.orderBy("year", "month", "county").limit(limit).selectExpr(text)


def report(df: DataFrame, source: SourceContract, path: str | None = None) -> DataFrame:
    """One row summing up a source: sizes, duplicates, conflicts, ranges.

    Rows are combined per key first; the summary then runs over keys.
    """
    return _report(parsed(df, source), source, path)


def _report(read: DataFrame, source: SourceContract, path: str | None) -> DataFrame:
    return _summary(_groups(_normalized(read, source), source), source, path)


def _summary(keys: DataFrame, source: SourceContract, path: str | None) -> DataFrame:
    """One row over all keys."""
    summary = keys.agg(
        F.expr("coalesce(sum(n), 0L) AS raw_rows"),
        F.expr("count(*) AS unique_county_months"),
        F.expr("count_if(conflict) AS conflict_groups"),
        F.expr("coalesce(sum(incomplete), 0L) AS incomplete_metadata_rows"),
        F.expr("min(year) AS minimum_year"),
        F.expr("max(year) AS maximum_year"),
        F.expr("count(DISTINCT county) AS county_count"),
    )
    return summary.selectExpr(
        f"{literal(source.name)} AS source",
        f"CAST({'NULL' if path is None else literal(path)} AS STRING) AS path",
        "raw_rows",
        "unique_county_months",
        "raw_rows - unique_county_months AS duplicate_rows",
        "conflict_groups",
        "incomplete_metadata_rows",
        "minimum_year",
        "maximum_year",
        "county_count",
    )


def assert_valid(df: DataFrame, source: SourceContract, path: str | None = None) -> DataFrame:
    """The report of a source, or :class:`ValidationFailed`.

    The scan that builds the report counts the rows that break any rule; only if there
    are such rows, which rules they break is counted.
    """
    require_columns(df.columns, source)
    seen = Observation()
    read = parsed(df, source)
    broken = " OR ".join(r.broken for r in rules(df, source))
    done = _report(read.withColumn("broken", F.expr(broken)).observe(seen, F.expr("count_if(broken) AS broken")), source, path)
    row = done.first()

    if not row.raw_rows:
        raise ValidationFailed(source.name, "no data rows")
    if seen.get["broken"]:
        counted = violation_counts(df, source).collect()  # a row for each rule and column
        listed = "; ".join(f"{r['rows']} rows {r.rule} in {r.column!r}" for r in counted)
        wrong = violations(df, source).limit(EXAMPLES).collect()
        shown = ", ".join(
            f"{w.county} {w.year}-{w.month} {w.column}={w.value!r}" for w in wrong
        )
        raise ValidationFailed(source.name, f"{listed}; e.g. {shown}")
    if row.conflict_groups:
        shown = ", ".join(r.example for r in conflict_examples(df, source).collect())
        raise ValidationFailed(
            source.name, f"{row.conflict_groups} conflicting county-month groups; e.g. {shown}"
        )
    return df.sparkSession.createDataFrame([row], done.schema)


def _plain_report(df: DataFrame, source: SourceContract, path: str) -> DataFrame | None:
    """The report of rows whose numbers are read already, or None if any row may be wrong.

    Nearly all deliveries are sound, and their numbers plain: those need no look at texts.
    """
    seen = Observation()
    numbers = [f"CAST({_text(df, c)} AS DOUBLE) AS {quoted('v_' + c)}" for c in _numeric(source)]
    county = f"{county_key(_text(df, 'County'))} AS county_key"
    value = [quoted("v_" + c) for c in _numeric(source)]
    required = [quoted("v_" + c) for c in ("Year", "Month", source.outcome)]
    sound = " AND ".join(
        [
            f"{quoted(MALFORMED)} IS NULL AND county_key != ''",
            *(f"{v} IS NOT NULL" for v in required),
            *(f"coalesce(abs({v}) < double('Infinity'), true)" for v in value),
            f"{whole('v_Year')} BETWEEN {source.files.year_bounds[0]} AND {source.files.year_bounds[1]}",
            f"{whole('v_Month')} BETWEEN {source.files.month_bounds[0]} AND {source.files.month_bounds[1]}",
            f"{quoted('v_' + source.outcome)} >= 0",
        ]
    )
    read = df.selectExpr(quoted(MALFORMED), *numbers, county)
    told = _told(_normalized(read, source, f"NOT coalesce({sound}, false) AS broken"), source, "broken")
    done = _summary(_combined(told.observe(seen, F.expr("count_if(broken) AS broken"))), source, path)
    row = done.first()
    if not row.raw_rows or seen.get["broken"] or row.conflict_groups:
        return None
    return df.sparkSession.createDataFrame([row], done.schema)


def validate_source(spark: SparkSession, path: str, source: SourceContract) -> DataFrame:
    """Validate the file or folder of one source.

    Every file, an empty one too, must have the required columns: headers are
    checked apart from the scan, which looks only at columns that it reads.  Files of
    plain numbers are read as numbers; only if that finds a fault, or a file may spell
    numbers otherwise, texts are looked at.
    """
    try:
        paths = file_paths(spark, path)
    except FileNotFoundError:
        raise ValidationFailed(source.name, f"no source file at {path}") from None
    groups = headers(spark, paths)
    for names in sorted(groups):
        require_columns(names, source)
    breaks = QuotedBreaks(spark, paths)
    plain = scan_numbers(spark, groups, breaks, _numeric(source))
    found = None if plain is None else _plain_report(plain, source, path)
    return assert_valid(scan_groups(spark, groups, breaks), source, path) if found is None else found


def validate_all(spark: SparkSession, folder: str, contract: FusionContract) -> DataFrame:
    """Reports of all sources, in contract order; fails at the first bad source."""
    reports = [
        validate_source(spark, f"{folder.rstrip('/')}/{s.file_name or s.name}", s)
        for s in contract.sources
    ]
    return reduce(DataFrame.unionAll, reports)
