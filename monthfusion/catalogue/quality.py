"""Queries for row rules, publishing, file validation and consumer checks."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.catalogue import sql
from monthfusion.catalogue.fusion import fused, fused_disturbed
from monthfusion.contracts import TableExpectation, column_comments, fused_columns
from monthfusion.operators import validate
from monthfusion.operators.checks import check_described, column_presence, contract_checks
from monthfusion.operators.collapse import GATE, collapse
from monthfusion.operators.expectations import (
    ExpectationFailed,
    check,
    gold_expectations,
    silver_expectations,
)
from monthfusion.plans.analogs import CONTRACT, all_sources, as_text, raw_outcomes, source
from monthfusion.sources.csv_files import read_text
from monthfusion.sources.published import PublishedTable
from monthfusion.sources.scratch import scratch_dir

# Rules from 1996 on make the first year of the data fail.
STRICT = CONTRACT.with_years(1996, 2100)
BIRD = CONTRACT.source("bird")
EXPECTED = TableExpectation(
    columns=fused_columns(CONTRACT),
    flags=tuple(a.name for a in CONTRACT.agreements),
)


def flawed_bird(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contradicting outcomes, some negative or missing, and a nameless nation."""
    n = F.col("n_nationkey")
    return raw_outcomes(spark, sf_dir).withColumns(
        {
            "County": F.when(n != 9, F.col("County")),
            "Bird": F.when(n == 2, -1 - F.col("Bird")).when(n != 3, F.col("Bird")),
        }
    )


def silver_rule(index: int):
    def query(spark, sf_dir):
        source_ = STRICT.source("bird")
        silver = collapse(flawed_bird(spark, sf_dir), source_, GATE)
        return check(silver, [silver_expectations(source_)[index]])

    return query


def expect_gold(spark, sf_dir):
    return check(fused_disturbed(spark, sf_dir), gold_expectations(STRICT))


def publish_on_pass(spark, sf_dir):
    """A good update is published; a later bad one leaves it in place."""
    gold = PublishedTable(spark, scratch_dir(spark, "publish"), CONTRACT.gold_name)
    gold.publish(fused(spark, sf_dir), gold_expectations(CONTRACT), comment="first")
    refused = False
    try:
        gold.publish(fused_disturbed(spark, sf_dir), gold_expectations(CONTRACT), comment="second")
    except ExpectationFailed:
        refused = True
    return gold.read().agg(
        F.lit(refused).alias("second_refused"),
        F.lit(gold.current_version()).cast("bigint").alias("version"),
        F.lit(gold.comment()).alias("comment"),
        F.count("*").alias("row_count"),
        F.sum(CONTRACT.total_column).alias("activity"),
        F.sum("county_fips").alias("fips_sum"),
    )


def _text_of_orders(spark: SparkSession, sf_dir: str, changes: dict[str, Column]) -> DataFrame:
    return as_text(raw_outcomes(spark, sf_dir)).withColumns(changes)


def missing_columns(spark, sf_dir):
    """Files without two required columns, written and read back by header."""
    folder = scratch_dir(spark, "missing")
    rows = source(spark, sf_dir, "bird").drop("Date", "FIPS", "source_file", "ingested_at")
    rows.write.csv(folder, header=True)
    return validate.missing_column_rows(read_text(spark, folder), BIRD)


def validate_required(spark, sf_dir):
    n, k = F.col("n_nationkey"), F.col("o_orderkey")
    changes = {
        "County": F.when(n == 4, "").when(n == 5, " \t ").when(n != 6, F.col("County")),
        "Year": F.when(k % 10 != 0, F.col("Year")),
        "Bird": F.when(k % 7 == 0, "").otherwise(F.col("Bird")),
    }
    rows = _text_of_orders(spark, sf_dir, changes)
    return validate.violation_counts(rows, BIRD).where(F.col("rule") == validate.EMPTY)


def validate_numeric(spark, sf_dir):
    """Spellings that are, or are not, finite numbers."""
    k = F.col("o_orderkey").cast("bigint") % 13
    outcome = F.col("Bird")
    spellings = ("x", "NaN", "-inf", "1d", "-3", "1_000", " 12 ", "1e999", "0x1p3", "1__0", ".5", "7.")
    for i, spelling in enumerate(spellings):
        outcome = F.when(k == i, spelling).otherwise(outcome)
    fips = F.when(k == 1, "?").when(k == 2, "").when(k == 3, "Infinity").otherwise(F.col("FIPS"))
    rows = _text_of_orders(spark, sf_dir, {"Bird": outcome, "FIPS": fips})
    found = (validate.NOT_NUMBER, validate.NOT_FINITE, validate.NEGATIVE)
    return validate.violation_counts(rows, BIRD).where(F.col("rule").isin(*found))


def validate_key_range(spark, sf_dir):
    k = F.col("o_orderkey").cast("bigint") % 11
    changes = {
        "Year": F.when(k == 0, "1800").when(k == 1, "2100.9").when(k == 2, "1e12").otherwise(F.col("Year")),
        "Month": F.when(k == 3, "13").when(k == 4, "0.9").when(k == 5, "12.9").otherwise(F.col("Month")),
    }
    rows = _text_of_orders(spark, sf_dir, changes)
    found = (validate.YEAR_RANGE, validate.MONTH_RANGE)
    return validate.violation_counts(rows, BIRD).where(F.col("rule").isin(*found))


def validate_violations(spark, sf_dir):
    """Every wrong value as a row of its own."""
    k = F.col("o_orderkey").cast("bigint")
    changes = {
        "Bird": F.when(k % 5 == 0, "-1").otherwise(F.col("Bird")),
        "FIPS": F.when(k % 3 == 0, "none").otherwise(F.col("FIPS")),
    }
    rows = _text_of_orders(spark, sf_dir, changes)
    found = validate.violations(rows, BIRD)
    return found.select("source", "rule", "column", "value", "year", "month", "county")


def validate_empty_source(spark, sf_dir):
    """One slot without rows, one with."""
    rows = as_text(source(spark, sf_dir, "bird"))
    empty = rows.where(F.col("Year").cast("int") < 1900)
    return validate.empty_source(empty, BIRD).unionByName(
        validate.empty_source(rows, replace(BIRD, name="bird_with_rows"))
    )


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contradicting outcomes in nations 0 to 9; a value missing in part of nation 12."""
    n, k = F.col("n_nationkey").cast("int"), F.col("o_orderkey").cast("bigint")
    changes = {
        "Bird": F.when(n < 10, F.col("Bird")).otherwise("1"),
        "tp_1m_shift": F.when((n != 12) | (k % 2 == 0), F.col("tp_1m_shift")),
        "County": F.when(k % 2 == 0, F.upper("County")).otherwise(F.col("County")),
    }
    return _text_of_orders(spark, sf_dir, changes)


def conflict_groups(spark, sf_dir):
    return validate.conflict_groups(_gaps(spark, sf_dir), BIRD)


def conflict_examples(spark, sf_dir):
    return validate.conflict_examples(_gaps(spark, sf_dir), BIRD)


def incomplete_metadata(spark, sf_dir):
    rows = as_text(source(spark, sf_dir, "mosquito"))
    return validate.incomplete_metadata(rows, CONTRACT.source("mosquito"))


def validate_report(spark, sf_dir):
    return validate.report(_gaps(spark, sf_dir), BIRD).drop("path")


def _arrive(rows: DataFrame, folder: str, name: str) -> None:
    """Write rows as CSV files of a source, without the columns that loading adds."""
    rows.drop("source_file", "ingested_at").write.csv(f"{folder}/{name}", header=True)


def validate_all(spark, sf_dir):
    """The three slots as folders of CSV files, checked before they are loaded."""
    folder = scratch_dir(spark, "source-files")
    slots = all_sources(spark, sf_dir)
    for s in CONTRACT.sources:
        _arrive(slots[s.name], folder, s.file_name or s.name)
    return validate.validate_all(spark, folder, CONTRACT).drop("path")


def validate_headers(spark, sf_dir):
    """A good folder; then one more delivery, in which a required column has another name."""
    folder = scratch_dir(spark, "source-files")
    rows = source(spark, sf_dir, "bird")
    _arrive(rows.where("Month <= 6"), folder, "first")
    _arrive(rows.where("Month > 6").select(*reversed(rows.columns)), folder, "second")
    good = validate.validate_source(spark, folder, CONTRACT.source("bird"))
    _arrive(rows.where("Month = 7").withColumnRenamed("Date", "Dat"), folder, "third")
    message = None
    try:
        validate.validate_source(spark, folder, CONTRACT.source("bird"))
    except validate.ValidationFailed as e:
        message = str(e)
    return good.select("source", "raw_rows", F.lit(message).alias("refused"))


def described_columns_of_gold(spark, sf_dir):
    """The fused table published, registered, and described by the catalog."""
    gold = PublishedTable(spark, scratch_dir(spark, "described"), CONTRACT.gold_name)
    gold.publish(fused(spark, sf_dir), gold_expectations(CONTRACT), comment="described")
    view = f"described_{uuid.uuid4().hex}"
    gold.register(view, column_comments(CONTRACT))
    found = check_described(spark, view, EXPECTED)
    # The result is kept, so that the view need not stay.
    folder = scratch_dir(spark, "description")
    found.write.parquet(folder)
    spark.sql(f"DROP VIEW {view}")
    return spark.read.schema(found.schema).parquet(folder)


def contract_check(*names: str, disturbed: bool = False):
    def query(spark, sf_dir):
        gold = (fused_disturbed if disturbed else fused)(spark, sf_dir)
        checks = contract_checks(gold, EXPECTED).where(F.col("check").isin(*names))
        return checks.select("check", "observed", "passed")

    return query


def contract_unique_keys(spark, sf_dir):
    """The fused table with the keys of one month repeated."""
    gold = fused(spark, sf_dir)
    doubled = gold.unionByName(gold.where("month = 7"))
    checks = contract_checks(doubled, EXPECTED).where(F.col("check") == "unique_keys")
    return checks.select("check", "observed", "passed")


def contract_null_keys(spark, sf_dir):
    """The fused table with one county's name lost."""
    gold = fused(spark, sf_dir)
    lost = gold.withColumn("county", F.when(F.col("county") != "Nation 3", F.col("county")))
    checks = contract_checks(lost, EXPECTED).where(F.col("check") == "null_keys")
    return checks.select("check", "observed", "passed")


def contract_columns(spark, sf_dir):
    gold = fused(spark, sf_dir).drop("snowfall_1m_shift")
    return column_presence(gold, EXPECTED)


QUERIES = {
    "expect_valid_key": silver_rule(0),
    "expect_valid_count": silver_rule(1),
    "expect_consistent_group": silver_rule(2),
    "expect_gold": expect_gold,
    "publish_on_pass": publish_on_pass,
    "missing_columns": missing_columns,
    "validate_required": validate_required,
    "validate_numeric": validate_numeric,
    "validate_key_range": validate_key_range,
    "validate_violations": validate_violations,
    "validate_empty_source": validate_empty_source,
    "conflict_groups": conflict_groups,
    "conflict_examples": conflict_examples,
    "incomplete_metadata": incomplete_metadata,
    "validate_report": validate_report,
    "validate_all": validate_all,
    "validate_headers": validate_headers,
    "described_columns": described_columns_of_gold,
    "contract_row_count": contract_check("row_count"),
    "contract_unique_keys": contract_unique_keys,
    "contract_year_range": contract_check("first_year", "last_year"),
    "contract_county_count": contract_check("county_count"),
    "contract_null_keys": contract_null_keys,
    "contract_flags": contract_check("flags", disturbed=True),
    "contract_columns": contract_columns,
}

_FLAWED = sql.shifted(
    sql.RAW_OUTCOMES,
    {
        "County": "CASE WHEN n <> 9 THEN County END",
        "Bird": "CASE WHEN n = 2 THEN -1 - Bird WHEN n <> 3 THEN Bird END",
    },
)
_ORDERS = f"({sql.FACTS['bird']})"


def _rule_sql(relation: str, rules: dict[str, str], setup: str = "") -> str:
    parts = [
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({predicate}, false)) AS failed_rows,"
        f" count(*) AS total_rows FROM {relation}"
        for name, predicate in rules.items()
    ]
    return setup + " UNION ALL ".join(parts)


_KEY_RULE = "year >= 1996 AND year <= 2100 AND month >= 1 AND month <= 12 AND county IS NOT NULL"
_SILVER_RULES = {
    "expect_valid_key": {"valid_bird_key": _KEY_RULE},
    "expect_valid_count": {"valid_bird_count": "bird_count >= 0"},
    "expect_consistent_group": {"consistent_bird_group": "distinct_value_max <= 1"},
}
_GOLD_RULES = {
    "valid_gold_key": _KEY_RULE,
    "consistent_cross_source_fips": "fips_consistent",
    "consistent_cross_source_coordinates": "coordinates_consistent",
    "consistent_cross_source_weather": "weather_consistent",
}


def _counts_sql(*found: tuple[str, str, str]) -> str:
    """Rows per (rule, column) where a condition on orders holds."""
    parts = [
        f"SELECT 'bird' AS source, '{rule}' AS rule, '{column}' AS \"column\", count(*) AS rows"
        f" FROM {_ORDERS} WHERE {condition} HAVING count(*) > 0"
        for rule, column, condition in found
    ]
    return " UNION ALL ".join(parts)


def _check_sql(checks: dict[str, str], expected_zero: bool, setup: str) -> str:
    passed = "observed = 0" if expected_zero else "true"
    parts = [f"SELECT '{name}' AS \"check\", CAST({value} AS BIGINT) AS observed FROM gold" for name, value in checks.items()]
    return f"{setup} SELECT *, {passed} AS passed FROM ({' UNION ALL '.join(parts)})"


# The compared values of a key depend on nation and month alone, except those
# the query sets per order.
_GAPS = f"""
    SELECT y AS year, m AS month, n, 'nation ' || n AS county,
           CASE WHEN n < 10 THEN o_orderkey % 4 ELSE 1 END AS bird,
           CASE WHEN n <> 12 OR o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS has_rain
    FROM {_ORDERS}"""
_GAP_KEYS = f"""
    SELECT year, month, county, count(*) AS n_rows, count(DISTINCT (bird, has_rain)) AS variants,
           count(*) FILTER (WHERE has_rain = 0) AS incomplete
    FROM ({_GAPS}) GROUP BY ALL"""


def _report_sql(slot: str) -> str:
    lacking = "count(*) FILTER (WHERE n % 7 = 3)" if slot == "mosquito" else "0"
    return f"""
        SELECT '{slot}' AS source, CAST(sum(c) AS BIGINT) AS raw_rows, count(*) AS unique_county_months,
               CAST(sum(c) - count(*) AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS conflict_groups,
               CAST(sum(l) AS BIGINT) AS incomplete_metadata_rows, min(y) AS minimum_year,
               max(y) AS maximum_year, count(DISTINCT n) AS county_count
        FROM (SELECT y, m, n, count(*) AS c, {lacking} AS l FROM ({sql.FACTS[slot]}) GROUP BY ALL)"""


def _type_of(column: str) -> str:
    """Type of a column of the fused table, by its name."""
    if column.endswith(("_reported", "_consistent")):
        return "boolean"
    types = {"year": "int", "month": "int", "county": "string", "county_fips": "int", "observation_month": "date", "latest_ingested_at": "timestamp"}
    types |= {"reported_activity_types": "int", CONTRACT.total_column: "bigint"}
    types |= {f"{s}_count": "bigint" for s in sql.SLOTS} | {f"{s}_source_file": "string" for s in sql.SLOTS}
    return types.get(column, "double")


def _comment_of(column: str) -> str:
    comment = column_comments(CONTRACT).get(column)
    return "CAST(NULL AS VARCHAR)" if comment is None else f"'{comment}'"


_ABSENT = [c for c in EXPECTED.columns if c == "snowfall_1m_shift"]

ORACLES = {
    **{
        key: _rule_sql("silver", rules, f"WITH silver AS ({sql.silver('bird', _FLAWED)}) ")
        for key, rules in _SILVER_RULES.items()
    },
    "expect_gold": _rule_sql("gold", _GOLD_RULES, sql.gold(sql.DISTURBED) + " "),
    "publish_on_pass": f"""{sql.gold()}
        SELECT true AS second_refused, CAST(1 AS BIGINT) AS version, 'first' AS comment,
               count(*) AS row_count, CAST(sum({CONTRACT.total_column}) AS BIGINT) AS activity,
               CAST(sum(county_fips) AS BIGINT) AS fips_sum
        FROM gold""",
    "missing_columns": f"""
        SELECT 'bird' AS source, unnest(['Date', 'FIPS']) AS "column", count(*) AS rows FROM {_ORDERS}""",
    "validate_required": _counts_sql(
        (validate.EMPTY, "County", "n IN (4, 5, 6)"),
        (validate.EMPTY, "Year", "o_orderkey % 10 = 0"),
        (validate.EMPTY, "Bird", "o_orderkey % 7 = 0"),
    ),
    "validate_numeric": _counts_sql(
        (validate.NOT_NUMBER, "Bird", "o_orderkey % 13 IN (0, 3, 8, 9)"),
        (validate.NOT_FINITE, "Bird", "o_orderkey % 13 IN (1, 2, 7)"),
        (validate.NEGATIVE, "Bird", "o_orderkey % 13 = 4"),
        (validate.NOT_NUMBER, "FIPS", "o_orderkey % 13 = 1"),
        (validate.NOT_FINITE, "FIPS", "o_orderkey % 13 = 3"),
    ),
    "validate_key_range": _counts_sql(
        (validate.YEAR_RANGE, "Year", "o_orderkey % 11 IN (0, 2)"),
        (validate.MONTH_RANGE, "Month", "o_orderkey % 11 IN (3, 4)"),
    ),
    "validate_violations": " UNION ALL ".join(
        f"""SELECT 'bird' AS source, '{rule}' AS rule, '{column}' AS "column", '{value}' AS value,
                   CAST(y AS VARCHAR) AS year, CAST(m AS VARCHAR) AS month,
                   ' nation ' || n || ' ' AS county
            FROM {_ORDERS} WHERE {condition}"""
        for rule, column, value, condition in (
            (validate.NEGATIVE, "Bird", "-1", "o_orderkey % 5 = 0"),
            (validate.NOT_NUMBER, "FIPS", "none", "o_orderkey % 3 = 0"),
        )
    ),
    "validate_empty_source": f"""
        SELECT 'bird' AS source, '{validate.NO_ROWS}' AS rule
        FROM (SELECT count(*) AS c FROM {_ORDERS} WHERE y < 1900) WHERE c = 0""",
    "conflict_groups": f"SELECT year, month, county, variants FROM ({_GAP_KEYS}) WHERE variants > 1",
    "conflict_examples": f"""
        SELECT county || ' ' || year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS example
        FROM ({_GAP_KEYS}) WHERE variants > 1 ORDER BY year, month, county LIMIT 5""",
    "incomplete_metadata": f"""
        SELECT 'mosquito' AS source, count(*) FILTER (WHERE n % 7 = 3) AS rows
        FROM ({sql.FACTS['mosquito']})""",
    "validate_report": f"""
        SELECT 'bird' AS source, CAST(sum(n_rows) AS BIGINT) AS raw_rows, count(*) AS unique_county_months,
               CAST(sum(n_rows) - count(*) AS BIGINT) AS duplicate_rows,
               count(*) FILTER (WHERE variants > 1) AS conflict_groups,
               CAST(sum(incomplete) AS BIGINT) AS incomplete_metadata_rows, min(year) AS minimum_year,
               max(year) AS maximum_year, count(DISTINCT county) AS county_count
        FROM ({_GAP_KEYS})""",
    "validate_all": " UNION ALL ".join(_report_sql(s) for s in sql.SLOTS),
    "validate_headers": f"""
        SELECT 'bird' AS source, count(*) AS raw_rows, 'bird: missing required columns: Date' AS refused
        FROM {_ORDERS}""",
    "described_columns": f"{sql.gold()} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{_type_of(c)}' AS type,"
        f" {_comment_of(c)} AS comment, count({c}) AS filled FROM gold"
        for c in EXPECTED.columns
    ),
    "contract_row_count": _check_sql({"row_count": "count(*)"}, False, sql.gold()),
    "contract_unique_keys": f"""{sql.gold()}
        SELECT 'unique_keys' AS "check", count(*) AS observed, count(*) = 0 AS passed FROM (
            SELECT year, month, county FROM (FROM gold UNION ALL FROM gold WHERE month = 7)
            GROUP BY ALL HAVING count(*) > 1)""",
    "contract_year_range": _check_sql(
        {"first_year": "min(year)", "last_year": "max(year)"}, False, sql.gold()
    ),
    "contract_county_count": _check_sql({"county_count": "count(DISTINCT county)"}, False, sql.gold()),
    "contract_null_keys": _check_sql(
        {"null_keys": "count(*) FILTER (WHERE county = 'Nation 3')"}, True, sql.gold()
    ),
    "contract_flags": _check_sql(
        {
            "flags": "count(*) FILTER (WHERE fips_consistent = false"
            " OR coordinates_consistent = false OR weather_consistent = false)"
        },
        True,
        sql.gold(sql.DISTURBED),
    ),
    "contract_columns": f"{sql.gold()} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c not in _ABSENT} AS present,"
        f" {'CAST(0 * count(*) AS BIGINT)' if c in _ABSENT else f'count({c})'} AS filled FROM gold"
        for c in EXPECTED.columns
    ),
}
