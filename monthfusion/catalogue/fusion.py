"""Queries for cleaning and fusing sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.catalogue import sql
from monthfusion.contracts import KEY
from monthfusion.functions.keys import county_fold, county_title, month_start
from monthfusion.operators.collapse import GATE, collapse, distinct_value_max
from monthfusion.operators.fuse import align_left, fuse, key_universe
from monthfusion.plans.analogs import (
    CONTRACT,
    all_sources,
    disturbed,
    nation_of_row,
    raw_outcomes,
    source,
    table,
)


def iso(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, which every engine prints alike."""
    formats = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss"}
    return df.withColumns(
        {c: F.date_format(c, formats[t]) for c, t in df.dtypes if t in formats}
    )


def silver(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {s.name: collapse(raw[s.name], s, GATE) for s in CONTRACT.sources}


def fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of the three undisturbed slots, with its own column types."""
    return fuse(silver(all_sources(spark, sf_dir)), CONTRACT, align="full")


def fused_disturbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse(silver(disturbed(spark, sf_dir)), CONTRACT, align="full")


def gold_fusion(spark, sf_dir):
    return iso(fused(spark, sf_dir))


def gold_fusion_left_joins(spark, sf_dir):
    return iso(fuse(silver(all_sources(spark, sf_dir)), CONTRACT, align="left"))


def silver_collapse(spark, sf_dir):
    return iso(collapse(source(spark, sf_dir, "bird"), CONTRACT.source("bird")))


def silver_collapse_conflicting(spark, sf_dir):
    return iso(collapse(raw_outcomes(spark, sf_dir), CONTRACT.source("bird")))


def silver_units(spark, sf_dir):
    units = ("wind_speed_1m_shift", "temperature_c_1m_shift", "precipitation_mm_1m_shift")
    parts = [
        df.select(F.lit(name).alias("source"), *KEY, *units)
        for name, df in silver(all_sources(spark, sf_dir)).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def group_distinct_max(spark, sf_dir):
    return distinct_value_max(raw_outcomes(spark, sf_dir), CONTRACT.source("bird"))


def universe(spark, sf_dir):
    return key_universe(silver(all_sources(spark, sf_dir)))


def left_join_sources(spark, sf_dir):
    wide = align_left(silver(all_sources(spark, sf_dir)))
    return wide.select(*KEY, *(F.col(f"{s}__{s}_count").alias(f"{s}_count") for s in sql.SLOTS))


def observation_month(spark, sf_dir):
    """Months 0 and 13 occur in nations 0 and 1 and have no date."""
    n = nation_of_row()
    month = F.when(n == 0, 0).when(n == 1, 13).otherwise(F.col("Month"))
    raw = source(spark, sf_dir, "bird").withColumn("Month", month)
    keys = raw.select("Year", "Month", "County").distinct()
    return iso(
        keys.select(
            F.col("Year").alias("year"),
            F.col("Month").alias("month"),
            F.expr(county_title("County")).alias("county"),
            F.expr(month_start("Year", "Month")).alias("observation_month"),
        )
    )


def county_normalize(spark, sf_dir):
    text = "concat(' ', upper(c_name), '  ', c_mktsegment, 'x ')"
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{county_title(text)} AS title", f"{county_fold(text)} AS folded"
    )


def star_except_rename(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "Order Priority")
    return orders.selectExpr("* EXCEPT (`Order Priority`, o_orderdate)", "`Order Priority` AS order_priority")


def gold_part(*columns: str):
    def query(spark, sf_dir):
        return iso(fused(spark, sf_dir).select(*KEY, *columns))

    return query


def consistency_flags(spark, sf_dir):
    flags = (a.name for a in CONTRACT.agreements)
    return fused_disturbed(spark, sf_dir).select(*KEY, *flags)



REPORTED = (*(f"{s}_reported" for s in sql.SLOTS), "reported_activity_types")
LINEAGE = tuple(f"{s}_source_file" for s in sql.SLOTS)

QUERIES = {
    "gold_fusion": gold_fusion,
    "gold_fusion_left_joins": gold_fusion_left_joins,
    "silver_collapse": silver_collapse,
    "silver_collapse_conflicting": silver_collapse_conflicting,
    "silver_units": silver_units,
    "group_distinct_max": group_distinct_max,
    "key_universe": universe,
    "left_join_sources": left_join_sources,
    "observation_month": observation_month,
    "county_normalize": county_normalize,
    "star_except_rename": star_except_rename,
    "reported_flags": gold_part(*REPORTED),
    "total_activity": gold_part(CONTRACT.total_column),
    "precedence_coalesce": gold_part("county_fips", "precipitation_m_1m_shift", "wind_speed_1m_shift"),
    "latest_ingested": gold_part("latest_ingested_at"),
    "lineage_columns": gold_part(*LINEAGE),
    "consistency_flags": consistency_flags,
}


def _iso_sql(columns) -> str:
    """Select list with dates and times as text."""
    forms = {
        "observation_month": "strftime(observation_month, '%Y-%m-%d') AS observation_month",
        "latest_ingested_at": "strftime(latest_ingested_at, '%Y-%m-%d %H:%M:%S') AS latest_ingested_at",
    }
    return ", ".join(forms.get(c, c) for c in columns)


def _gold_sql(columns, rows=None) -> str:
    return f"{sql.gold(rows)} SELECT {_iso_sql(columns)} FROM gold"


_SILVER = (
    *("year", "month", "observation_month", "county", "county_fips", "bird_count"),
    *(c for c in sql.attribute_order(CONTRACT.source("bird")) if c != "county_fips"),
    *("source_row_count", "distinct_value_max", "source_file", "latest_ingested_at"),
)
_COUNTS = ", ".join(f"{s}_count" for s in sql.SLOTS)
_NAME = "' ' || upper(c_name) || '  ' || c_mktsegment || 'x '"

ORACLES = {
    "gold_fusion": _gold_sql(sql.GOLD_COLUMNS),
    "gold_fusion_left_joins": _gold_sql(sql.GOLD_COLUMNS),
    "silver_collapse": f"SELECT {_iso_sql(_SILVER)} FROM ({sql.silver('bird')})",
    "silver_collapse_conflicting": f"SELECT {_iso_sql(_SILVER)} FROM ({sql.silver('bird', sql.RAW_OUTCOMES)})",
    "silver_units": " UNION ALL ".join(
        f"SELECT '{s}' AS source, year, month, county, wind_speed_1m_shift,"
        f" temperature_c_1m_shift, precipitation_mm_1m_shift FROM ({sql.silver(s)})"
        for s in sql.SLOTS
    ),
    "group_distinct_max": f"SELECT year, month, county, source_row_count, distinct_value_max FROM ({sql.silver('bird', sql.RAW_OUTCOMES)})",
    "key_universe": f"{sql.sources()} SELECT year, month, county FROM keys",
    "left_join_sources": f"{sql.sources()} SELECT year, month, county, {_COUNTS} FROM {sql.JOINED}",
    "observation_month": f"""
        SELECT DISTINCT y AS year, CASE n WHEN 0 THEN 0 WHEN 1 THEN 13 ELSE m END AS month,
               'Nation ' || n AS county,
               CASE WHEN n > 1 THEN strftime(make_date(y, m, 1), '%Y-%m-%d') END AS observation_month
        FROM ({sql.FACTS['bird']})""",
    "county_normalize": f"""
        SELECT c_custkey, {sql.TITLE.format(c='text')} AS title, lower(trim(text)) AS folded
        FROM (SELECT c_custkey, {_NAME} AS text FROM customer)""",
    "star_except_rename": "SELECT * EXCLUDE (o_orderpriority, o_orderdate), o_orderpriority AS order_priority FROM orders",
    "reported_flags": _gold_sql((*KEY, *REPORTED)),
    "total_activity": _gold_sql((*KEY, CONTRACT.total_column)),
    "precedence_coalesce": _gold_sql(
        (*KEY, "county_fips", "precipitation_m_1m_shift", "wind_speed_1m_shift")
    ),
    "latest_ingested": _gold_sql((*KEY, "latest_ingested_at")),
    "lineage_columns": _gold_sql((*KEY, *LINEAGE)),
    "consistency_flags": _gold_sql((*KEY, *(a.name for a in CONTRACT.agreements)), sql.DISTURBED),
}
