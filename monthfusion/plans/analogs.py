"""County-month sources derived from order tables.

The engine's own data set is not public, so its three sources are stood in for
by orders and line items: a nation plays the county, a month of orders the
report.  Every fact row becomes one raw row, and rows of one key repeat the same
values, as enriched source files do.  All numbers are sums of powers of two, so any
engine gets the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.contracts import COUNTY_MONTH
from monthfusion.sources.scratch import scratch_dir

# Order dates start in 1995, before the first year of the real data set.
CONTRACT = COUNTY_MONTH.with_years(1990, 2100)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_nation(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """Customers or suppliers with their nation.

    Joined before the facts, so that facts are never shuffled by the few nations.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return table(spark, sf_dir, name).join(nation, F.expr(f"{key} = n_nationkey"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month and the customer's nation."""
    people = _with_nation(spark, sf_dir, "customer", "c_nationkey")
    return (
        table(spark, sf_dir, "orders")
        .join(people, F.expr("o_custkey = c_custkey"))
        .selectExpr(
            "year(o_orderdate) AS Year",
            "month(o_orderdate) AS Month",
            "n_nationkey",
            "n_name",
            "1 AS weight",
            "o_orderkey % 3 AS file_no",
            "o_orderkey",
        )
    )


def _lines(spark: SparkSession, sf_dir: str, weight: str) -> DataFrame:
    """Line items by month and the supplier's nation."""
    people = _with_nation(spark, sf_dir, "supplier", "s_nationkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(people, F.expr("l_suppkey = s_suppkey"))
        .selectExpr(
            "year(l_shipdate) AS Year",
            "month(l_shipdate) AS Month",
            "n_nationkey",
            "n_name",
            f"{weight} AS weight",
            "l_linenumber % 3 AS file_no",
        )
    )


def enrich(facts: DataFrame, slot: str, outcome: str, *kept: str) -> DataFrame:
    """Raw source columns for fact rows."""
    day = [s.name for s in CONTRACT.sources].index(slot)
    rain = "Month * 0.0009765625D"
    if slot == "mosquito":
        rain = f"CASE WHEN n_nationkey % 7 <> 3 THEN {rain} END"
    return facts.selectExpr(
        "Year",
        "Month",
        "concat(' ', lower(replace(n_name, '_', ' ')), ' ') AS County",
        f"CAST({outcome} AS BIGINT) AS {CONTRACT.source(slot).outcome}",
        "make_date(Year, Month, 1) AS Date",
        "CAST(17001 + 2 * n_nationkey AS DOUBLE) AS FIPS",
        "37D + n_nationkey * 0.125D AS County_Seat_Latitude",
        "-91.5D + n_nationkey * 0.25D AS County_Seat_Longitude",
        "100D * (n_nationkey + 1) AS Land_Area_2010",
        "CAST(n_nationkey % 5 AS DOUBLE) AS Avian_Phylodiversity",
        "(Month - 6) * 0.25D AS u10_1m_shift",
        "n_nationkey * 0.125D AS v10_1m_shift",
        "270D + Month + n_nationkey * 0.5D AS t2m_1m_shift",
        f"{rain} AS tp_1m_shift",
        "CASE WHEN Month IN (12, 1, 2) THEN 0.5D ELSE 0D END AS sf_1m_shift",
        "Month * 0.0625D AS sro_1m_shift",
        "2D + Month * 0.125D AS lai_hv_1m_shift",
        "1D + Month * 0.125D AS lai_lv_1m_shift",
        "0.25D AS src_1m_shift",
        f"concat('file:///landing/{slot}/', file_no, '.csv') AS source_file",
        f"make_timestamp(2024, 1, 1 + (n_nationkey + {day}) % 3, Month, 0, 0) AS ingested_at",
        *kept,
    )


def _facts(spark: SparkSession, sf_dir: str, slot: str) -> DataFrame:
    """The facts of a slot; open line items weigh nothing in the mosquito slot."""
    if slot == "bird":
        return _orders(spark, sf_dir)
    return _lines(spark, sf_dir, "CAST(l_linestatus = 'F' AS INT)" if slot == "mosquito" else "1")


def source(spark: SparkSession, sf_dir: str, slot: str) -> DataFrame:
    """A consistent slot: the outcome is the weight of all facts of its key.

    The totals, one row per month and nation, are written to the shared folder, so they are
    summed once however often the slot is read, and Spark knows how small they are: facts
    are joined with them where they lie.  A window over the key would put all rows of a hot
    key into one task.
    """
    facts = _facts(spark, sf_dir, slot)
    key = ["Year", "Month", "n_nationkey"]
    folder = scratch_dir(spark, f"totals-{slot}")
    sums = facts.groupBy(*key).agg(F.sum("weight").alias("total"))
    sums.write.parquet(folder)
    # Facts without a date have a total too.
    totals = spark.read.schema(sums.schema).parquet(folder).withColumnsRenamed({c: f"total_{c}" for c in key})
    same = " AND ".join(f"{c} <=> total_{c}" for c in key)
    return enrich(facts.join(totals, F.expr(same)), slot, "total")


def raw_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bird slot with one outcome per order: most keys contradict themselves."""
    return enrich(_orders(spark, sf_dir), "bird", "o_orderkey % 4", "o_orderkey", "n_nationkey")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, as a file reader delivers it."""
    return df.selectExpr(*(f"CAST(`{c}` AS STRING) AS `{c}`" for c in df.columns))


def all_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {s.name: source(spark, sf_dir, s.name) for s in CONTRACT.sources}


def nation_of_row() -> Column:
    """The nation key behind a raw row."""
    return ((F.col("FIPS") - 17001) / 2).cast("int")


def disturbed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three slots with disagreements in single nations.

    Shifts of 2**-20 lie above the tolerance of 1e-7, shifts of 2**-30 below.
    """
    found = all_sources(spark, sf_dir)
    n = nation_of_row()

    def moved(name: str, *shifts: tuple[int, float | None]) -> Column:
        value = F.col(name)
        for nation, shift in shifts:
            new = F.lit(None).cast("double") if shift is None else F.col(name) + shift
            value = F.when(n == nation, new).otherwise(value)
        return value

    found["bird"] = found["bird"].withColumns(
        {
            "County_Seat_Latitude": moved("County_Seat_Latitude", (1, 2.0**-20), (2, 2.0**-30)),
            "County_Seat_Longitude": moved("County_Seat_Longitude", (6, 2.0**-20), (7, None), (8, 1.0)),
            "t2m_1m_shift": moved("t2m_1m_shift", (4, 2.0**-20), (9, 2.0**-30)),
        }
    )
    found["horse"] = found["horse"].withColumns(
        {
            "tp_1m_shift": moved("tp_1m_shift", (5, 2.0**-20), (10, None)),
            "County_Seat_Latitude": moved("County_Seat_Latitude", (8, None)),
        }
    )
    found["mosquito"] = found["mosquito"].withColumns(
        {
            "FIPS": moved("FIPS", (3, 2.0)),
            "County_Seat_Latitude": moved("County_Seat_Latitude", (8, None)),
        }
    )
    return found
