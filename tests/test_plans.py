"""The plans Spark makes: shuffles, pushed filters, no Python, no cross joins."""

import duckdb
import pytest
from pyspark.sql import functions as F

from builders import BIRD
from compare import oracle
from monthfusion.catalogue import ORACLES, QUERIES
from monthfusion.catalogue.fusion import silver
from monthfusion.operators.collapse import EXACT, GATE, collapse, distinct_value_max
from monthfusion.operators.fuse import fuse
from monthfusion.plans.analogs import CONTRACT, all_sources, raw_outcomes, source

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def bronze(spark, tmp_path):
    path = str(tmp_path / "bronze")
    raw_outcomes(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_gate_shuffles_once_and_reads_what_it_needs(bronze):
    text = plan(collapse(bronze, BIRD, GATE))
    assert text.count("Exchange") == 1 and "Expand" not in text and "partial_max" in text
    schema = text.split("ReadSchema")[1]
    assert "Date" not in schema and "src_1m_shift" not in schema


@pytest.mark.parametrize("count", [lambda df: collapse(df, BIRD, EXACT), lambda df: distinct_value_max(df, BIRD)])
def test_exact_count_expands_combined_rows_only(bronze, count):
    text = plan(count(bronze))
    # The plan prints the last step first: the expansion must come above (after)
    # the shuffle that follows the removal of repeats.
    assert 0 < text.index("Expand") < text.rindex("Exchange")


def test_unused_gate_costs_nothing(bronze):
    text = plan(collapse(bronze, BIRD, EXACT).drop("distinct_value_max"))
    assert "Expand" not in text


def test_full_alignment_reads_each_source_once(spark, tmp_path, no_broadcast):
    frames = {}
    for name, df in silver(all_sources(spark, SMALL)).items():
        df.write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    full, left = (plan(fuse(frames, CONTRACT, a)) for a in ("full", "left"))
    assert full.count("Exchange") == 4 == left.count("Exchange")
    assert full.count("FileScan") == 3 and left.count("FileScan") == 6


def test_a_slot_is_one_scan_and_one_shuffle(spark):
    """All facts, read once; only what dimension tables need is sent to all tasks."""
    for slot, facts in (("bird", "orders"), ("horse", "lineitem"), ("mosquito", "lineitem")):
        rows = source(spark, SMALL, slot)
        assert rows.count() == spark.read.parquet(f"{SMALL}/{facts}.parquet").count()
        text = plan(collapse(rows, CONTRACT.source(slot), GATE))
        assert text.count(f"{facts}.parquet") == 1 and text.count("Exchange hashpartitioning") == 1


def test_a_slot_reports_every_month_with_the_weight_of_all_its_facts(spark):
    """Whole months of all facts: an outcome is the number of facts of its key, in the mosquito
    slot that of closed line items, so some are zero."""
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    weights = {"bird": spark.read.parquet(f"{SMALL}/orders.parquet").count(), "horse": lines.count(), "mosquito": lines.where("l_linestatus = 'F'").count()}
    keys = {}
    for s, df in all_sources(spark, SMALL).items():
        outcome = CONTRACT.source(s).outcome
        keys[s] = df.groupBy("Year", "Month", "FIPS").agg(F.max(outcome).alias("most"), F.min(outcome).alias("least"), F.count("*").alias("n")).cache()
        assert keys[s].where("most <> least").count() == 0
        assert keys[s].agg(F.sum("most")).first()[0] == weights[s]
    assert all(df.where("most <> n").count() == 0 for df in (keys["bird"], keys["horse"]))
    months = [df.select("Year", "Month", "FIPS") for df in (keys["horse"], keys["mosquito"])]
    assert months[0].exceptAll(months[1]).count() == 0 == months[1].exceptAll(months[0]).count()
    assert 0 < keys["mosquito"].where("most = 0").count() < keys["mosquito"].count()


LAZY = [n for n in QUERIES if not n.startswith(("bronze_", "csv_", "update_", "publish_", "missing_", "validate_all", "validate_headers", "described_columns"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Window", "MapPartitions"):
        assert node not in text


def test_queries_and_their_sql_sum_whole_months(spark, tmp_path):
    """Two open lines in March, a closed one in May: no fact and no month is left out on either side."""
    con = duckdb.connect()
    tables = {
        "nation": "SELECT 2 AS n_nationkey, 'NATION_2' AS n_name",
        "customer": "SELECT 1::BIGINT AS c_custkey, 2 AS c_nationkey",
        "supplier": "SELECT 1::BIGINT AS s_suppkey, 2 AS s_nationkey",
        "orders": "SELECT k::BIGINT AS o_orderkey, 1::BIGINT AS o_custkey, DATE '1996-03-05' AS o_orderdate FROM range(3) r(k)",
        "lineitem": "SELECT k::BIGINT AS l_orderkey, 1::BIGINT AS l_suppkey, 1 AS l_linenumber, s AS l_linestatus, d AS l_shipdate"
        " FROM (VALUES (0, 'O', DATE '1996-03-09'), (1, 'O', DATE '1996-03-10'), (2, 'F', DATE '1996-05-01')) v(k, s, d)",
    }
    for name, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    want = [(1996, 3, 3, 2, 0), (1996, 5, None, 1, 1)]
    _, rows, _ = oracle(ORACLES["left_join_sources"], str(tmp_path))
    assert sorted((r[0], r[1], *r[3:]) for r in rows) == want
    got = QUERIES["left_join_sources"](spark, str(tmp_path)).drop("county").collect()
    assert sorted(tuple(r) for r in got) == want
