"""Consumer checks on the fused table."""

from dataclasses import replace

from builders import silver_rows
from monthfusion.contracts import COUNTY_MONTH, COUNTY_MONTH_TABLE, column_comments
from monthfusion.operators.checks import check_described, column_presence, contract_checks, described_columns
from monthfusion.operators.fuse import fuse
from monthfusion.sources.published import PublishedTable

EXPECTED = replace(COUNTY_MONTH_TABLE, row_count=2, first_year=2002, last_year=2003, county_count=1)


def gold(spark, *birds):
    frames = {s.name: silver_rows(spark, s.name) for s in COUNTY_MONTH.sources}
    return fuse({**frames, "bird": silver_rows(spark, "bird", *birds)}, COUNTY_MONTH)


def outcome(df, expected=EXPECTED):
    return {r.check: (r.observed, r.passed) for r in contract_checks(df, expected).collect()}


def test_contract_is_well_formed():
    columns = COUNTY_MONTH_TABLE.columns
    assert len(columns) == len(set(columns)) == 35
    assert {"year", "month", "county"} <= set(columns)
    for s in ("bird", "horse", "mosquito"):
        assert {f"{s}_count", f"{s}_reported"} <= set(columns)
    assert set(COUNTY_MONTH_TABLE.flags) == {"fips_consistent", "coordinates_consistent", "weather_consistent"}
    assert COUNTY_MONTH_TABLE.row_count > 0
    assert COUNTY_MONTH_TABLE.first_year < COUNTY_MONTH_TABLE.last_year


def test_a_good_table_passes(spark):
    got = outcome(gold(spark, {}, {"year": 2003}))
    assert all(passed for _, passed in got.values()) and len(got) == 8


def test_each_check_can_fail(spark):
    good = gold(spark, {}, {"year": 2003})
    assert outcome(good.unionByName(good))["unique_keys"] == (2, False)
    assert outcome(good.unionByName(good))["row_count"] == (4, False)
    wider = gold(spark, {"year": 2001}, {"year": 2004, "county": "Cook"})
    assert outcome(wider)["first_year"] == (2001, False)
    assert outcome(wider)["last_year"] == (2004, False)
    assert outcome(wider)["county_count"] == (2, False)
    lost = good.selectExpr("* EXCEPT (county)", "CASE WHEN year = 2002 THEN county END AS county")
    assert outcome(lost)["null_keys"] == (1, False)
    wrong = good.selectExpr("* EXCEPT (fips_consistent)", "year = 2002 AS fips_consistent")
    assert outcome(wrong)["flags"] == (1, False)
    assert outcome(good.drop("snowfall_1m_shift"))["missing_columns"] == (1, False)


def test_no_rows(spark):
    got = outcome(gold(spark))
    assert got["row_count"] == (0, False) and got["first_year"] == (None, False)
    assert got["unique_keys"] == (0, True)


def test_columns(spark):
    present = {r.column: (r.present, r.filled) for r in column_presence(gold(spark, {}).drop("latitude"), EXPECTED).collect()}
    assert present["latitude"] == (False, 0)
    assert present["bird_count"] == (True, 1) and present["horse_count"] == (True, 0)


def test_registered_tables_are_described(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), "gold")
    table.publish(gold(spark, {}).drop("latitude"), comment="told")
    table.register("told_gold", column_comments(COUNTY_MONTH))
    found = {r.column: (r.type, r.comment) for r in described_columns(spark, "told_gold").collect()}
    assert list(found) == [c for c in COUNTY_MONTH_TABLE.columns if c != "latitude"]
    assert found["bird_count"] == ("bigint", "Bird as reported; NULL where bird has no report")
    assert found["observation_month"] == ("date", None)
    rows = {r.column: (r.type, r.filled) for r in check_described(spark, "told_gold", COUNTY_MONTH_TABLE).collect()}
    assert len(rows) == 35 and rows["latitude"] == (None, 0) and rows["bird_count"] == ("bigint", 1)
    told = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED told_gold").collect()}
    assert told["Comment"] == "told"
    spark.sql("DROP VIEW told_gold")
