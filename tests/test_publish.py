"""Row rules and all-or-nothing publishing."""

import pytest

from builders import BIRD, raw_rows, silver_rows
from monthfusion.contracts import COUNTY_MONTH
from monthfusion.operators.collapse import collapse
from monthfusion.operators.expectations import (
    Expectation,
    ExpectationFailed,
    check,
    gold_expectations,
    silver_expectations,
)
from monthfusion.operators.fuse import fuse
from monthfusion.sources.published import PublishedTable

POSITIVE = [Expectation("positive", "x > 0")]


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def failed(spark, *changes):
    silver = collapse(raw_rows(spark, *changes), BIRD)
    rows = check(silver, silver_expectations(BIRD)).collect()
    assert {r.total_rows for r in rows} == {silver.count()}
    return {r.rule: r.failed_rows for r in rows if r.failed_rows}


def test_silver_rules(spark):
    assert failed(spark, {}) == {}
    assert failed(spark, {"Year": 2001}) == {"valid_bird_key": 1}
    assert failed(spark, {"Year": 2101}, {"Month": 13}, {"County": None}, {"Month": 0}) == {"valid_bird_key": 4}
    assert failed(spark, {"County": "  "}) == {}  # blank is not NULL
    assert failed(spark, {"Bird": -1}) == {"valid_bird_count": 1}
    assert failed(spark, {"Bird": None}) == {"valid_bird_count": 1}
    assert failed(spark, {"Bird": 1}, {"Bird": 2}) == {"consistent_bird_group": 1}


def test_gold_rules(spark):
    frames = {s.name: silver_rows(spark, s.name, {}) for s in COUNTY_MONTH.sources}
    frames["horse"] = silver_rows(spark, "horse", {"county_fips": 2, "latitude": 2.0}, {"year": 1999})
    rows = check(fuse(frames, COUNTY_MONTH), gold_expectations(COUNTY_MONTH)).collect()
    assert {r.rule: r.failed_rows for r in rows} == {
        "valid_gold_key": 1,
        "consistent_cross_source_fips": 1,
        "consistent_cross_source_coordinates": 1,
        "consistent_cross_source_weather": 0,
    }


def test_a_refused_update_leaves_the_earlier_version(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), "t")
    with pytest.raises(LookupError):
        table.read()
    assert table.publish(numbers(spark, 1, 2), POSITIVE, comment="it's first") == 1
    with pytest.raises(ExpectationFailed) as refused:
        table.publish(numbers(spark, 3, 0, None), POSITIVE)
    assert refused.value.failed == {"positive": 2}
    assert "t violates positive: 2 rows" in str(refused.value)
    assert sorted(r.x for r in table.read().collect()) == [1, 2]
    assert (table.current_version(), table.comment()) == (1, "it's first")
    assert table.publish(numbers(spark, 7), POSITIVE, comment="second") == 2
    assert [r.x for r in table.read().collect()] == [7]
    assert [(r.version, r.row_count) for r in table.versions().orderBy("version").collect()] == [(1, 2), (2, 1)]


def test_an_update_may_read_the_version_it_replaces(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), "t")
    table.publish(numbers(spark, 1), POSITIVE)
    table.publish(table.read().unionByName(numbers(spark, 2)), POSITIVE)
    assert sorted(r.x for r in table.read().collect()) == [1, 2]


def test_no_rows_break_no_rule(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), "t")
    table.publish(numbers(spark), POSITIVE)
    assert table.read().columns == ["x"] and table.read().count() == 0


def test_examples_name_the_keys(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), "silver_bird")
    silver = collapse(raw_rows(spark, {"Bird": -1}), BIRD)
    with pytest.raises(ExpectationFailed, match="2002/8/Adams"):
        table.publish(silver, silver_expectations(BIRD))


def test_catalog_entry_follows_the_current_version(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), "t")
    table.publish(numbers(spark, 1), comment="bird's table")
    table.register("published_numbers")
    assert spark.table("published_numbers").collect()[0].x == 1
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED published_numbers").collect()}
    assert described["Comment"] == "bird's table"
    table.publish(numbers(spark, 2))
    table.register("published_numbers")
    assert spark.table("published_numbers").collect()[0].x == 2
    spark.sql("DROP VIEW published_numbers")
