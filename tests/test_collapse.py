"""Collapsing repeated rows."""

import datetime
import math
import random

import pytest

from builders import BIRD, raw_rows
from monthfusion.operators.collapse import EXACT, GATE, collapse, distinct_value_max


@pytest.mark.parametrize("distinct", [EXACT, GATE])
def test_identical_rows_become_one(spark, distinct):
    later = datetime.datetime(2024, 2, 1)
    rows = raw_rows(
        spark,
        {"u10_1m_shift": 3.0, "v10_1m_shift": 4.0, "t2m_1m_shift": 300.0, "tp_1m_shift": 0.5},
        {"u10_1m_shift": 3.0, "v10_1m_shift": 4.0, "t2m_1m_shift": 300.0, "tp_1m_shift": 0.5,
         "County": " ADAMS ", "source_file": "b.csv", "ingested_at": later},
        FIPS=17001.0,
    )
    (row,) = collapse(rows, BIRD, distinct).collect()
    assert (row.year, row.month, row.county) == (2002, 8, "Adams")
    assert row.observation_month == datetime.date(2002, 8, 1)
    assert (row.county_fips, row.bird_count) == (17001, 2)
    assert row.wind_speed_1m_shift == 5.0
    assert row.temperature_c_1m_shift == 300.0 - 273.15
    assert row.precipitation_mm_1m_shift == 500.0
    assert (row.source_row_count, row.distinct_value_max) == (2, 1)
    assert (row.source_file, row.latest_ingested_at) == ("b.csv", later)
    assert len(row) == 25


def counts(spark, rows, distinct):
    return collapse(rows, BIRD, distinct).first().distinct_value_max


def test_disagreement_is_counted(spark):
    rows = raw_rows(spark, {"Bird": 1}, {"Bird": 2}, {"Bird": 3}, {"FIPS": 9.0})
    assert counts(spark, rows, EXACT) == 3
    assert counts(spark, rows, GATE) == 2
    assert distinct_value_max(rows, BIRD).first().distinct_value_max == 3


def test_null_is_no_value_and_nan_is_one(spark):
    rows = raw_rows(spark, {"tp_1m_shift": None}, {"tp_1m_shift": 5.0})
    assert counts(spark, rows, EXACT) == counts(spark, rows, GATE) == 1
    rows = raw_rows(spark, {"tp_1m_shift": math.nan}, {"tp_1m_shift": math.nan})
    assert counts(spark, rows, EXACT) == counts(spark, rows, GATE) == 1
    empty = {a.raw: None for a in BIRD.attributes} | {"Bird": None}
    rows = raw_rows(spark, empty, empty)
    assert counts(spark, rows, EXACT) == counts(spark, rows, GATE) == 0


def test_impossible_month_has_no_date(spark):
    row = collapse(raw_rows(spark, {"Month": 13}), BIRD, GATE).first()
    assert row.month == 13 and row.observation_month is None


def test_exact_and_gate_agree_on_random_rows(spark):
    rng = random.Random(7)
    changes = [
        {
            "County": rng.choice([" adams", "Cook ", "lake", None]),
            "Month": rng.randint(1, 3),
            "Bird": rng.choice([1, 1, 1, 2, None]),
            "sf_1m_shift": rng.choice([0.0, -0.0, None]),
            "source_file": rng.choice("abc"),
        }
        for _ in range(60)
    ]
    rows = raw_rows(spark, *changes)
    exact = {r[:4]: r for r in collapse(rows, BIRD, EXACT).collect()}
    gate = {r[:4]: r for r in collapse(rows, BIRD, GATE).collect()}
    assert exact.keys() == gate.keys()
    for key, e in exact.items():
        g = gate[key].asDict()
        assert g.pop("distinct_value_max") == min(e.distinct_value_max, 2)
        assert g == {k: v for k, v in e.asDict().items() if k != "distinct_value_max"}
        mine = [c for c in changes if (c["County"] or "").strip().title() == (e.county or "") and c["Month"] == e.month]
        assert e.distinct_value_max == max(len({c["Bird"] for c in mine} - {None}), 1)
        assert e.source_row_count == len(mine)


def test_one_hot_key_is_exact(spark):
    base = raw_rows(spark, {})
    hot = spark.range(30000).selectExpr("id % 1000 AS n").crossJoin(base).drop("Bird").withColumnRenamed("n", "Bird")
    rows = hot.unionByName(raw_rows(spark, {"County": "cook"}))
    got = {r.county: r for r in collapse(rows, BIRD, EXACT).collect()}
    assert (got["Adams"].source_row_count, got["Adams"].distinct_value_max) == (30000, 1000)
    assert (got["Cook"].source_row_count, got["Cook"].distinct_value_max) == (1, 1)


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        collapse(raw_rows(spark, {}), BIRD, "some")
