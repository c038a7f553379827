"""Fusing sources."""

import datetime
import itertools
import random
from dataclasses import replace

import pytest

from builders import silver_rows
from monthfusion.contracts import COUNTY_MONTH, COUNTY_MONTH_TABLE, county_source
from monthfusion.operators.fuse import fuse, key_universe

SOURCES = ("bird", "horse", "mosquito")


def silver(spark, **rows):
    return {n: silver_rows(spark, n, *rows.get(n, [])) for n in SOURCES}


def one(spark, align="left", **rows):
    (row,) = fuse(silver(spark, **rows), COUNTY_MONTH, align).collect()
    return row


def test_columns_are_the_published_ones(spark):
    gold = fuse(silver(spark), COUNTY_MONTH)
    assert tuple(gold.columns) == COUNTY_MONTH_TABLE.columns and len(gold.columns) == 35


@pytest.mark.parametrize("align", ["left", "full"])
def test_missing_is_not_zero(spark, align):
    row = one(spark, align, bird=[{"bird_count": 0}], mosquito=[{"mosquito_count": None}])
    assert (row.bird_reported, row.horse_reported, row.mosquito_reported) == (True, False, False)
    assert (row.bird_count, row.horse_count, row.mosquito_count) == (0, None, None)
    assert (row.reported_activity_types, row.total_reported_non_human_activity) == (1, 0)
    assert (row.bird_source_file, row.horse_source_file) == ("bird.csv", None)


def test_precedence_is_per_column_and_units_follow_the_choice(spark):
    row = one(
        spark,
        bird=[{"wind_u_1m_shift": 3.0, "wind_v_1m_shift": 4.0, "temperature_k_1m_shift": None}],
        horse=[{"temperature_k_1m_shift": 280.0, "land_area_2010": 7.0}],
        mosquito=[{"wind_u_1m_shift": 12.0, "wind_v_1m_shift": None, "wind_speed_1m_shift": 99.0,
                   "temperature_k_1m_shift": None, "land_area_2010": None, "precipitation_m_1m_shift": None}],
    )
    assert (row.wind_u_1m_shift, row.wind_v_1m_shift) == (12.0, 4.0)
    assert row.wind_speed_1m_shift == (144.0 + 16.0) ** 0.5
    assert row.temperature_c_1m_shift == 280.0 - 273.15
    assert row.land_area_2010 == 1.0  # bird comes before horse
    assert row.precipitation_mm_1m_shift == 1000.0


def test_latest_time_skips_missing_sources(spark):
    late = datetime.datetime(2024, 5, 1)
    assert one(spark, bird=[{}], horse=[{"latest_ingested_at": late}]).latest_ingested_at == late


def test_keys_of_any_source(spark):
    frames = silver(
        spark,
        bird=[{}, {"county": "Cook"}],
        horse=[{"county": "Cook"}, {"month": 9}],
        mosquito=[{"year": 2003}],
    )
    keys = {tuple(r) for r in key_universe(frames).collect()}
    assert keys == {(2002, 8, "Adams"), (2002, 8, "Cook"), (2002, 9, "Adams"), (2003, 8, "Adams")}


def flags(row):
    return row.fips_consistent, row.coordinates_consistent, row.weather_consistent


@pytest.mark.parametrize(
    "horse, want",
    [
        ({}, (True, True, True)),
        ({"county_fips": 17003}, (False, True, True)),
        ({"county_fips": None}, (True, True, True)),
        ({"latitude": 1.0 + 2e-7}, (True, False, True)),
        ({"latitude": 1.0 + 5e-8}, (True, True, True)),
        ({"longitude": 2.0}, (True, False, True)),
        ({"longitude": None}, (True, True, True)),
        ({"longitude": 2.0, "latitude": None}, (True, True, True)),
        ({"temperature_k_1m_shift": 1.1}, (True, True, False)),
        ({"precipitation_m_1m_shift": 1.1}, (True, True, False)),
        ({"precipitation_m_1m_shift": float("nan")}, (True, True, False)),
        ({"wind_u_1m_shift": 5.0, "snowfall_1m_shift": 5.0, "land_area_2010": 5.0}, (True, True, True)),
    ],
)
def test_agreement_of_two(spark, horse, want):
    assert flags(one(spark, bird=[{}], horse=[horse])) == want


def test_one_source_always_agrees_with_itself(spark):
    nan = float("nan")
    assert flags(one(spark, bird=[{"temperature_k_1m_shift": nan, "latitude": nan}])) == (True, True, True)


def apart(a, b):
    if a is None or b is None:
        return False
    d = abs(a - b)
    return d != d or d > 1e-7  # NaN is larger than any number


def expected_flags(rows):
    fips = coordinates = weather = True
    for a, b in itertools.combinations(rows, 2):
        if None not in (a["county_fips"], b["county_fips"]) and a["county_fips"] != b["county_fips"]:
            fips = False
        if None not in (a["latitude"], b["latitude"]):
            coordinates &= not (apart(a["latitude"], b["latitude"]) or apart(a["longitude"], b["longitude"]))
        for c in ("temperature_k_1m_shift", "precipitation_m_1m_shift"):
            weather &= not apart(a[c], b[c])
    return fips, coordinates, weather


def test_agreement_equals_pairwise_comparison(spark):
    rng = random.Random(3)
    values = [None, 1.0, 1.0, 1.0 + 9e-8, 1.0 + 1.5e-7, float("nan")]
    names = ("latitude", "longitude", "temperature_k_1m_shift", "precipitation_m_1m_shift")
    rows = {n: [] for n in SOURCES}
    for i in range(200):
        for n in SOURCES:
            if rng.random() < 0.8:
                change = {c: rng.choice(values) for c in names}
                rows[n].append({**change, "county": str(i), "county_fips": rng.choice([1, 1, 1, 2, None])})
    got = {r.county: flags(r) for r in fuse(silver(spark, **rows), COUNTY_MONTH, "full").collect()}
    by_county = {}
    for n in SOURCES:
        for r in rows[n]:
            by_county.setdefault(r["county"], []).append(r)
    assert got == {k: expected_flags(v) for k, v in by_county.items()}
    assert len(set(got.values())) == 8


def test_alignments_give_the_same_rows(spark):
    rng = random.Random(5)
    rows = {
        n: [{"county": str(c), "month": m} for c in range(6) for m in range(1, 5) if rng.random() < 0.6]
        for n in SOURCES
    }
    frames = silver(spark, **rows)
    left = sorted(map(repr, fuse(frames, COUNTY_MONTH, "left").collect()))
    full = sorted(map(repr, fuse(frames, COUNTY_MONTH, "full").collect()))
    assert left == full and len(left) > 20


def test_incomplete_keys_meet_no_source(spark):
    frames = silver(spark, bird=[{"county": None}], horse=[{"county": None}])
    (row,) = fuse(frames, COUNTY_MONTH, "left").collect()
    assert (row.year, row.county, row.bird_count, row.bird_reported) == (2002, None, None, False)


@pytest.mark.parametrize("names", [("bird",), ("bird", "horse"), ("bird", "horse", "mosquito", "crow")])
def test_any_number_of_sources(spark, names):
    contract = replace(
        COUNTY_MONTH,
        sources=tuple(county_source(n, n.title()) for n in names),
        precedence=tuple(reversed(names)),
    )
    frames = {n: silver_rows(spark, n, {f"{n}_count": i}) for i, n in enumerate(names, 1)}
    for align in ("left", "full"):
        (row,) = fuse(frames, contract, align).collect()
        assert row.reported_activity_types == len(names)
        assert row.total_reported_non_human_activity == sum(range(1, len(names) + 1))
        assert flags(row) == (True, True, True)
        assert row[f"{names[-1]}_source_file"] == f"{names[-1]}.csv"


def test_sources_may_have_different_attributes(spark):
    """What only a later source declares is fused too, with its unit."""
    bird, horse, mosquito = COUNTY_MONTH.sources
    rain = [a for a in bird.attributes if a.name == "precipitation_m_1m_shift"]
    plain = replace(bird, attributes=tuple(a for a in bird.attributes if a not in rain), derived=())
    contract = replace(COUNTY_MONTH, sources=(plain, replace(horse, attributes=horse.attributes[:2], derived=()), mosquito))
    tables = silver(spark, bird=[{"latitude": 2.0}], horse=[{"latitude": 9.0}], mosquito=[{"precipitation_m_1m_shift": 0.5, "latitude": None}])
    kept = {"bird": contract.sources[0], "horse": contract.sources[1], "mosquito": mosquito}
    for name, s in kept.items():
        names = [x.name for x in (*s.attributes, *s.derived)]
        tables[name] = tables[name].select("year", "month", "county", s.count_column, *names, "source_file", "latest_ingested_at")
    (row,) = fuse(tables, contract, "full").collect()
    assert set(row.asDict()) == set(COUNTY_MONTH_TABLE.columns)
    assert (row.precipitation_m_1m_shift, row.precipitation_mm_1m_shift) == (0.5, 500.0)
    assert row.latitude == 2.0 and row.wind_u_1m_shift == 1.0
