"""Validation of source files."""

import os
from pathlib import Path

import pytest

from builders import BIRD, csv_text, write_sources
from monthfusion.contracts import COUNTY_MONTH
from monthfusion.operators import validate
from monthfusion.operators.validate import (
    digest,
    ValidationFailed,
    missing_columns,
    validate_all,
    validate_source,
    violations,
)
from monthfusion.sources.csv_files import read_text


def bird_file(tmp_path, *changes, **options):
    path = tmp_path / "bird.csv"
    path.write_text(csv_text("Bird", *changes, **options), encoding="utf-8")
    return str(path)


def report(spark, path):
    return validate_source(spark, path, BIRD).first().asDict()


def refused(spark, path):
    with pytest.raises(ValidationFailed) as e:
        validate_source(spark, path, BIRD)
    return str(e.value)


def test_repeated_rows_are_counted_and_accepted(spark, tmp_path):
    later = {"Year": "2011", "Month": "2", "County": "lake"}
    path = bird_file(tmp_path, {}, later, {}, later, later, {**later, "County": "cook", "tp_1m_shift": ""})
    got = report(spark, path)
    assert (got.pop("source"), got.pop("path")) == ("bird", path)
    assert got == {
        "raw_rows": 6,
        "unique_county_months": 3,
        "duplicate_rows": 3,
        "conflict_groups": 0,
        "incomplete_metadata_rows": 1,
        "minimum_year": 2002,
        "maximum_year": 2011,
        "county_count": 3,
    }


def test_keys_ignore_case_and_outer_space(spark, tmp_path):
    rows = ({"County": "lake"}, {"County": " LAKE "}, {"Year": "2004.9", "Month": " 9 "}, {"County": "cook"})
    got = report(spark, bird_file(tmp_path, *rows, bom=True))
    assert (got["raw_rows"], got["unique_county_months"], got["county_count"]) == (4, 3, 3)
    assert (got["minimum_year"], got["maximum_year"]) == (2002, 2004)


def test_conflicting_duplicates_are_rejected(spark, tmp_path):
    rows = [{}, {"Bird": "3"}, {"Month": "9"}, {"Month": "9", "tp_1m_shift": ""}]
    message = refused(spark, bird_file(tmp_path, *rows))
    assert "2 conflicting county-month groups; e.g. adams 2002-08, adams 2002-09" in message


def test_same_numbers_in_other_spelling_do_not_conflict(spark, tmp_path):
    assert report(spark, bird_file(tmp_path, {}, {"Bird": "2.0", "FIPS": "10e-1"}))["duplicate_rows"] == 1


@pytest.mark.parametrize(
    "change, message",
    [
        ({"Bird": "-2"}, "1 rows negative in 'Bird'"),
        ({"Bird": ""}, "empty_required in 'Bird'"),
        ({"Bird": "many"}, "nonnumeric in 'Bird'"),
        ({"Bird": "inf"}, "nonfinite in 'Bird'"),
        ({"County": "  "}, "empty_required in 'County'"),
        ({"Year": "1899"}, "year_range in 'Year'"),
        ({"Year": "x"}, "nonnumeric in 'Year'"),
        ({"Month": "13"}, "month_range in 'Month'"),
        ({"Month": "0.9"}, "month_range in 'Month'"),
        ({"FIPS": "none"}, "nonnumeric in 'FIPS'"),
        ({"t2m_1m_shift": "nan"}, "nonfinite in 't2m_1m_shift'"),
    ],
)
def test_wrong_values_are_rejected(spark, tmp_path, change, message):
    assert message in refused(spark, bird_file(tmp_path, {}, change))


def test_all_wrong_values_are_listed(spark, tmp_path):
    path = bird_file(tmp_path, {"Bird": "-1", "FIPS": "?"}, {"Month": "13"}, {})
    rows = violations(read_text(spark, path), BIRD).collect()
    assert sorted((r.rule, r.column, r.value, r.month) for r in rows) == [
        ("month_range", "Month", "13", "13"),
        ("negative", "Bird", "-1", "8"),
        ("nonnumeric", "FIPS", "?", "8"),
    ]
    assert all(r.source_file.endswith("bird.csv") for r in rows)


def test_attributes_may_be_empty_or_absent(spark, tmp_path):
    assert report(spark, bird_file(tmp_path, {"sf_1m_shift": " "}, {"County": "x"}))["incomplete_metadata_rows"] == 1
    path = bird_file(tmp_path, {}, {}, without=("src_1m_shift",))
    assert report(spark, path)["incomplete_metadata_rows"] == 2


def test_missing_columns_are_named(spark, tmp_path):
    path = bird_file(tmp_path, {}, without=("Date", "FIPS", "src_1m_shift"))
    assert "missing required columns: Date, FIPS" in refused(spark, path)
    assert missing_columns(["year"], BIRD) == sorted(BIRD.files.required_columns)


def test_absent_and_empty_files(spark, tmp_path):
    assert "no source file" in refused(spark, str(tmp_path / "none.csv"))
    path = tmp_path / "empty.csv"
    path.write_text(csv_text("Bird", {}).splitlines()[0] + "\n")
    assert "no data rows" in refused(spark, str(path))


def test_all_sources_in_order(spark, tmp_path):
    folder = write_sources(tmp_path / "files")
    reports = validate_all(spark, str(folder), COUNTY_MONTH).collect()
    assert [r.source for r in reports] == ["bird", "horse", "mosquito"]
    assert {(r.raw_rows, r.unique_county_months, r.duplicate_rows, r.conflict_groups) for r in reports} == {(2, 1, 1, 0)}
    write_sources(folder, horse=({"Horse": "-1"},))
    with pytest.raises(ValidationFailed, match="^horse: "):
        validate_all(spark, str(folder), COUNTY_MONTH)


def test_files_of_one_folder_bind_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(csv_text("Bird", {}))
    header, row = csv_text("Bird", {"Month": "9"}).splitlines()
    turned = [",".join(reversed(line.split(","))) for line in (header, row)]
    (tmp_path / "b.csv").write_text("\n".join(turned) + "\n")
    assert report(spark, str(tmp_path))["unique_county_months"] == 2


def test_every_file_needs_the_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text(csv_text("Bird", {}))
    (tmp_path / "b.csv").write_text(csv_text("Bird", {"Month": "9"}, without=("FIPS",)))
    assert "missing required columns: FIPS" in refused(spark, str(tmp_path))


@pytest.mark.skipif("MONTHFUSION_DATA" not in os.environ, reason="needs the collected files")
def test_collected_files(spark):
    folder = Path(os.environ["MONTHFUSION_DATA"])
    for r in validate_all(spark, str(folder), COUNTY_MONTH).collect():
        assert (r.conflict_groups, r.minimum_year, r.maximum_year) == (0, 2002, 2022)


def test_every_file_and_header_is_seen(spark, tmp_path):
    """A column renamed in place, or an empty file, in a folder of good files."""
    (tmp_path / "a.csv").write_text(csv_text("Bird", {}))
    (tmp_path / "b.CSV").write_text(csv_text("Bird", {"Month": "9"}).replace("Date", "Dat"))
    assert "missing required columns: Date" in refused(spark, str(tmp_path))
    (tmp_path / "b.CSV").write_text(csv_text("Bird", {"Month": "9"}))
    assert report(spark, str(tmp_path))["raw_rows"] == 2
    (tmp_path / "c").write_text("")
    assert "missing required columns: " in refused(spark, str(tmp_path))


def test_an_empty_file_alone_lacks_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert "missing required columns: Bird, County" in refused(spark, str(tmp_path))


def test_digests_tell_rows_apart(spark):
    """NULL, zero and NaN in every place; equal values in any spelling are one."""
    values = ["0.0", "-0.0", "double('NaN')", "NULL", "1.0"]
    rows = " UNION ALL ".join(f"SELECT CAST({a} AS double) AS a, CAST({b} AS double) AS b, CAST({c} AS double) AS c" for a in values for b in values for c in values)
    df = spark.sql(rows)
    digests = df.selectExpr(*(f"{d} AS d{i}" for i, d in enumerate(digest(df.columns)))).distinct()
    assert digests.count() == df.distinct().count() == 64


def test_conflicts_are_found_in_every_column(spark, tmp_path):
    for c in ("Bird", *BIRD.files.numeric_columns):
        for other in ("7.25", "" if c != "Bird" else "9"):
            assert "1 conflicting county-month groups" in refused(spark, bird_file(tmp_path, {c: "7"}, {c: other}))


def test_plain_numbers_need_no_look_at_texts(spark, tmp_path, monkeypatch):
    """Sound files of plain numbers are read as numbers, with the report that texts give."""
    rows = ({}, {"Bird": "+2.0", "tp_1m_shift": ""}, {"Month": "9", "County": " Straße "}, {"Month": "9.5", "County": "STRASSE", "FIPS": " 1e0\t"})
    rows = (rows[0], {**rows[1], "County": "cook"}, *({**r, "FIPS": "1"} if "FIPS" not in r else r for r in rows[2:]))
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.csv").write_text(csv_text("Bird", *rows), encoding="utf-8")
    (tmp_path / "files" / "b.csv").write_text(csv_text("Bird", {"Month": "10"}, without=("src_1m_shift",)), encoding="utf-8")
    folder = str(tmp_path / "files")
    by_text = validate.assert_valid(read_text(spark, folder), BIRD, folder).first()
    monkeypatch.setattr(validate, "parsed", None)
    assert validate_source(spark, folder, BIRD).first() == by_text
    assert (by_text.raw_rows, by_text.unique_county_months, by_text.incomplete_metadata_rows) == (5, 4, 2)


@pytest.mark.parametrize("spelling", ["2d", "2.F", "0x1p1", "\x012", "2\x00", "Infinity", "+nan", "2-", "1__0"])
def test_spellings_that_only_the_reader_takes_are_refused(spark, tmp_path, spelling):
    for column in ("Bird", "tp_1m_shift"):
        assert f"in '{column}'" in refused(spark, bird_file(tmp_path, {}, {"Month": "9", column: spelling}))


@pytest.mark.parametrize("spelling", [" 2\t", "2.", "+2", "0_2", "\x0b2", "\u20032", "2e0", '"2"', '" 2"'])
def test_all_spellings_of_a_number_are_equal(spark, tmp_path, spelling):
    assert report(spark, bird_file(tmp_path, {}, {"Bird": spelling, "County": "Adams"}))["duplicate_rows"] == 1


def test_lines_of_another_length_are_read_as_before(spark, tmp_path):
    """A line that has too many cells keeps its values; one that ends early lacks some."""
    text = csv_text("Bird", {}, {"Month": "9"}).splitlines()
    path = tmp_path / "bird.csv"
    path.write_text("\n".join([*text[:2], text[2] + ",more"]) + "\n")
    assert report(spark, str(path)) == validate.assert_valid(read_text(spark, str(path)), BIRD, str(path)).first().asDict()
    last = text[0].split(",")[-1]
    path.write_text("\n".join([*text[:2], ",".join(text[2].split(",")[:-1])]) + "\n")
    assert f"1 rows empty_required in '{last}'" in refused(spark, str(path))
