"""Small inputs for operator tests."""

from __future__ import annotations

import datetime

from monthfusion.contracts import COUNTY_MONTH, attribute_order
from monthfusion.plans.update import Update

BIRD = COUNTY_MONTH.source("bird")

RAW_TYPES = {
    "Year": "int",
    "Month": "int",
    "County": "string",
    "Bird": "bigint",
    **{a.raw: "double" for a in BIRD.attributes},
    "source_file": "string",
    "ingested_at": "timestamp",
}
RAW = {
    "Year": 2002,
    "Month": 8,
    "County": "adams",
    "Bird": 2,
    **{a.raw: float(i) for i, a in enumerate(BIRD.attributes, 1)},
    "source_file": "a.csv",
    "ingested_at": datetime.datetime(2024, 1, 1),
}


def frame(spark, rows, types):
    schema = ", ".join(f"`{c}` {t}" for c, t in types.items())
    return spark.createDataFrame([tuple(r[c] for c in types) for r in rows], schema)


def raw_rows(spark, *changes, **fixed):
    """Bird rows; each argument is a dict of changes to the standard row."""
    return frame(spark, [{**RAW, **fixed, **c} for c in changes], RAW_TYPES)


def silver_types(name):
    types = {"year": "int", "month": "int", "county": "string", f"{name}_count": "bigint"}
    types.update({c: "double" for c in attribute_order(BIRD)})
    types["county_fips"] = "int"
    return {**types, "source_file": "string", "latest_ingested_at": "timestamp"}


def silver_rows(spark, name, *changes):
    """Cleaned rows of a source."""
    types = silver_types(name)
    standard = {
        "year": 2002,
        "month": 8,
        "county": "Adams",
        f"{name}_count": 1,
        **{c: 1.0 for c in attribute_order(BIRD)},
        "county_fips": 17001,
        "source_file": f"{name}.csv",
        "latest_ingested_at": datetime.datetime(2024, 1, 1),
    }
    return frame(spark, [{**standard, **c} for c in changes], types)


# A row of a source file: the columns are the contract's, the values are counted up.
CSV_ROW = {
    "Year": "2002",
    "Month": "8",
    "County": "adams",
    "Date": "2002-08-01",
    **{c: str(i / 4) for i, c in enumerate(BIRD.files.numeric_columns, 4)},
}


def csv_text(outcome, *changes, without=(), bom=False):
    """A source file; each argument changes one row of it."""
    rows = [{**CSV_ROW, outcome: "2", **c} for c in changes]
    columns = [c for c in rows[0] if c not in without]
    lines = [",".join(columns), *(",".join(r[c] for c in columns) for r in rows)]
    return ("﻿" if bom else "") + "\n".join(lines) + "\n"


def write_sources(folder, rows=({}, {}), **by_source):
    """The three source files in one folder."""
    folder.mkdir(parents=True, exist_ok=True)
    for s in COUNTY_MONTH.sources:
        text = csv_text(s.outcome, *by_source.get(s.name, rows))
        (folder / s.file_name).write_text(text, encoding="utf-8")
    return folder


def new_update(spark, tmp_path, **options):
    """An update with an empty landing folder per source."""
    landing = {}
    for s in COUNTY_MONTH.sources:
        (tmp_path / "landing" / s.name).mkdir(parents=True)
        landing[s.name] = str(tmp_path / "landing" / s.name)
    return Update(spark, landing, str(tmp_path / "tables"), **options)
