"""Line breaks in quoted cells, files cut into ranges, and first lines."""

import csv
import gzip
import io
import json
import random

import pytest

from builders import BIRD, csv_text
from monthfusion.operators.validate import validate_source
from monthfusion.sources import csv_files, quoted
from monthfusion.sources.csv_files import MALFORMED, first_lines, headers, read_text
from monthfusion.streaming.bronze import BronzeTable, Landing, run_ingest


def cells(df):
    return sorted(tuple(r) for r in df.select("id", "v", "w").collect())


def plain(text):
    return sorted((tuple(r) for r in list(csv.reader(io.StringIO(text, newline="")))[1:] if r), key=str)


def written(rows, break_="\n"):
    return "".join(",".join(f'"{c}"' if set(c) & set("\n,\r") else c for c in r) + break_ for r in [("id", "v", "w"), *rows])


def invented(rng, n):
    parts = ["a", "é", "\n", "\r\n", ",", " x ", "中", "long " * 5]
    return [(str(k), "v" + "".join(rng.choices(parts, k=rng.randint(0, 6))), rng.choice(["y", "z\n\n\nz", "7"])) for k in range(n)]


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_ranges_of_any_size_give_every_record_once(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(quoted, "RANGE", size)
    rng = random.Random(size)
    want = []
    for k in range(3):
        rows = [(f"{k}-{i}", v, w) for i, v, w in invented(rng, 40)]
        text = written(rows, "\r\n" if k == 2 else "\n")
        text = text[: -1 if k == 0 else None]
        (tmp_path / f"{k}.csv").write_bytes(("﻿" if k == 1 else "").encode() + text.encode())
        want += plain(text)
    (tmp_path / "9.csv").write_text("id,v,w\n\n1,x,\"y\"\n")
    df = read_text(spark, str(tmp_path))
    assert cells(df) == sorted([*want, ("1", "x", "y")])
    assert {r[MALFORMED] for r in df.collect()} == {None}
    kinds = quoted.QuotedBreaks(spark, [str(tmp_path / f"{k}.csv") for k in (0, 1, 2, 9)]).kind
    assert len(kinds) == 3 and set(kinds.values()) == {quoted.SPLIT}
    assert df.where("source_file LIKE '%1.csv'").select("source_file_size").first()[0] == (tmp_path / "1.csv").stat().st_size


def test_ranges_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted, "RANGE", 2000)
    (tmp_path / "a.csv").write_text(written(invented(random.Random(1), 2000)))
    df = read_text(spark, str(tmp_path))
    tasks = df.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    assert len(tasks) > 3 and max(r["count"] for r in tasks) < 1500 and df.count() == 2000


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_an_open_quote_is_one_malformed_record(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(quoted, "RANGE", size)
    (tmp_path / "a.csv").write_text('id,v,w\n1,"a\nb",x\n2,"open,y\n3,c,z\n')
    got = {r[MALFORMED]: (r.id, r.v, r.w) for r in read_text(spark, str(tmp_path)).collect()}
    assert got == {None: ("1", "a\nb", "x"), '2,"open,y\n3,c,z\n': (None, None, None)}


def test_quotes_in_unquoted_cells_and_compressed_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v,w\n1,5" pipe,x\n2,"p\nq",y\n')
    with gzip.open(tmp_path / "b.csv.gz", "wt", newline="") as f:
        f.write('id,v,w\n3,"r\ns",z\n')
    assert cells(read_text(spark, str(tmp_path))) == [("1", '5" pipe', "x"), ("2", "p\nq", "y"), ("3", "r\ns", "z")]
    assert set(quoted.QuotedBreaks(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv.gz")]).kind.values()) == {quoted.WHOLE}


def test_bronze_keeps_broken_cells_whole_and_rescues_open_ones(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table = BronzeTable(spark, str(tmp_path / "out"), Landing("demo", str(tmp_path / "in")))
    (tmp_path / "in" / "a.csv").write_text('id,v\n1,"a\nb"\n')
    run_ingest([table])
    (tmp_path / "in" / "b.csv").write_text('v,id\n"c\n\nd",2\nplain,3\n"open,4\n')
    (tmp_path / "in" / "c.csv").write_text("id,v\n5,e\n")
    run_ingest([table])
    got = table.read().orderBy("id").collect()
    assert [(r.id, r.v) for r in got] == [(None, None), (1, "a\nb"), (2, "c\n\nd"), (3, "plain"), (5, "e")]
    assert [r["_rescued_data"] is None for r in got] == [False, True, True, True, True]
    assert json.loads(got[0]["_rescued_data"])[MALFORMED] == '"open,4\n'
    assert table.tracked() == {"id": "int", "v": "string"}


def test_counties_with_line_breaks_are_validated(spark, tmp_path):
    (tmp_path / "a.csv").write_text(csv_text("Bird", {"County": '"two\nlines"'}, {"County": '"two\nlines"'}, {}))
    got = validate_source(spark, str(tmp_path), BIRD).first()
    assert (got.raw_rows, got.unique_county_months, got.county_count) == (3, 2, 2)


def test_first_lines_read_the_first_bytes_only(spark, tmp_path, monkeypatch):
    (tmp_path / "a b[1].csv").write_text("id,v\n" + "1,x\n" * 500_000)
    (tmp_path / "b.csv").write_text("\n  \n" + "w" * 9000 + "\n1\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("only")
    with gzip.open(tmp_path / "e.csv.gz", "wt") as f:
        f.write("z,id\n1,2\n")
    paths = csv_files.file_paths(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: (r.line, r.n_bytes) for r in first_lines(spark, paths).collect()}
    assert got.pop("a b[1].csv") == ("id,v", csv_files.HEAD)
    assert got.pop("b.csv") == ("w" * 9000, 9007)
    assert {k: line for k, (line, _) in got.items()} == {"c.csv": None, "d.csv": "only", "e.csv.gz": "z,id"}
    near = headers(spark, paths)
    monkeypatch.setattr(csv_files, "reachable", lambda uri: False)
    assert headers(spark, paths) == near
