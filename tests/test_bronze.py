"""Incremental ingestion: names, types, growth, rescue, lineage, once only."""

import gzip
import json
import os
import time

import pytest

from monthfusion.contracts import COUNTY_MONTH
from monthfusion.streaming.bronze import BronzeTable, Landing, run_ingest


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def bronze(spark, tmp_path, landing, **options):
    return BronzeTable(spark, str(tmp_path / "out"), Landing("demo", str(landing), **options))


def rows(table, *columns, order):
    return [tuple(r) for r in table.read().select(*columns).orderBy(order).collect()]


def test_each_file_is_loaded_once(spark, tmp_path, landing):
    (landing / "a.csv").write_text("id,v\n1,x\n2,y\n")
    table = bronze(spark, tmp_path, landing)
    run_ingest([table])
    run_ingest([table])
    assert rows(table, "id", "v", order="id") == [(1, "x"), (2, "y")]
    (landing / "b.csv").write_text("id,v\n3,z\n")
    (landing / "a.csv").write_text("id,v\n1,x\n2,y\n9,q\n")  # a changed file is not read again
    run_ingest([table])
    assert rows(table, "id", "v", order="id") == [(1, "x"), (2, "y"), (3, "z")]


def test_columns_bind_by_name_within_and_across_batches(spark, tmp_path, landing):
    (landing / "a.csv").write_text("id,v\n1,10\n")
    (landing / "b.csv").write_text("v,id\n20,2\n")
    table = bronze(spark, tmp_path, landing)
    run_ingest([table])
    (landing / "c.csv").write_text("id,v\n3,30\n")
    (landing / "d.csv").write_text("V,ID\n40,4\n")
    run_ingest([table])
    assert rows(table, "id", "v", order="id") == [(1, 10), (2, 20), (3, 30), (4, 40)]


def test_new_columns_are_added_and_types_stay(spark, tmp_path, landing):
    (landing / "a.csv").write_text("id,v\n1,10\n")
    table = bronze(spark, tmp_path, landing)
    run_ingest([table])
    (landing / "b.csv").write_text("id,v,w\n2,abc,1.5\n")
    run_ingest([table])
    assert table.tracked() == {"id": "int", "v": "int", "w": "double"}
    got = table.read().orderBy("id").collect()
    assert [(r.id, r.v, r.w) for r in got] == [(1, 10, None), (2, None, 1.5)]
    assert got[0]["_rescued_data"] is None
    rescued = json.loads(got[1]["_rescued_data"])
    assert rescued.pop("_file_path").endswith("b.csv")
    assert rescued == {"v": "abc"}


def test_types_of_one_batch_are_widened(spark, tmp_path, landing):
    (landing / "a.csv").write_text("id,v,w\n1,10,1\n")
    (landing / "b.csv").write_text("v,w,id\n2.5,x,2\n")
    table = bronze(spark, tmp_path, landing)
    run_ingest([table])
    assert table.tracked() == {"id": "int", "v": "double", "w": "string"}
    assert rows(table, "v", "w", order="id") == [(10.0, "1"), (2.5, "x")]


def test_tables_do_not_depend_on_the_files_of_a_batch(spark, tmp_path, landing):
    texts = ["id,v\n1,10\n", "id,v\n2,2.5\n", "w,id,v\n1,3,3\n", "id,w,v,u\n3000000000,x,4,7\n"]
    for i, text in enumerate(texts):
        file = landing / f"{9 - i} b.csv"  # loaded by age, the last name first
        file.write_text(text)
        os.utime(file, (1_700_000_000 + i,) * 2)
    found = []
    for n in (1, 1000):
        table = BronzeTable(spark, str(tmp_path / f"by{n}"), Landing("demo", str(landing), files_per_batch=n))
        run_ingest([table])
        whole = table.read()
        found.append((whole.drop("ingested_at").dtypes, rows(table, "id", "v", "w", "u", "_rescued_data", order="id")))
    assert len(list((tmp_path / "by1" / "bronze_demo_source").glob("batch_id=*"))) == 4
    assert found[0] == found[1]
    assert found[0][1] == [
        (1, 10.0, None, None, None),
        (2, 2.5, None, None, None),
        (3, 3.0, "1", None, None),
        (3000000000, 4.0, "x", 7, None),
    ]


def test_malformed_lines_are_kept(spark, tmp_path, landing):
    (landing / "a.csv").write_text("id,v\n1,10,surplus\n2\n3,30\n")
    table = bronze(spark, tmp_path, landing)
    run_ingest([table])
    got = {r.id: r["_rescued_data"] for r in table.read().collect()}
    assert json.loads(got[1])["_malformed_record"] == "1,10,surplus"
    assert json.loads(got[2])["_malformed_record"] == "2"
    assert got[3] is None


def test_odd_headers_and_file_names(spark, tmp_path, landing):
    (landing / "sub dir").mkdir()
    (landing / "sub dir" / "a[1]*.csv").write_bytes(b"\xef\xbb\xbfid,v,v,\n1,2,3,4\n")
    (landing / "empty.csv").write_text("")
    (landing / "note.txt").write_text("id\n99\n")
    table = bronze(spark, tmp_path, landing, pattern="*.csv")
    run_ingest([table])
    assert rows(table, "id", "v1", "v2", "_c3", order="id") == [(1, 2, 3, 4)]


def test_reserved_column_names_are_refused(spark, tmp_path, landing):
    (landing / "a.csv").write_text("id,source_file\n1,x\n")
    with pytest.raises(Exception, match="reserved"):
        run_ingest([bronze(spark, tmp_path, landing)])


def test_batches_are_bounded_and_a_repeated_batch_replaces_itself(spark, tmp_path, landing):
    for i in range(5):
        (landing / f"{i}.csv").write_text(f"id\n{i}\n")
    table = bronze(spark, tmp_path, landing, files_per_batch=2)
    run_ingest([table])
    assert rows(table, "id", order="id") == [(i,) for i in range(5)]
    batches = sorted((tmp_path / "out" / "bronze_demo_source").glob("batch_id=*"))
    assert len(batches) == 3
    table.load([str(landing / "0.csv"), str(landing / "1.csv")], 0)
    first = table.spark.read.parquet(str(batches[0])).count()
    assert first == 2


def test_lineage_and_contract_columns(spark, tmp_path, landing):
    header = "Year,Month,County,Bird,FIPS,Avian Phylodiversity,extra\n"
    (landing / "a.csv").write_text(header + "2002,8, adams ,2.0,17001.0,1.5,7\n")
    source = COUNTY_MONTH.source("bird")
    table = BronzeTable(spark, str(tmp_path / "out"), Landing.of(source, str(landing)))
    assert table.read().count() == 0
    run_ingest([table])
    row = table.read().first()
    assert (row.Year, row.Bird, row.FIPS, row.County) == (2002, 2, 17001.0, " adams ")
    assert row.Avian_Phylodiversity == 1.5 and row.extra == 7
    assert row.Land_Area_2010 is None and row["_rescued_data"] is None
    assert row.source_type == "bird" and row.source_file.endswith("/a.csv")
    assert row.source_file_size == len(header) + len("2002,8, adams ,2.0,17001.0,1.5,7\n")
    assert row.source_modification_time and row.ingested_at
    names = table.read().columns
    assert "Avian Phylodiversity" not in names
    assert names[-7:] == [
        "_rescued_data",
        "Avian_Phylodiversity",
        "source_type",
        "source_file",
        "source_file_size",
        "source_modification_time",
        "ingested_at",
    ]


def test_files_of_any_name_and_age_are_loaded(spark, tmp_path, landing):
    (landing / "a.csv").write_text("id\n1\n")
    table = bronze(spark, tmp_path, landing)
    run_ingest([table])
    old = landing / "b.CSV"
    old.write_text("id\n2\n")
    ten_days_ago = time.time() - 10 * 86400
    os.utime(old, (ten_days_ago, ten_days_ago))
    run_ingest([table])
    (landing / "no suffix").write_text("id\n3\n")
    (landing / "d.csv.gz").write_bytes(gzip.compress(b"id\n4\n"))
    (landing / "_hidden").write_text("id\n9\n")
    run_ingest([table])
    run_ingest([table])
    assert rows(table, "id", order="id") == [(1,), (2,), (3,), (4,)]


def test_large_whole_numbers_keep_their_digits(spark, tmp_path, landing):
    (landing / "a.csv").write_text("id\n9007199254740993.0\n1e3\n2.5\n")
    table = bronze(spark, tmp_path, landing, pinned={"id": "bigint"})
    run_ingest([table])
    got = {(r.id, r["_rescued_data"] is None) for r in table.read().collect()}
    assert got == {(9007199254740993, True), (1000, True), (None, False)}


def test_table_can_be_registered_with_its_comment(spark, tmp_path, landing):
    (landing / "a.csv").write_text("id,v\n1,x\n")
    table = bronze(spark, tmp_path, landing)
    run_ingest([table])
    table.register("bronze_demo")
    assert spark.table("bronze_demo").select("id", "v", "source_type").collect() == [(1, "x", "demo")]
    told = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED bronze_demo").collect()}
    assert told["Comment"] == table.comment
    spark.sql("DROP VIEW bronze_demo")


def test_changed_and_lost_files_are_reported(spark, tmp_path, landing):
    for name in ("a [1].csv", "b.csv", "c.csv", "d.csv"):
        (landing / name).write_text("id\n1\n")
    table = bronze(spark, tmp_path, landing, files_per_batch=2)
    assert table.changed_files().count() == 0
    run_ingest([table])
    assert table.changed_files().count() == 0 and table.loaded_files().count() == 4
    (landing / "a [1].csv").write_text("id\n1\n2\n")
    os.utime(landing / "b.csv", (1_700_000_000, 1_700_000_000))
    (landing / "c.csv").unlink()
    run_ingest([table])
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.now_length) for r in table.changed_files().collect()}
    assert got == {"a [1].csv": (5, 7), "b.csv": (5, 5), "c.csv": (5, None)}
    assert table.read().count() == 4
