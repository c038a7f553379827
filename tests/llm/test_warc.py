import hashlib

import pytest

from monthfusion.llm import warc as w

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
BIG = "x" * 1500 + FAKE


def brute(rows):
    groups = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            key = hashlib.sha1(data).hexdigest()
            groups[key] = max(groups.get(key, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        key = hashlib.sha1(data).hexdigest()
        first = groups.get(key, i)
        out.append((i, len(data), key, "response" if first == i else "revisit", None if first == i else first))
    return sorted(out, key=str)


ROWS = [(i, f"http://a/ é<{i}>\r\n" if i % 3 else None, BIG if i % 4 == 0 else (None if i == 7 else ("short" if i in (9, 11) else f"page {i} " + FAKE + "y" * i * 30))) for i in range(60)]
ROWS += [(None, "u", BIG), (48, "again", "zz" * 800), (56, "repeat", BIG), (61, "u", ""), (62, "u", "WARC/1.0\r\n" * 300), (63, "u", "é" * 700), (64, "u", "é" * 700)]


@pytest.mark.parametrize("range_bytes", [257, 2000, 1 << 20])
def test_round_trip_with_markers_in_payloads(spark, tmp_path, range_bytes):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3).selectExpr("*", "1 AS digest", "2 AS offset")
    archives = w.write_archives(spark, df, str(tmp_path / "w"))
    got = sorted((tuple(r) for r in w.read_archives(spark, archives, range_bytes).collect()), key=str)
    assert got == brute(ROWS)


def test_damaged_chain_is_an_error(spark, tmp_path):
    df = spark.createDataFrame(ROWS[:9], "page_id long, url string, html string").coalesce(1)
    archives = w.write_archives(spark, df, str(tmp_path / "w")).collect()
    path = archives[0].path
    data = open(path, "rb").read()
    open(path, "wb").write(data.replace(b"WARC-Record-ID: <urn:page:5>", b"WARC-Record-ID! <urn:page:5>"))
    with pytest.raises(Exception, match="chain|no record"):
        w.read_archives(spark, spark.createDataFrame(archives), 2000).collect()


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert w.read_archives(spark, w.write_archives(spark, df, str(tmp_path / "w"))).count() == 0
