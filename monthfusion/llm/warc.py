r"""WARC archives written and read by Spark tasks, with boundary-chain verification.

Writing.  Pages with equal payloads of at least ``REVISIT_BYTES`` share a digest; the
largest page id of a digest is the response, the others are revisits that refer to it
and hold no payload.  Each task writes one archive; it appears under its name only when
complete.

Reading.  An archive is cut into ranges of bytes, read side by side.  The marker
``WARC/1.0\r\n`` also occurs inside payloads, so a task cannot tell which markers begin
records.  It emits every marker in its range that starts a well-formed header, with the
offset of the record that would follow (header, content length, two line ends).  From
offset 0 of each archive the chain of successors is then followed by pointer jumping:
jump tables are squared, so a chain of n ranges takes log2(n) rounds.  Within a range a
task links candidates itself: it emits, for each candidate, the first candidate of
another range that its chain leads to, and only those pointers are jumped over.
Candidates that the chain from the start never meets are payload bytes and are dropped.
A chain that ends elsewhere than at the end of its archive is an error, not a shorter
result.  Payloads are read for the remaining records only, and their digests checked.

Defined cases: NULL and empty pages are responses of no bytes.  NULL page ids sort below
all others and are kept as NULL.  Rows with equal payload and the same largest id are all
responses.  Characters outside ASCII, white space and angle brackets in addresses are
percent-encoded; a NULL address is left out.  Empty tables give no archives and an empty
result.  Other columns are not read,
whatever their names.  A very long page is one record, written and read in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.llm.batches import give_back, small_batches
from monthfusion.llm.files import new_file, open_file
from monthfusion.sources.scratch import scratch_dir
from monthfusion.sources.shipping import ship_package

MARK = b"WARC/1.0\r\n"
REVISIT_BYTES = 1000
#: Bytes of one range, and how much more is read at once for a header.
RANGE = 8 << 20
HEADER = 1 << 14
NAME = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def deduplicated(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, payload (NULL for revisits), digest, n_bytes, refers_to.

    Digests that pages share are written first: Spark then knows their size, and moves
    the payloads only if that table is large.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("bigint").alias("n_bytes"))
    large = rows.where(F.col("n_bytes") >= REVISIT_BYTES)
    shared = large.groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    folder = scratch_dir(spark, "shared-payloads")
    shared.write.parquet(folder)
    shared = spark.read.parquet(folder)
    joined = rows.join(shared, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("n_bytes") >= REVISIT_BYTES)
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("html").cast("binary")).alias("payload"), "digest", "n_bytes", F.when(revisit, F.col("first_id")).alias("refers_to")
    )


def record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, n_bytes: int, refers_to: int | None) -> bytes:
    block = HTTP + (payload or b"")
    lines = [
        b"WARC-Type: " + (b"response" if payload is not None else b"revisit"),
        f"WARC-Record-ID: <{NAME}{'none' if page_id is None else page_id}>".encode(),
        b"WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}".encode(),
        f"WARC-Payload-Length: {n_bytes}".encode(),
        b"Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}".encode(),
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}".encode())
    if payload is None:
        lines += [f"WARC-Refers-To: <{NAME}{refers_to}>".encode(), f"WARC-Profile: {PROFILE}".encode()]
    return MARK + b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = (b for b in batches if b.num_rows)
    batch = next(batches, None)
    if batch is None:
        return
    path = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc"
    size = 0
    with new_file(path) as out:
        while batch is not None:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "n_bytes", "refers_to")), strict=True):
                data = record(*(v.as_py() for v in row))
                out.write(data)
                size += len(data)
            batch = next(batches, None)
    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64())], names=["path", "size"])
    give_back()


def write_archives(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Write archives under ``folder``; returns (path, size) of each."""
    ship_package(spark)
    rows = deduplicated(spark, pages)
    with small_batches(spark):
        rows.mapInArrow(partial(_write, f"{folder}/archives"), "path string, size long").write.parquet(f"{folder}/list")
    return spark.read.parquet(f"{folder}/list")


def header(data: bytes) -> dict[bytes, bytes] | None:
    """Fields of a header text that begins with the marker; None if it is not one."""
    fields = {}
    for line in data[len(MARK) :].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[A-Za-z0-9-]+", name):
            return None
        fields[name.lower()] = value.strip()
    return fields if fields.get(b"content-length", b"").isdigit() and b"warc-type" in fields else None


def candidates(path: str, start: int, end: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(offset, offset of the block, offset of the next record) for markers from ``start`` up to ``end``."""
    with open_file(path) as source:
        source.seek(start)
        data = source.read(min(end + len(MARK) - 1, size) - start)
        at = data.find(MARK)
        while at >= 0:
            text = data[at : at + HEADER]
            stop = text.find(b"\r\n\r\n")
            # A header that is longer, or goes on behind the range, is read further.
            while stop < 0 and start + at + len(text) < size:
                source.seek(start + at + len(text))
                text += source.read(HEADER)
                stop = text.find(b"\r\n\r\n")
            fields = header(text[:stop]) if stop >= 0 else None
            if fields:
                block = start + at + stop + 4
                following = block + int(fields[b"content-length"]) + 4
                if following <= size:
                    yield start + at, block, following
            at = data.find(MARK, at + 1)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, end, size in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end", "size")), strict=True):
            found = list(candidates(path, start, end, size))
            leave = {}
            for offset, _, following in reversed(found):  # the chain within this range, from behind
                leave[offset] = leave.get(following, following)
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(found), pa.string()), pa.array([start] * len(found), pa.int64()), *(pa.array([f[k] for f in found], pa.int64()) for k in range(3)), pa.array([leave[f[0]] for f in found], pa.int64())],
                names=["path", "range_start", "offset", "block", "following", "leaves"],
            )


def entries(spark: SparkSession, pointers: DataFrame, archives: DataFrame, folder: str, range_bytes: int = RANGE) -> DataFrame:
    """(path, offset) at which the chain from each archive's start enters a range.

    ``pointers`` leads from a candidate to where its chain leaves the range.  Each round
    adds what lies 2 ** k ranges on from what is known, then squares the pointers.
    """
    reached, jumps, k = archives.where("size > 0").select("path", F.lit(0).cast("bigint").alias("offset")), pointers, 0
    # A chain enters each range once at most: so many ranges, so many steps.
    steps = (archives.agg(F.max("size")).first()[0] or 0) // range_bytes + 1
    while True:
        step = jumps.select("path", "offset", F.col("leaves").alias("to"))
        more = reached.join(step, ["path", "offset"]).select("path", F.col("to").alias("offset"))
        reached.unionByName(more).distinct().write.parquet(f"{folder}/reached-{k}")
        reached = spark.read.parquet(f"{folder}/reached-{k}")
        k += 1
        if 1 << k > steps:
            return reached
        onward = step.select("path", F.col("offset").alias("to"), F.col("to").alias("leaves"))
        jumps = step.join(onward, ["path", "to"]).select("path", "offset", "leaves")
        jumps.write.parquet(f"{folder}/jumps-{k}")
        jumps = spark.read.parquet(f"{folder}/jumps-{k}")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks the chain of each range from its entry; reads and checks payloads."""
    for batch in batches:
        for path, entry, end, size in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "end", "size")), strict=True):
            rows = []
            with open_file(path) as source:
                while entry < end:
                    source.seek(entry)
                    text = source.read(HEADER)
                    while (stop := text.find(b"\r\n\r\n")) < 0:
                        more = source.read(HEADER)
                        if not more:
                            raise ValueError(f"{path} has no record at {entry}")
                        text += more
                    fields = header(text[:stop]) if text.startswith(MARK) else None
                    if fields is None:
                        raise ValueError(f"{path} has no record at {entry}")
                    source.seek(entry + stop + 4)
                    block = source.read(int(fields[b"content-length"]))
                    rows.append(described(fields, block))
                    entry += stop + 4 + len(block) + 4
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def page_of(value: bytes | None) -> int | None:
    text = (value or b"").decode().strip("<>").removeprefix(NAME)
    return int(text) if text not in ("", "none") else None


def described(fields: dict[bytes, bytes], block: bytes) -> tuple:
    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
    length = int(fields[b"warc-payload-length"])
    if fields[b"warc-type"] == b"response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, length):
            raise ValueError(f"the payload of {fields[b'warc-record-id']!r} does not match its digest")
    return page_of(fields[b"warc-record-id"]), length, digest, fields[b"warc-type"].decode(), page_of(fields.get(b"warc-refers-to"))


RECORD_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark: SparkSession, archives: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """Every record of the archives (path, size): what its header and payload say."""
    ship_package(spark)
    folder = scratch_dir(spark, "archive-records")
    starts = F.explode(F.expr(f"sequence(0L, greatest(size - 1, 0L), {range_bytes}L)"))
    ranges = archives.select("path", "size", starts.alias("start")).withColumn("end", F.expr(f"least(start + {range_bytes}L, size)"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranges.repartition(parts, "path", "start")
    dealt.mapInArrow(_candidates, "path string, range_start long, offset long, block long, following long, leaves long").write.parquet(f"{folder}/candidates")
    found = spark.read.parquet(f"{folder}/candidates")
    reached = entries(spark, found.select("path", "offset", "leaves"), archives, folder, range_bytes)
    ends = reached.join(archives, "path").groupBy("path", "size").agg(F.max("offset").alias("last")).where("last != size")
    if not ends.isEmpty():
        raise ValueError(f"the chain of {ends.first()['path']} does not end with the archive")
    entered = reached.join(archives, "path").where("offset < size").withColumn("end", F.expr(f"least((offset div {range_bytes}L + 1) * {range_bytes}L, size)"))
    return entered.repartition(parts, "path", "offset").select("path", "offset", "end", "size").mapInArrow(_records, RECORD_DDL)
