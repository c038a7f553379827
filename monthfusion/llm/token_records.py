"""Token ids as length-delimited binary records with a separate offset index.

A record is framed by its length (8 bytes), the masked CRC-32C of these bytes, the
payload and the masked CRC-32C of the payload, all little-endian.  A payload is the
document id (8 bytes), flags (4 bytes: bit 0 no id, bit 1 ids of four bytes instead
of two) and the ids.

Documents are dealt to tasks by ranges of (doc_id, hash of the text), so documents
that share an id can be split; each task sorts its range, encodes it and writes one
file.  The rows that it returns, place and length of each record, become the index, a
Parquet table.  Files appear under their names only when complete, and a task run
again writes the same file.  The number of ids before a file is a running sum over
files, not documents.  ``read_files`` streams whole files, ``read_records`` any index
rows in any order; both check lengths and checksums.

Encoding a text piece by piece gives the ids of the whole text for tokenizers that never
join a token across a piece's end.  A piece ends where a space or a new line follows a
visible ASCII character or Latin letter, behind such a new line if a letter follows, and
where a mark follows a letter.  Pieces of a batch are made distinct first, and those seen
before come from a bounded cache.

Defined cases: NULL and empty texts have the end id only.  Documents without id come
first.  Equal ids are ordered by a hash of the text, then by the text; repeated rows
are records of their own.  An empty table gives no files and an empty result.  Other
columns are not read, whatever their names.
A very long text is one record, encoded in one piece of
memory and read back whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthfusion.llm.batches import gathered, give_back, small_batches
from monthfusion.llm.crc32c import crc32c, masked
from monthfusion.llm.files import new_file, open_file
from monthfusion.llm.pieces import PieceIds
from monthfusion.sources.shipping import ship_package

HEAD = struct.Struct("<QI")
NAME = struct.Struct("<qI")
NO_ID, WIDE = 1, 2
#: Where pieces begin, as the characters before and behind, and what is put between them.
BORDERS = ("([!-~À-ɏ]\\n)([A-Za-zÀ-ÖØ-öø-ɏ])", "([!-~À-ɏ])([ \\n])", "([A-Za-zÀ-ÖØ-öø-ɏ])([.,;:!?#$%&*])")
BORDER = "\0"
#: Pieces of Latin letters, with a space before them or not, that the tokenizer takes as one unit.
WORD = " ?[A-Za-zÀ-ÖØ-öø-ɏ]+"
#: Bytes of texts encoded together; a worker takes some 25 times as much while it does so.
TEXTS = 1 << 21
#: Strings whose ids a worker keeps, in each of two generations: some 130 bytes each.
KEPT = 100_000
#: Bytes of a file read at once; a longer record is read whole.
BUFFER = 1 << 22
#: Rows handed back at once.
ROWS = 1 << 10


@dataclass(frozen=True)
class Encoding:
    """Tokenizer file (a path that every executor has) and the id that ends a document."""

    path: str
    end_id: int


_loaded: dict[str, PieceIds] = {}


def encoder(encoding: Encoding):
    """A function from texts to id arrays; a worker keeps tokenizer and cache for later tasks."""
    pieces = _loaded.get(encoding.path) or _loaded.setdefault(encoding.path, PieceIds(encoding.path, WORD, KEPT))

    def encode(texts: list[str] | pa.Array) -> list[bytes]:
        column = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        holds_border = pc.match_substring(column, BORDER)
        cut = column
        for border in BORDERS:
            cut = pc.replace_substring_regex(cut, border, f"\\1{BORDER}\\2")
        # A text that holds the border itself is cut nowhere else and encoded whole.
        rows = pieces.rows(pc.split_pattern(pc.if_else(holds_border, "", cut), BORDER), encoding.end_id)
        for k in np.flatnonzero(holds_border.to_numpy(zero_copy_only=False)).tolist():
            rows[k] = pieces.learn([column[k].as_py()])[0] + rows[k]
        return rows

    return encode, pieces.width


def frames(payloads: list[bytes]) -> list[bytes]:
    """Each payload with length and checksums around it."""
    lengths = np.array([len(p) for p in payloads], "<u8")
    ends = np.cumsum(lengths).astype(np.int64)
    body = masked(crc32c(np.frombuffer(b"".join(payloads), np.uint8), ends - lengths.astype(np.int64), ends))
    eights = np.arange(len(payloads), dtype=np.int64) * 8
    head = masked(crc32c(lengths.view(np.uint8), eights, eights + 8))
    return [b"".join((HEAD.pack(len(p), h), p, struct.pack("<I", b))) for p, h, b in zip(payloads, head.tolist(), body.tolist(), strict=True)]


INDEX_DDL = "file string, file_number long, offset long, n_bytes long, doc_id long, n_tokens long, start_in_file long"
READ_DDL = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _write(folder: str, encoding: Encoding, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode, width = encoder(encoding)
    flags = WIDE if width.itemsize == 4 else 0
    number = TaskContext.get().partitionId()
    file = f"{folder}/part-{number:06d}.records"
    batches = gathered((b for b in batches if b.num_rows), TEXTS)
    first = next(batches, None)
    if first is None:
        return
    at = start = 0
    with new_file(file) as out:
        while first is not None:
            encoded = encode(first.column("text"))
            for low in range(0, first.num_rows, ROWS):
                ids = first.column("doc_id").slice(low, ROWS).to_pylist()
                tokens = encoded[low : low + ROWS]
                framed = frames([NAME.pack(i or 0, flags | (NO_ID if i is None else 0)) + t for i, t in zip(ids, tokens, strict=True)])
                out.write(b"".join(framed))
                sizes = np.array([len(f) for f in framed], np.int64)
                counts = np.array([len(t) // width.itemsize for t in tokens], np.int64)
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * n, pa.string()), pa.array([number] * n, pa.int64()), pa.array(at + np.cumsum(sizes) - sizes), pa.array(sizes),
                        pa.array(ids, pa.int64()), pa.array(counts), pa.array(start + np.cumsum(counts) - counts),
                    ],
                    names=["file", "file_number", "offset", "n_bytes", "doc_id", "n_tokens", "start_in_file"],
                )
                at, start = at + int(sizes.sum()), start + int(counts.sum())
            first = next(batches, None)
    give_back()


def write_records(spark: SparkSession, documents: DataFrame, folder: str, encoding: Encoding) -> DataFrame:
    """Write record files and their index under ``folder``; returns the index."""
    ship_package(spark)
    keyed = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order)
    with small_batches(spark):
        dealt.mapInArrow(partial(_write, f"{folder}/records", encoding), INDEX_DDL).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def payload_ids(payload: memoryview | bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags = NAME.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=NAME.size).astype("<u4")
    return (None if flags & NO_ID else doc_id), ids


def unframe(data: bytes) -> tuple[list[memoryview], int]:
    """The payloads of all whole records in ``data``, checked, and the bytes they take."""
    view, at, spans = memoryview(data), 0, []
    while at + HEAD.size <= len(data):
        length, _ = HEAD.unpack_from(data, at)
        if at + HEAD.size + length + 4 > len(data):
            break
        spans.append((at + HEAD.size, at + HEAD.size + length))
        at += HEAD.size + length + 4
    if spans:
        raw = np.frombuffer(data, np.uint8)
        starts, ends = np.array(spans, np.int64).T
        heads = masked(crc32c(raw, starts - HEAD.size, starts - 4))
        bodies = masked(crc32c(raw, starts, ends))
        told = [(HEAD.unpack_from(data, s - HEAD.size)[1], struct.unpack_from("<I", data, e)[0]) for s, e in spans]
        if told != list(zip(heads.tolist(), bodies.tolist(), strict=True)):
            raise ValueError("a record does not match its checksums")
    return [view[s:e] for s, e in spans], at


def stream(file: str) -> Iterator[list[memoryview]]:
    """All payloads of a file, some at a time."""
    with open_file(file) as source:
        rest = b""
        while True:
            more = source.read(BUFFER)
            rest += more
            if not more:
                if rest:
                    raise ValueError(f"{file} ends within a record")
                return
            if len(rest) >= HEAD.size:
                length, head = HEAD.unpack_from(rest)
                eight = np.frombuffer(rest[:8], np.uint8)
                if int(masked(crc32c(eight, np.array([0]), np.array([8])))[0]) != head:
                    raise ValueError(f"{file} holds a length that does not match its checksum")
                if length > len(rest):
                    rest += source.read(length + HEAD.size + 4 - len(rest))
            payloads, used = unframe(rest)
            if payloads:
                yield payloads
            rest = rest[used:]


def _rows(payloads: list[memoryview], start: int) -> tuple[pa.RecordBatch, int]:
    docs, starts, counts, sums = [], [], [], []
    for p in payloads:
        doc_id, ids = payload_ids(p)
        docs.append(doc_id)
        starts.append(start)
        counts.append(len(ids))
        sums.append(zlib.crc32(ids.tobytes()))
        start += len(ids)
    columns = [pa.array(x, pa.int64()) for x in (docs, starts, counts, sums)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"]), start


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, start in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
            for payloads in stream(file):
                rows, start = _rows(payloads, start)
                yield rows


def read_files(spark: SparkSession, index: DataFrame) -> DataFrame:
    """Every record of the indexed files: doc_id, start, n_tokens, ids_crc32."""
    files = index.groupBy("file_number", "file").agg(F.sum("n_tokens").alias("n"))
    # One row for each file, as many as the write had tasks.
    before = F.coalesce(F.sum("n").over(Window.orderBy("file_number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = files.withColumn("before", before)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return numbered.select("file", "before").repartition(parts, "file").mapInArrow(_read_files, READ_DDL)


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, source = None, None
    for batch in batches:
        docs, ids = [], []
        for file, offset, n_bytes in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "n_bytes")), strict=True):
            if file != name:
                name, source = file, open_file(file)
            source.seek(offset)
            payloads, _ = unframe(source.read(n_bytes))
            doc_id, tokens = payload_ids(payloads[0])
            docs.append(doc_id)
            ids.append(tokens.tolist())
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])


def read_records(index_rows: DataFrame) -> DataFrame:
    """The documents of some index rows, in their order within each partition."""
    ship_package(index_rows.sparkSession)
    return index_rows.select("file", "offset", "n_bytes").mapInArrow(_read_records, "doc_id long, ids array<long>")
