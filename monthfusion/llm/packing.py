"""Packing documents into training sequences by harmonic classes.

Pieces with a length in (capacity / (k + 1), capacity / k] are class k, and a bin of
class k takes exactly k of them, whichever they are.  A bin needs to know nothing but
its class and how many pieces it has, so every task fills bins of its own.

A harmonic bin wastes most where lengths lie far below their class's share, so
documents are cut to fit: as many whole sequences as they have (class 1), and what is
left goes whole if k of its kind fill a bin but for ``slack`` tokens (or if it is too
short to cut, ``SHORT``); otherwise its head of capacity // (k + 1) tokens goes to that
class and the rest is judged again.  ``plan`` holds these cuts for every length.

At its end a task has at most one open bin per class.  Their pieces follow each other
into whole sequences; what then remains is cut into sequences of powers of two, which
need no padding.

``write_sequences`` writes one row per sequence: sequence_id, n_tokens, ids (binary,
little-endian, two bytes each where the vocabulary allows, else four), padded_to (the
length to pad to: n_tokens if that is a power of two, else the capacity) and pieces, in
order: doc_id, start (ids of the document before the piece), length, offset (ids of
the sequence before it), doc_tokens.  A task run again packs the same rows in the same
way.  ``read_pieces`` gives one row per piece with a checksum of its ids.

Defined cases: NULL and empty texts have the end id only.  Rows that share an id, equal
rows and rows without id are documents of their own.  A very long text is cut as any
other; a task holds one batch of texts and its open bins.  An empty table gives no rows.  Columns
other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.llm.batches import gathered, give_back, small_batches
from monthfusion.llm.pieces import PieceIds
from monthfusion.llm.token_records import Encoding
from monthfusion.sources.shipping import ship_package

CAPACITY = 2048
#: Tokens that a bin may leave free for the sake of a document in one piece.
SLACK = 16
#: Pieces below this length are not cut again; a bin of them leaves less than this free.
SHORT = 32
#: Marks that are split from the word before them, and how special tokens begin.
MARKED, SPECIAL = "([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?#$%&*])", "<|"
#: Words of lower-case letters that the tokenizer changes in no way.
WORD = "[a-zß-öø-ÿ]+"
#: Bytes of texts encoded together.
TEXTS = 1 << 23
#: Sequences handed on at once.
ROWS = 256
#: A task's sequences are numbered from its own number shifted by this.
TASK_BITS = 40


@cache
def plan(capacity: int, slack: int = SLACK) -> list[tuple[int, ...]]:
    """For each length below the capacity the lengths of the pieces it is cut into."""
    cuts: list[tuple[int, ...]] = [()]
    for length in range(1, capacity):
        k = capacity // length
        head = capacity // (k + 1)
        whole = length < SHORT or capacity - k * length <= slack or not head
        cuts.append((length,) if whole else (head, *cuts[length - head]))
    return cuts


Piece = tuple[int | None, int, int, bytes, int]  # doc_id, start, length, ids, doc_tokens
PIECE = pa.struct([(c, pa.int64()) for c in ("doc_id", "start", "length", "offset", "doc_tokens")])
SEQUENCE = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("padded_to", pa.int32()), ("ids", pa.binary()), ("pieces", pa.list_(PIECE))])
SEQUENCE_DDL = (
    "sequence_id long, n_tokens int, padded_to int, ids binary, pieces array<struct<doc_id: long, start: long, length: long, offset: long, doc_tokens: long>>"
)
PIECE_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, n_tokens int, padded_to int"


class Bins:
    """The open bins of one task; ``add`` and ``rest`` give finished sequences."""

    def __init__(self, capacity: int, width: int):
        self.capacity, self.width = capacity, width
        self.open: dict[int, list[Piece]] = {}

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[list[Piece]]:
        n = len(ids) // self.width
        whole, left = divmod(n, self.capacity)
        start = 0
        for length in (self.capacity,) * whole + plan(self.capacity)[left]:
            k = self.capacity // length
            bin_ = self.open.setdefault(k, [])
            bin_.append((doc_id, start, length, ids[start * self.width : (start + length) * self.width], n))
            if len(bin_) == k:
                yield self.open.pop(k)
            start += length

    def rest(self) -> Iterator[list[Piece]]:
        """The open bins' pieces in a row, cut where a sequence is full."""
        pieces = [p for k in sorted(self.open) for p in self.open[k]]
        left = sum(p[2] for p in pieces)
        sequence: list[Piece] = []
        room = size = self.next_size(left)
        for doc_id, start, length, ids, n in pieces:
            while length:
                take = min(length, room)
                sequence.append((doc_id, start, take, ids[: take * self.width], n))
                start, length, ids = start + take, length - take, ids[take * self.width :]
                room -= take
                if not room:
                    yield sequence
                    left -= size
                    sequence, size = [], self.next_size(left)
                    room = size

    def next_size(self, left: int) -> int:
        return self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1) if left else 0


def padded(n_tokens: int, capacity: int) -> int:
    return n_tokens if n_tokens & (n_tokens - 1) == 0 else capacity


def rows(sequences: list[list[Piece]], first_id: int, capacity: int) -> pa.RecordBatch:
    sizes = [sum(p[2] for p in s) for s in sequences]
    pieces = []
    for s in sequences:
        at, row = 0, []
        for doc_id, start, length, _, n in s:
            row.append({"doc_id": doc_id, "start": start, "length": length, "offset": at, "doc_tokens": n})
            at += length
        pieces.append(row)
    columns = [range(first_id, first_id + len(sequences)), sizes, [padded(n, capacity) for n in sizes], [b"".join(p[3] for p in s) for s in sequences], pieces]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, SEQUENCE.types, strict=True)], schema=SEQUENCE)


_loaded: dict[str, PieceIds] = {}


def document_ids(words: PieceIds, column: pa.Array, end_id: int) -> list[bytes]:
    """Ids of each text with the end id.  The tokenizer drops white space, so that words
    between ASCII white space have the same ids alone as in their text.  As it ignores case
    and splits words from marks, fewer different words are left when that is done first; not
    so in texts that may name special tokens."""
    column = pc.fill_null(column, "")
    plain = pc.ascii_lower(pc.replace_substring_regex(column, MARKED, r"\1 \2"))
    return words.rows(pc.ascii_split_whitespace(pc.if_else(pc.match_substring(column, SPECIAL), column, plain)), end_id)


def _pack(encoding: Encoding, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _loaded.get(encoding.path) or _loaded.setdefault(encoding.path, PieceIds(encoding.path, WORD))
    bins = Bins(capacity, words.width.itemsize)
    number = TaskContext.get().partitionId() << TASK_BITS
    done: list[list[Piece]] = []

    def finished() -> Iterator[list[Piece]]:
        for batch in gathered(batches, TEXTS):
            encoded = document_ids(words, batch.column("text"), encoding.end_id)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                yield from bins.add(doc_id, ids)
        yield from bins.rest()

    for sequence in finished():
        done.append(sequence)
        if len(done) == ROWS:
            yield rows(done, number, capacity)
            number, done = number + len(done), []
    if done:
        yield rows(done, number, capacity)
    give_back()


def write_sequences(spark: SparkSession, documents: DataFrame, folder: str, encoding: Encoding, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens under ``folder``.

    ``encoding`` names a tokenizer that drops white space, ignores case and splits words
    from marks, and the id that ends a document.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    ship_package(spark)
    keyed = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    with small_batches(spark):
        keyed.mapInArrow(partial(_pack, encoding, capacity), SEQUENCE_DDL).write.parquet(folder)
    return spark.read.schema(SEQUENCE_DDL).parquet(folder)


def _pieces(width: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "length", "offset", "doc_tokens"]
    for batch in batches:
        lists = batch.column("pieces")
        flat = lists.flatten()
        column = {c: flat.field(c) for c in names}
        owner = pa.array(np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
        sequences = [np.frombuffer(b, width).astype("<u4") for b in batch.column("ids").to_pylist()]
        places = zip(owner.to_pylist(), column["offset"].to_pylist(), column["length"].to_pylist(), strict=True)
        sums = pa.array([zlib.crc32(sequences[s][a : a + n].tobytes()) for s, a, n in places], pa.int64())
        of = {c: batch.column(c).take(owner) for c in ("sequence_id", "n_tokens", "padded_to")}
        yield pa.RecordBatch.from_pydict({**column, "ids_crc32": sums, **of}).select([c.split()[0] for c in PIECE_DDL.split(", ")])


def read_pieces(sequences: DataFrame, encoding: Encoding) -> DataFrame:
    """One row per piece, with the unsigned crc32 of its ids as four-byte numbers."""
    spark = sequences.sparkSession
    ship_package(spark)
    return sequences.mapInArrow(partial(_pieces, PieceIds(encoding.path).width.str), PIECE_DDL)
