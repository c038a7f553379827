"""Phrase collocations, counted in counting quotient filters.

A word of a language has a 64-bit id, a hash that is checked to be its own in the whole
vocabulary (else another seed is taken), so no dictionary is handed to tasks.  A phrase
of n words is the packed row of its ids.  An invertible permutation (the first id plus
a mix of the others) spreads such rows evenly: the top bits of the permuted first id
are the quotient, and all that is left of it and the other ids in full are the
remainder, so a filter is lossless.  ``Filter`` keeps entries in this order; as bytes the
quotients are one unary bit string, remainders take the bytes they need, and a counter
takes one byte unless it is 255 or more.

Per length 2, 3, 4:

* a task counts the phrases of its texts in a filter (sorted, merged as it grows, cut
  into buckets of the permuted order and handed on when ``ENTRIES`` are reached), so a
  phrase costs a task one counter however often it occurs;
* Spark deals buckets to tasks, which merge the sorted filters of all shards;
* phrases with ``LEAST`` occurrences stay.  They set bits of a bitmap of fixed size, by
  which tasks skip longer phrases that hold a rarer one.  A bit set by chance costs a
  counter, a phrase is never lost.

Cuts and containment are one grouping: every candidate looks up the counts of the parts
of its cuts (single words salted, as many phrases begin with the same word) and tells
the phrases within it how often it occurs.

Defined cases: NULL and empty texts have no words.  A NULL language is ``und``.  Repeated
rows count as often as they are there.  Equal scores and counts are ordered by the phrase's bytes.  A very
long text is one chunk of a task; phrases of it are counted like others.  An empty table
gives no rows.  Columns other than text and lang are not read, whatever their names; ids play no part.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthfusion.llm.batches import give_back, small_batches
from monthfusion.llm.words import chunks, mix, text_bytes, word_spans
from monthfusion.sources.scratch import scratch_dir
from monthfusion.sources.shipping import ship_package

LONGEST, LEAST, TOP = 4, 30, 2000
SCORE, CONTAINED = 2_000_000, 80
#: Bytes of text looked at together.
CHUNK = 1 << 22
#: Different words, and phrases, that a task counts before it hands them on.
WORDS, ENTRIES = 300_000, 1_500_000
#: Bits of the bitmap of frequent phrases, as a power of two: 16 MB.
BITS = 27
#: Parts that one word's count is copied to where candidates look it up.
SALTS = 16

_marks = [*b".,;:!?", *range(0x0A, 0x0E)]
MARK, BREAK = np.zeros(256, bool), np.zeros(256, bool)
MARK[_marks] = True
BREAK[[0x20, 0x09, *_marks]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Filter:
    """Counters of packed phrases: permuted first ids in order, the other ids, counts."""

    def __init__(self, first: np.ndarray, others: list[np.ndarray], counts: np.ndarray):
        self.first, self.others, self.counts = first, others, counts

    def __len__(self) -> int:
        return len(self.first)

    @classmethod
    def of(cls, words: list[np.ndarray]) -> Filter:
        return cls.summed(permuted(words), words[1:], np.ones(len(words[0]), np.int64))

    @classmethod
    def summed(cls, first: np.ndarray, others: list[np.ndarray], counts: np.ndarray) -> Filter:
        """Entries in order, equal ones added."""
        order = np.argsort(first, kind="stable")
        equal = first[order[1:]] == first[order[:-1]]
        same = equal & np.all([o[order[1:]] == o[order[:-1]] for o in others], axis=0)
        if (equal & ~same).any():  # different phrases with one permuted first id
            order = np.lexsort((*others[::-1], first))
            same = (first[order[1:]] == first[order[:-1]]) & np.all([o[order[1:]] == o[order[:-1]] for o in others], axis=0)
        starts = np.flatnonzero(np.concatenate(([True], ~same))) if len(order) else order
        kept = order[starts]
        return cls(first[kept], [o[kept] for o in others], np.add.reduceat(counts[order], starts) if len(order) else counts)

    @classmethod
    def merged(cls, filters: list[Filter]) -> Filter:
        others = [np.concatenate(o) for o in zip(*(f.others for f in filters), strict=True)]
        return cls.summed(np.concatenate([f.first for f in filters]), others, np.concatenate([f.counts for f in filters]))

    def slice(self, a: int, b: int) -> Filter:
        return Filter(self.first[a:b], [o[a:b] for o in self.others], self.counts[a:b])

    def to_bytes(self) -> bytes:
        n, base = len(self), int(self.first[0])
        offset = self.first - self.first[0]
        quotient_bits = min(n.bit_length() - 1, int(offset[-1]).bit_length())
        rest = int(offset[-1]).bit_length() - quotient_bits
        quotient = (offset >> np.uint64(rest)).astype(np.int64) if rest < 64 else np.zeros(n, np.int64)
        unary = np.zeros(int(quotient[-1]) + n, np.uint8)
        unary[quotient + np.arange(n)] = 1
        width = (rest + 7) // 8
        remainder = offset & np.uint64((1 << rest) - 1)
        low = remainder.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
        large = self.counts >= 255
        small = np.where(large, 255, self.counts).astype(np.uint8)
        head = struct.pack("<QQBBQQ", n, base, rest, len(self.others), len(unary), int(large.sum()))
        parts = [np.packbits(unary), low, *(o.astype("<u8") for o in self.others), small, self.counts[large].astype("<i8")]
        return head + b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Filter:
        n, base, rest, k, n_unary, n_large = struct.unpack_from("<QQBBQQ", raw)
        at = struct.calcsize("<QQBBQQ")

        def take(size: int, dtype: str) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(raw[at - size : at], dtype)

        unary = np.unpackbits(take((n_unary + 7) // 8, "u1"), count=n_unary)
        quotient = (np.flatnonzero(unary) - np.arange(n)).astype(np.uint64)
        width = (rest + 7) // 8
        low = np.zeros((n, 8), np.uint8)
        low[:, :width] = take(n * width, "u1").reshape(n, width)
        high = quotient << np.uint64(rest) if rest < 64 else np.zeros(n, np.uint64)
        first = np.uint64(base) + high + low.view("<u8")[:, 0]
        others = [take(8 * n, "<u8") for _ in range(k)]
        counts = take(n, "u1").astype(np.int64)
        counts[counts == 255] = take(8 * n_large, "<i8")
        return cls(first, others, counts)


class Growing:
    """Filters of growing size, merged as equals meet, so each entry is merged a few times."""

    def __init__(self):
        self.stack: list[Filter] = []

    def add(self, new: Filter) -> None:
        if len(new):
            self.stack.append(new)
        while len(self.stack) > 1 and len(self.stack[-2]) < 2 * len(self.stack[-1]):
            self.stack[-2:] = [Filter.merged(self.stack[-2:])]

    def __len__(self) -> int:
        return sum(map(len, self.stack))

    def take(self) -> Filter | None:
        whole, self.stack = (Filter.merged(self.stack) if self.stack else None), []
        return whole


def tail(words: list[np.ndarray]) -> np.ndarray | np.uint64:
    """What the words behind the first add to it."""
    total = np.uint64(0)
    with np.errstate(over="ignore"):
        for w in words[:0:-1]:
            total = mix(w + total)
    return total


def permuted(words: list[np.ndarray]) -> np.ndarray:
    with np.errstate(over="ignore"):
        return words[0] + tail(words)


def first_word(first: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The permutation undone."""
    with np.errstate(over="ignore"):
        return first - tail([first, *others])


def occurrences(batch: pa.RecordBatch, seed: int) -> Iterator[tuple]:
    """Per chunk of texts: id of every word, whether the next word follows in its piece,
    number of every word and language in the last two lists, words, languages."""
    data, offsets = text_bytes(batch.column("text"))
    coded_langs = pc.fill_null(batch.column("lang").cast(pa.string()), "und").dictionary_encode()
    langs = coded_langs.dictionary.to_pylist()
    lang_salts = mix(np.array([xxhash.xxh3_64_intdigest(x, seed) for x in langs], np.uint64))
    lang_of = coded_langs.indices.to_numpy()
    for low, high in chunks(offsets, CHUNK):
        part = data[offsets[low] : offsets[high]]
        starts, ends, rows = word_spans(part, offsets[low : high + 1] - offsets[low], BREAK)
        if not len(starts):
            continue
        ends_in_words = np.concatenate(([0], np.cumsum(ends - starts)))
        bytes_ = LOWER[part[~BREAK[part]]]
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends_in_words.astype(np.int64)), pa.py_buffer(bytes_)).dictionary_encode()
        words, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
        lang = lang_of[low + rows]
        marks = np.cumsum(MARK[part])[starts]
        joined = (rows[1:] == rows[:-1]) & (marks[1:] == marks[:-1])
        yield mix(hashes[which] ^ lang_salts[lang]), joined, which, lang, words, langs


VOCABULARY_DDL = "id long, lang string, word string, n long"


def _vocabulary(seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def handed_on() -> pa.RecordBatch:
        ids, langs, words = zip(*counts, strict=True)
        columns = [pa.array(ids, pa.int64()), pa.array(langs), pa.array(words), pa.array(counts.values(), pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(columns, names=["id", "lang", "word", "n"])

    for batch in batches:
        for ids, _, which, lang, words, langs in occurrences(batch, seed):
            _, at, n = np.unique(lang.astype(np.int64) * len(words) + which, return_index=True, return_counts=True)
            names = zip(ids[at].view(np.int64).tolist(), [langs[k] for k in lang[at]], [words[k] for k in which[at]], strict=True)
            counts.update(dict(zip(names, n.tolist(), strict=True)))
            if len(counts) >= WORDS:
                yield handed_on()
    if counts:
        yield handed_on()
    give_back()


def has_bit(bitmap: np.ndarray, first: np.ndarray) -> np.ndarray:
    bit = first >> np.uint64(64 - BITS)
    return (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def phrases(ids: np.ndarray, joined: np.ndarray, n: int, bitmap: np.ndarray) -> list[np.ndarray]:
    """Ids of all runs of ``n`` words in a piece whose shorter runs may be frequent."""
    if len(ids) < n:
        return [ids[:0]] * n
    run = np.ones(len(ids) - n + 2, bool)  # runs of n - 1 words
    for k in range(n - 2):
        run &= joined[k : k + len(run)]
    at = np.flatnonzero(run)
    frequent = np.zeros(len(run), bool)
    frequent[at] = has_bit(bitmap, permuted([ids[at + k] for k in range(n - 1)]))
    # Two runs that overlap are one longer run; single words have to follow each other.
    both = frequent[:-1] & frequent[1:] & (joined[: len(run) - 1] if n == 2 else True)
    at = np.flatnonzero(both)
    return [ids[at + k] for k in range(n)]


FILTER_DDL = "bucket int, filter binary"


def _count(seed: int, n: int, bitmap: Broadcast, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    growing = Growing()
    borders = np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], np.uint64)

    def handed_on() -> pa.RecordBatch:
        whole = growing.take()
        cuts = [0, *np.searchsorted(whole.first, borders).tolist(), len(whole)]
        filled = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
        raw = [whole.slice(cuts[b], cuts[b + 1]).to_bytes() for b in filled]
        return pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(raw, pa.binary())], names=["bucket", "filter"])

    for batch in batches:
        for ids, joined, *_ in occurrences(batch, seed):
            growing.add(Filter.of(phrases(ids, joined, n, bitmap.value)))
            if len(growing) >= ENTRIES:
                yield handed_on()
    if len(growing):
        yield handed_on()
    give_back()


COUNTS = [("first", pa.int64()), *((f"w{k}", pa.int64()) for k in range(1, LONGEST + 1)), ("f", pa.int64())]
COUNTS_DDL = ", ".join(f"{c} long" for c, _ in COUNTS)


def _merge(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; gives the frequent phrases of each."""

    def frequent(growing: Growing) -> pa.RecordBatch:
        whole = growing.take()
        kept = np.flatnonzero(whole.counts >= least)
        others = [o[kept] for o in whole.others]
        words = [first_word(whole.first[kept], others), *others]
        words += [np.zeros(len(kept), np.uint64)] * (LONGEST - len(words))
        columns = [whole.first[kept], *words, whole.counts[kept]]
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], schema=pa.schema(COUNTS))

    growing, bucket = Growing(), None
    for batch in batches:
        for b, raw in zip(batch.column("bucket").to_pylist(), batch.column("filter"), strict=True):
            if b != bucket and len(growing):
                yield frequent(growing)
            bucket = b
            growing.add(Filter.from_bytes(raw.as_py()))
    if len(growing):
        yield frequent(growing)
    give_back()


class Collocations:
    """One run; every table named here lies in the shared folder."""

    def __init__(self, spark: SparkSession, documents: DataFrame, least: int = LEAST):
        ship_package(spark)
        self.spark, self.least, self.folder = spark, least, scratch_dir(spark, "collocations")
        self.documents = documents.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def save(self, df: DataFrame, name: str, batch_rows: int = 1000) -> DataFrame:
        with small_batches(self.spark, batch_rows):
            df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def vocabulary(self) -> tuple[DataFrame, int]:
        """(id, lang, word, n) of all words, and the first seed that gives each its own id."""
        seed = 0
        while True:
            rows = self.documents.mapInArrow(partial(_vocabulary, seed), VOCABULARY_DDL)
            words = self.save(rows.repartition(self.parts, "id").groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), f"words-{seed}")
            if words.groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").isEmpty():
                return words, seed
            seed += 1

    def bitmap(self, first: DataFrame) -> Broadcast:
        """The bits of frequent phrases: at most 2**BITS, whatever the corpus."""
        bit = first.select(F.expr(f"shiftrightunsigned(first, {64 - BITS})").alias("bit"))
        words = bit.groupBy(F.expr("shiftright(bit, 6)").alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS int)))").alias("bits")).toArrow()
        bitmap = np.zeros(1 << (BITS - 6), np.uint64)
        bitmap[words["at"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
        return self.spark.sparkContext.broadcast(bitmap)

    def counted(self, n: int, seed: int, shorter: DataFrame) -> DataFrame:
        """Frequent phrases of ``n`` words, given those one shorter."""
        bitmap = self.bitmap(shorter)
        filters = self.documents.mapInArrow(partial(_count, seed, n, bitmap, 2 * self.parts), FILTER_DDL)
        dealt = filters.repartition(self.parts, "bucket").sortWithinPartitions("bucket")
        found = self.save(dealt.mapInArrow(partial(_merge, self.least), COUNTS_DDL), f"phrases-{n}", batch_rows=64)
        bitmap.unpersist()
        return found.withColumn("n_words", F.lit(n))

    def ranked(self, top: int) -> DataFrame:
        words, seed = self.vocabulary()
        per_lang = words.groupBy("lang").agg(F.sum("n").alias("n"))
        # One row per language.
        langs = self.save(per_lang.withColumn("lang_no", F.row_number().over(Window.orderBy("lang"))), "languages")
        known = words.where(F.col("n") >= self.least).join(langs.select("lang", "lang_no"), "lang").select("id", "lang_no", "word", F.col("n").alias("f"))
        known = self.save(known, "known")
        found, shorter = [], known.select(F.col("id").alias("first"))
        for n in range(2, LONGEST + 1):
            shorter = self.counted(n, seed, shorter)
            found.append(shorter)
        scored = scores(known, found)
        best = F.rank().over(Window.partitionBy("lang_no").orderBy(F.desc("score"), F.desc("a")))
        # With all that tie with the last: only these need their words.
        leading = self.save(scored.withColumn("best", best).where(F.col("best") <= top).drop("best"), "leading")
        spelled = leading.select("*", F.posexplode(F.expr("slice(array(w1, w2, w3, w4), 1, n_words)")).alias("at", "id"))
        spelled = spelled.join(known.select("id", "word"), "id").groupBy(*leading.columns)
        named = spelled.agg(F.concat_ws(" ", *(F.max(F.when(F.col("at") == k, F.col("word"))) for k in range(LONGEST))).alias("phrase"))
        rank = F.row_number().over(Window.partitionBy("lang_no").orderBy(F.desc("score"), F.desc("a"), "phrase"))
        ranked = named.withColumn("rank", rank).where(F.col("rank") <= top)
        return ranked.join(langs, "lang_no").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


KEY = [f"w{k}" for k in range(1, LONGEST + 1)]


def packed(words: list[str]) -> str:
    """Fields w1 to w4 of a struct; 0 stands for no word."""
    return ", ".join(f"{w} AS {k}" for w, k in zip(words + ["0L"] * (LONGEST - len(words)), KEY, strict=True))


def scores(known: DataFrame, found: list[DataFrame]) -> DataFrame:
    """Candidates that no longer one contains too often, with the counts of their lowest cut."""
    candidates = found[0]
    for df in found[1:]:
        candidates = candidates.unionByName(df)
    looked_up, within = [], []
    for n, df in enumerate(found, 2):
        words = KEY[:n]
        sides = [(k, side, part) for k in range(1, n) for side, part in (("l", words[:k]), ("r", words[k:]))]
        asked = ", ".join(f"struct('{side}{k}' AS slot, {len(part)} AS n_part, {packed(part).replace(' AS w', ' AS p')})" for k, side, part in sides)
        looked_up.append(df.select(*KEY, F.expr(f"inline(array({asked}))")))
        inner = [words[a : a + m] for m in range(2, n) for a in range(n - m + 1)]
        if inner:
            within.append(df.select("f", F.expr("inline(array(" + ", ".join(f"struct({packed(p)})" for p in inner) + "))")))
    asked = looked_up[0]
    for df in looked_up[1:]:
        asked = asked.unionByName(df)
    parts = [f"p{k}" for k in range(1, LONGEST + 1)]
    salt = f"CASE WHEN n_part = 1 THEN CAST(pmod(xxhash64({', '.join(KEY)}), {SALTS}) AS int) ELSE 0 END"
    single = known.select(F.lit(1).alias("n_part"), F.col("id").alias("p1"), *(F.lit(0).cast("long").alias(p) for p in parts[1:]), "f", "lang_no")
    single = single.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    several = candidates.where(F.col("n_words") < LONGEST)
    several = several.select(F.col("n_words").alias("n_part"), *(F.col(w).alias(p) for w, p in zip(KEY, parts, strict=True)), "f", F.lit(None).cast("int").alias("lang_no"), F.lit(0).alias("salt"))
    counts = single.unionByName(several)
    told = asked.withColumn("salt", F.expr(salt)).join(counts, ["n_part", *parts, "salt"]).select(*KEY, "slot", "f", "lang_no")
    told = told.unionByName(candidates.select(*KEY, F.lit("own").alias("slot"), "f", F.lit(None).cast("int").alias("lang_no")))
    for df in within:
        told = told.unionByName(df.select(*KEY, F.lit("longer").alias("slot"), "f", F.lit(None).cast("int").alias("lang_no")))
    slots = ["own", "longer", *(f"{side}{k}" for k in range(1, LONGEST) for side in "lr")]
    per_slot = [F.max(F.when(F.col("slot") == s, F.col("f"))).alias(s) for s in slots]
    rows = told.groupBy(*KEY).agg(F.max("lang_no").alias("lang_no"), *per_slot)
    rows = rows.where(F.expr(f"longer IS NULL OR 100BD * longer < {CONTAINED}BD * own"))
    for k in range(1, LONGEST):
        rows = rows.withColumn(f"s{k}", F.expr(f"({SCORE}BD * own) div (CAST(l{k} AS decimal(20, 0)) + r{k})"))
    lowest = F.expr("least(" + ", ".join(f"s{k}" for k in range(1, LONGEST)) + ")")
    chosen = {side: F.coalesce(*(F.when(F.col(f"s{k}") == F.col("score"), F.col(f"{side}{k}")) for k in range(1, LONGEST))).alias(side) for side in "lr"}
    n_words = F.expr("1 + " + " + ".join(f"CAST(l{k} IS NOT NULL AS int)" for k in range(1, LONGEST))).alias("n_words")
    return rows.withColumn("score", lowest).select(*KEY, n_words, "lang_no", F.col("own").alias("a"), *chosen.values(), "score")


def collocations(spark: SparkSession, documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    return Collocations(spark, documents, least).ranked(top)
