"""Hidden Markov language model: Baum-Welch on Spark, exact likelihood of every text.

Words are known by 64-bit codes.  The ``TOP`` most frequent training words are symbols
of their own, and so is the end of a text; every other word is a symbol by its class,
one of ``CLASSES`` by a hash of its last three bytes, and within the class it has the
smoothed share of its count.  So the model's alphabet has a fixed size, while counts of
all words, however many, are kept and used.

1. Tasks count word codes; Spark adds the counts up (a table of all words).
2. The words above a count, at most ``LOOKUP`` by a histogram of counts, go to the tasks
   as a lookup table.
3. One pass turns texts into symbols.  Words outside the lookup table are listed, joined
   with the table of all words by shuffle, and summed per text.
4. Baum-Welch: in each of ``ROUNDS`` rounds every task sums expected counts over its
   training texts, Spark adds them up, and the driver normalises them: STATES * alphabet
   numbers, whatever the input.  For training only, texts are cut into stretches of
   ``STRETCH`` symbols; later stretches start from the stationary distribution.
5. Scoring runs the scaled forward recursion over each whole text, all texts of a batch
   side by side, and adds the words' shares within their classes.

A text is training data unless crc32 of its id modulo ``FOLDS`` is 0.  Base: the unigram
model with 0.1 added to every count, by the same counts.

Defined cases: NULL and empty texts are the end token alone.  A NULL id is not held out.
Repeated rows and tied ids are texts of their own.  An empty table, or one without
training texts, gives N = 0 and a uniform model.  Other columns are not read,
whatever their names.  A very long text
is scored whole, by one scaled recursion.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.llm.batches import give_back, small_batches
from monthfusion.llm.words import chunks, mix, numbers, text_bytes, word_hashes, word_spans
from monthfusion.sources.scratch import scratch_dir
from monthfusion.sources.shipping import ship_package

FOLDS = 10
STATES = 8
TOP = 8_000
CLASSES = 1 << 10
LOOKUP = 200_000
SLOTS = 1 << 19
ROUNDS = 6
STRETCH = 512
#: Symbols of stretches trained on side by side, which bounds a task's memory.
SIDE_BY_SIDE = 200_000
#: Words counted before they are handed on.
COUNTED = 2_000_000
ADDED = 0.1
#: Weight, in symbols, of the unigram distribution within each state.
PRIOR = 200.0


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Word hashes whose low bits are the class."""
    letters = [np.where(ends - k >= starts, data[np.maximum(ends - k, 0)], 0).astype(np.uint64) for k in (1, 2, 3)]
    letters = [np.where((x >= 65) & (x <= 90), x + np.uint64(32), x) for x in letters]
    class_ = mix(letters[0] | letters[1] << np.uint64(8) | letters[2] << np.uint64(16)) % np.uint64(CLASSES)
    return (word_hashes(data, starts, ends) & ~np.uint64(CLASSES - 1) | class_).view(np.int64)


def coded(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word codes and where each text's words begin, some texts at a time."""
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        part = data[offsets[first] : offsets[last]]
        starts, ends, rows = word_spans(part, offsets[first : last + 1] - offsets[first])
        yield word_codes(part, starts, ends), np.searchsorted(rows, np.arange(last - first + 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        codes, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["word", "n"])

    for batch in batches:
        for codes, _ in coded(batch.column("text")):
            held.append(codes)
            if sum(map(len, held)) >= COUNTED:
                yield flush()
    if held:
        yield flush()
    give_back()


class Lookup:
    """Codes to places, by open addressing: few array reads for any number of codes."""

    def __init__(self, codes: np.ndarray):
        self.keys, self.places = np.zeros(SLOTS, np.int64), np.full(SLOTS, -1, np.int32)
        todo = np.arange(len(codes), dtype=np.int32)
        slot = self.slot(codes)
        while len(todo):  # of those that want one free slot, the last written gets it
            free = self.places[slot] < 0
            self.places[slot[free]] = todo[free]
            won = self.places[slot] == todo
            self.keys[slot[won]] = codes[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) % SLOTS

    @staticmethod
    def slot(codes: np.ndarray) -> np.ndarray:
        return (codes.view(np.uint64) >> np.uint64(40)).astype(np.int64) % SLOTS

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """The place of each code, -1 if unknown."""
        out = np.full(len(codes), -1, np.int32)
        todo, slot = np.arange(len(codes)), self.slot(codes)
        while len(todo):
            place = self.places[slot]
            hit = (place >= 0) & (self.keys[slot] == codes[todo])
            out[todo[hit]] = place[hit]
            on = (place >= 0) & ~hit
            todo, slot = todo[on], (slot[on] + 1) % SLOTS
        return out


@dataclass(frozen=True)
class Alphabet:
    """Symbols: 0 the end, then own symbols of words, then classes."""

    lookup: Lookup
    counts: np.ndarray  # of the words in the lookup, most frequent first
    own: int  # words with a symbol of their own
    class_log: np.ndarray  # log10 of smoothed totals of classes
    ends: int  # training texts
    tokens: int  # N
    distinct: int  # V

    @property
    def size(self) -> int:
        return 1 + self.own + CLASSES

    def encode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and places in the lookup."""
        place = self.lookup(codes)
        named = (place >= 0) & (place < self.own)
        return np.where(named, place + 1, 1 + self.own + (codes & (CLASSES - 1))).astype(np.uint16), place


def _encode(alphabet: Alphabet, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    logs = np.log10(alphabet.counts + ADDED)
    end_log = math.log10(alphabet.ends + ADDED)
    for batch in batches:
        symbols, rare, known, found, within, lengths = [], [], [], [], [], []
        for codes, cuts in coded(batch.column("text")):
            symbol, place = alphabet.encode(codes)
            value = np.where(place >= 0, logs[place] if len(logs) else 0.0, 0.0)
            classed = symbol > alphabet.own
            share = np.where(classed, value - alphabet.class_log[codes & (CLASSES - 1)], 0.0)
            sums = [np.concatenate(([0], np.cumsum(x)))[cuts] for x in (value, share, place >= 0)]
            found += np.diff(sums[0]).tolist()
            within += np.diff(sums[1]).tolist()
            known += np.diff(sums[2]).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                symbols.append(np.append(symbol[a:b], np.uint16(0)).tobytes())
                rare.append(codes[a:b][place[a:b] < 0])
                lengths.append(int(b - a) + 1)
        ends = np.concatenate(([0], np.cumsum([len(r) for r in rare]))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(lengths, pa.int64()),
                pa.array([k + (alphabet.ends > 0) for k in known], pa.int64()), pa.array([f + end_log for f in found], pa.float64()), pa.array(within, pa.float64()),
                pa.array(symbols, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rare) if rare else np.zeros(0, np.int64))),
            ],
            names=["row", "doc_id", "held_out", "n_tokens", "known", "found", "within", "symbols", "rare"],
        )
    give_back()


ENCODED = "row long, doc_id long, held_out boolean, n_tokens long, known long, found double, within double, symbols binary, rare array<long>"


@dataclass(frozen=True)
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # one row for each symbol

    def stationary(self) -> np.ndarray:
        at = np.full(STATES, 1 / STATES)
        for _ in range(200):
            at = at @ self.move
        return at / at.sum()


def first_model(unigram: np.ndarray) -> Model:
    """States that differ by fixed noise on every symbol and tend to stay."""
    noise = (numbers(len(unigram) * STATES, 9) >> np.uint64(11)).astype(float).reshape(-1, STATES) / 2.0**53
    emit = unigram[:, None] * np.exp(2 * noise)
    move = np.full((STATES, STATES), 0.05 / (STATES - 1))
    np.fill_diagonal(move, 0.95)
    return Model(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))


def sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint16) for v in column]


def side_by_side(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences by falling length as one row per step; how many go on at each step."""
    lengths = np.array([len(p) for p in parts])
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = lengths[order]
    active = np.searchsorted(-sorted_lengths, -np.arange(1, sorted_lengths[0] + 1), "right")
    places = np.concatenate(([0], np.cumsum(active)))
    flat = np.empty(places[-1], np.uint16)
    for rank, k in enumerate(order):
        flat[places[: lengths[k]] + rank] = parts[k]
    return flat, places, order


def expected(model: Model, parts: list[np.ndarray], firsts: np.ndarray, counts: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> None:
    """Adds the expected counts of some stretches (forward-backward, scaled)."""
    flat, at, order = side_by_side(parts)
    emit, move = model.emit, model.move
    n_steps = len(at) - 1
    forward, scales = np.empty((len(flat), STATES)), np.empty(len(flat))
    first = firsts[order]
    state = np.where(first[:, None], model.start, model.stationary())
    for t in range(n_steps):
        a, b = at[t], at[t + 1]
        state = (state if t == 0 else state[: b - a] @ move) * emit[flat[a:b]]
        scales[a:b] = state.sum(axis=1)
        state = state / scales[a:b, None]
        forward[a:b] = state
    posterior = forward.copy()
    back = np.ones((at[n_steps] - at[n_steps - 1], STATES))
    for t in range(n_steps - 1, 0, -1):
        a, b = at[t], at[t + 1]
        ahead = emit[flat[a:b]] * back / scales[a:b, None]
        n = b - a
        moves += forward[at[t - 1] : at[t - 1] + n].T @ ahead * move
        before = np.ones((at[t] - at[t - 1], STATES))
        before[:n] = ahead @ move.T
        posterior[at[t - 1] : at[t]] *= before
        back = before
    starts += posterior[: at[1]][first].sum(axis=0)
    for k in range(STATES):
        counts[:, k] += np.bincount(flat, posterior[:, k], len(counts))


def _expected(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, moves, starts = np.zeros_like(model.emit), np.zeros((STATES, STATES)), np.zeros(STATES)
    parts: list[np.ndarray] = []
    firsts: list[bool] = []
    held = 0
    for batch in batches:
        for text in sequences(batch.column("symbols")):
            for k in range(0, len(text), STRETCH):
                parts.append(text[k : k + STRETCH])
                firsts.append(k == 0)
                held += len(parts[-1])
                if held >= SIDE_BY_SIDE:
                    expected(model, parts, np.array(firsts), counts, moves, starts)
                    parts, firsts, held = [], [], 0
    if parts:
        expected(model, parts, np.array(firsts), counts, moves, starts)
    sums = np.concatenate([starts, moves.ravel(), counts.ravel()])
    used = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["place", "value"])
    give_back()


def train(spark: SparkSession, encoded: DataFrame, unigram: np.ndarray, rounds: int = ROUNDS) -> Model:
    model = first_model(unigram)
    texts = encoded.where("NOT held_out").select("symbols")
    for _ in range(rounds):
        parts = texts.mapInArrow(partial(_expected, model), "place long, value double")
        table = parts.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
        sums = np.zeros(STATES + STATES**2 + STATES * len(unigram))
        sums[table.column("place").to_numpy()] = table.column("value").to_numpy()
        start, moves, counts = np.split(sums, [STATES, STATES + STATES**2])
        moves, counts = moves.reshape(STATES, STATES), counts.reshape(-1, STATES)
        move = moves + 0.01 * np.eye(STATES) + 1e-3
        emit = counts + PRIOR * unigram[:, None]
        model = Model((start + 1) / (start + 1).sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model


def likelihoods(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each symbol sequence, by the scaled forward recursion."""
    if not texts:
        return np.zeros(0)
    flat, at, order = side_by_side(texts)
    total = np.zeros(len(texts))
    state = np.tile(model.start, (len(texts), 1))
    for t in range(len(at) - 1):
        a, b = at[t], at[t + 1]
        state = (state if t == 0 else state[: b - a] @ model.move) * model.emit[flat[a:b]]
        scale = state.sum(axis=1)
        state /= scale[:, None]
        total[: b - a] += np.log10(scale)
    out = np.empty(len(texts))
    out[order] = total
    return out


def _likelihoods(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = likelihoods(model, sequences(batch.column("symbols")))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("row", "doc_id", "held_out", "n_tokens", "known", "found", "within")), pa.array(values)],
            names=["row", "doc_id", "held_out", "n_tokens", "known", "found", "within", "sequence"],
        )
    give_back()


def most_frequent(words: DataFrame) -> pa.Table:
    """At most LOOKUP words: all above a count that a histogram of counts gives."""
    level = F.floor(F.log2("n") * 16)
    histogram = dict(words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect())  # 16 * 64 rows at most
    taken, least = 0, math.inf
    for key in sorted(histogram, reverse=True):
        taken += histogram[key]
        if taken > LOOKUP:
            break
        least = key
    if least == math.inf:
        return words.limit(0).toArrow()
    return words.where(level >= int(least)).toArrow()


def scores(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Per row of ``documents``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    ship_package(spark)
    folder = scratch_dir(spark, "hidden-markov")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out.alias("held_out"))
    with small_batches(spark):
        counted = texts.where("NOT held_out").select("text").mapInArrow(_count, "word long, n long")
        counted.groupBy("word").agg(F.sum("n").alias("n")).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    ends = texts.where("NOT held_out").count()
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = total + ends, distinct + (ends > 0)

    table = most_frequent(words)
    codes, counts = table.column("word").to_numpy(), table.column("n").to_numpy()
    order = np.lexsort((codes, -counts))
    codes, counts = codes[order], counts[order]
    own = min(TOP, len(codes))
    sizes, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for class_, n, k in words.groupBy((F.col("word").bitwiseAND(CLASSES - 1)).alias("class")).agg(F.sum("n"), F.count(F.lit(1))).collect():  # CLASSES rows
        sizes[class_], kinds[class_] = n, k
    np.subtract.at(sizes, codes[:own] & (CLASSES - 1), counts[:own])
    np.subtract.at(kinds, codes[:own] & (CLASSES - 1), 1)
    smoothed = sizes + ADDED * (kinds + 1)
    alphabet = Alphabet(Lookup(codes), counts, own, np.log10(smoothed), ends, tokens, distinct)
    unigram = np.concatenate([[ends + ADDED], counts[:own] + ADDED, smoothed])

    with small_batches(spark):
        numbered = texts.withColumn("row", F.monotonically_increasing_id())
        numbered.mapInArrow(partial(_encode, alphabet), ENCODED).write.parquet(f"{folder}/encoded")
    encoded = spark.read.parquet(f"{folder}/encoded")
    model = train(spark, encoded, unigram / unigram.sum())

    rare = encoded.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("times"))
    joined = rare.join(words, "word", "left").select("row", "times", F.coalesce("n", F.lit(0)).alias("n"))
    extra = joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + ADDED)).alias("rare_found"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )
    extra.write.parquet(f"{folder}/rare")
    scored = encoded.drop("rare").mapInArrow(
        partial(_likelihoods, model), "row long, doc_id long, held_out boolean, n_tokens long, known long, found double, within double, sequence double"
    )
    all_ = scored.join(spark.read.parquet(f"{folder}/rare"), "row", "left").fillna({"rare_found": 0.0, "rare_known": 0})
    base = F.col("found") + F.col("rare_found") - F.col("n_tokens") * math.log10(tokens + ADDED * (distinct + 1))
    return all_.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("rare_known")).alias("n_known"), F.lit(tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"), (F.col("sequence") + F.col("within") + F.col("rare_found")).alias("score"),
    )
