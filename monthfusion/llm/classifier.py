"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

1. One pass over all texts computes a fixed list of statistics per document.
2. Their means and deviations, over all documents, standardise them.
3. Random Fourier features, cosines of fixed random projections, approximate a
   Gaussian kernel.  Each task sums the normal equations of its labelled rows; the sums
   are added up by Spark, and the driver solves one system of FEATURES + 1 unknowns.
4. Raw scores of other labelled rows are counted in ``LEVELS`` bins, by label; the pool
   adjacent violators method on these counts gives a rising map from raw score to
   probability.
5. A last pass scores every document.

Rows for step 3 and for step 4 are told apart by ``crc32(doc_id)`` modulo ``FOLDS``;
rows with remainder ``HELD_OUT`` are used for neither.  All other labelled rows are
used, none are sampled.  Labels, language, source and id never enter a score.

Defined cases: NULL and empty texts have all statistics 0 and get a score.  Repeated
rows and tied ids are scored each.  Several labels of one id are averaged, NULL labels
ignored; a NULL id has no label and is not held out.  Without labelled rows all scores
are 0.5.  An empty table gives an empty result.  Other columns are not read,
whatever their names.  A very long text is read in blocks; its statistics cover all of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.llm.batches import give_back, small_batches
from monthfusion.llm.words import chunks, numbers, text_bytes, word_hashes, word_spans
from monthfusion.sources.scratch import scratch_dir
from monthfusion.sources.shipping import ship_package

FOLDS, FIT, HELD_OUT = 3, 0, 1
FEATURES = 192
WIDTH = 3.0  # of the kernel, in standard deviations
RIDGE = 1e-3
LEVELS = 512
LOW, HIGH = -0.5, 1.5  # raw scores outside fall in the outer bins


def _class(chars: str | bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode() if isinstance(chars, str) else chars)] = True
    return table


CLASSES = {
    "marks": _class("#*$%&|<>"),
    "capitals": _class(bytes(range(65, 91))),
    "digits": _class("0123456789"),
    "shouts": _class("!?"),
    "stops": _class(".,;:"),
    "lines": _class("\n"),
    "beyond_ascii": _class(bytes(range(128, 256))),
}
STATISTICS = (*CLASSES, "log_words", "word_bytes", "longest_word", "distinct", "top_word", "repeats", "words_per_line")


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text."""
    data, offsets = text_bytes(column)
    out = np.zeros((len(column), len(STATISTICS)))
    for first, last in chunks(offsets):
        cuts = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        n = last - first
        size = np.maximum(np.diff(cuts), 1)
        counts = {}
        for k, (name, table) in enumerate(CLASSES.items()):
            sums = np.concatenate(([0], np.cumsum(table[part], dtype=np.int64)))
            counts[name] = np.diff(sums[cuts])
            out[first:last, k] = counts[name] / size
        starts, ends, rows = word_spans(part, cuts)
        hashes = word_hashes(part, starts, ends)
        words = np.bincount(rows, minlength=n)
        some = np.maximum(words, 1)
        order = np.lexsort((hashes, rows))
        h, r = hashes[order], rows[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        begins = np.flatnonzero(new)
        runs = np.diff(np.append(begins, len(h)))
        top, longest = np.zeros(n), np.zeros(n)
        np.maximum.at(top, r[begins], runs)
        np.maximum.at(longest, rows, ends - starts)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
        rest = (
            np.log1p(words),
            np.bincount(rows, ends - starts, n) / some,
            np.log1p(longest),
            np.bincount(r[begins], minlength=n) / some,
            top / some,
            np.bincount(rows, again, n) / some,
            np.log1p(words / (counts["lines"] + 1)),
        )
        for k, values in enumerate(rest, len(CLASSES)):
            out[first:last, k] = values
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = statistics(batch.column("text"))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), lists], names=["doc_id", "x"])
    give_back()


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass(frozen=True)
class Kernel:
    """Standardisation and fixed random projections."""

    mean: np.ndarray
    scale: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Random features and a constant."""
        n = len(STATISTICS)
        unit = (numbers(2 * n * FEATURES, 7) >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54
        normal = np.sqrt(-2 * np.log(unit[: n * FEATURES])) * np.cos(2 * np.pi * unit[n * FEATURES :])
        phase = (numbers(FEATURES, 8) >> np.uint64(11)).astype(float) * (2 * np.pi / 2.0**53)
        standard = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(standard @ (normal.reshape(n, FEATURES) / WIDTH) + phase) * np.sqrt(2 / FEATURES)
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)


def _equations(kernel: Kernel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of one task: of products of features, and of features times labels."""
    left, right = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
    rows = 0
    for batch in batches:
        if batch.num_rows:
            z, y = kernel(_matrix(batch.column("x"))), batch.column("y").to_numpy()
            left += z.T @ z
            right += z.T @ y
            rows += len(y)
    if rows:
        both = np.column_stack([left, right]).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], names=["place", "value"])


def _levels(raw: np.ndarray) -> np.ndarray:
    return np.clip((raw - LOW) / (HIGH - LOW) * LEVELS, 0, LEVELS - 1).astype(np.int64)


def _counts(kernel: Kernel, weights: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, good = np.zeros(LEVELS), np.zeros(LEVELS)
    for batch in batches:
        if batch.num_rows:
            level = _levels(kernel(_matrix(batch.column("x"))) @ weights)
            n += np.bincount(level, minlength=LEVELS)
            good += np.bincount(level, batch.column("y").to_numpy(), LEVELS)
    used = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), pa.array(good[used])], names=["level", "n", "good"])


def isotonic(levels: list[tuple[int, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Rising points (raw score, probability) from (level, rows, sum of labels) by level."""
    blocks: list[list[float]] = []  # rows, sum of labels, sum of level * rows
    for level, n, good in levels:
        blocks.append([n, good, level * n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    at = np.array([LOW + (b[2] / b[0] + 0.5) * (HIGH - LOW) / LEVELS for b in blocks])
    return at, np.array([(b[1] + 0.5) / (b[0] + 1) for b in blocks])


def _score(kernel: Kernel, weights: np.ndarray, at: np.ndarray, chance: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = kernel(_matrix(batch.column("x"))) @ weights
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.interp(raw, at, chance))], names=["doc_id", "score"])


def remainder(folds: int = FOLDS):
    return F.crc32(F.col("doc_id").cast("string")) % folds


def quality_scores(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``documents``: doc_id, held_out, score, predicted."""
    ship_package(spark)
    folder = scratch_dir(spark, "quality-classifier")
    with small_batches(spark):
        documents.select("doc_id", "text").mapInArrow(_features, "doc_id long, x array<double>").write.parquet(f"{folder}/features")
    features = spark.read.parquet(f"{folder}/features")
    n = len(STATISTICS)
    sums = [F.sum(F.col("x")[k]).alias(f"s{k}") for k in range(n)] + [F.sum(F.col("x")[k] * F.col("x")[k]).alias(f"q{k}") for k in range(n)]
    row = features.agg(F.count(F.lit(1)).alias("rows"), *sums).first()
    rows = max(row["rows"], 1)
    mean = np.array([row[f"s{k}"] or 0.0 for k in range(n)]) / rows
    spread = np.sqrt(np.maximum(np.array([row[f"q{k}"] or 0.0 for k in range(n)]) / rows - mean**2, 0))
    kernel = Kernel(mean, np.where(spread > 1e-9, spread, 1.0))

    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("y"))
    known = known.where(remainder() != HELD_OUT)
    features.join(known, "doc_id").select(remainder().alias("fold"), "x", "y").write.parquet(f"{folder}/labelled")
    labelled = spark.read.parquet(f"{folder}/labelled")
    parts = labelled.where(F.col("fold") == FIT).select("x", "y").mapInArrow(partial(_equations, kernel), "place long, value double")
    # (FEATURES + 1) * (FEATURES + 2) sums, whatever the input.
    summed = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    weights = np.zeros(FEATURES + 1)
    if summed:
        system = np.zeros((FEATURES + 1) * (FEATURES + 2))
        for place, value in summed:
            system[place] = value
        system = system.reshape(FEATURES + 1, FEATURES + 2)
        count = system[-1, -2]
        weights = np.linalg.solve(system[:, :-1] + RIDGE * count * np.eye(FEATURES + 1) / FEATURES, system[:, -1])
    counted = labelled.where(F.col("fold") != FIT).select("x", "y").mapInArrow(partial(_counts, kernel, weights), "level long, n double, good double")
    levels = counted.groupBy("level").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).orderBy("level").collect()  # LEVELS rows at most
    at, chance = isotonic([tuple(r) for r in levels]) if levels else (np.zeros(1), np.full(1, 0.5))
    scored = features.mapInArrow(partial(_score, kernel, weights, at, chance), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
