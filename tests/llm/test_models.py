"""The trained operators: exact parts against plain versions, learning by held-out figures."""

import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa

from monthfusion.llm import classifier as c
from monthfusion.llm import hidden_markov as h
from monthfusion.llm.words import numbers

MEDIUM = "/root/testdata/sf0.01"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def held(i, folds=10):
    return i is not None and zlib.crc32(str(i).encode()) % folds == 0


def base_scores(rows):
    counts = Counter(x for i, t in rows if not held(i) for x in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = tokens(t)
        score = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        out.append((i, held(i), len(w), sum(x in counts for x in w), total, round(score, 4)))
    return sorted(out, key=str)


def test_counts_base_and_gain_on_held_out_texts(spark, monkeypatch):
    monkeypatch.setattr(h, "LOOKUP", 5000)  # so that many words take the join
    df = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    got = h.scores(spark, df).collect()
    assert sorted(((*r[:5], round(r.base_score, 4)) for r in got), key=str) == base_scores([(r.doc_id, r.text) for r in df.collect()])
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_awkward_texts(spark, awkward, empty):
    got = h.scores(spark, awkward).collect()
    assert sorted(((*r[:5], round(r.base_score, 4)) for r in got), key=str) == base_scores([(r.doc_id, r.text) for r in awkward.collect()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert h.scores(spark, empty).count() == 0


def small_model():
    rng = np.random.default_rng(3)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return h.Model(norm(rng.random(h.STATES), 0), norm(rng.random((h.STATES, h.STATES)), 1), norm(rng.random((6, h.STATES)), 0))


def test_forward_recursion_sums_over_all_paths():
    m = small_model()
    texts = [np.array(x, np.uint16) for x in ([3], [1, 5, 2], [0, 0, 4, 1])]
    for text, got in zip(texts, h.likelihoods(m, texts)):
        total = 0.0
        for path in product(range(h.STATES), repeat=len(text)):
            p = m.start[path[0]] * m.emit[text[0], path[0]]
            for k in range(1, len(text)):
                p *= m.move[path[k - 1], path[k]] * m.emit[text[k], path[k]]
            total += p
        assert abs(got - math.log10(total)) < 1e-9


def test_expected_counts_equal_the_sum_over_paths():
    m = small_model()
    texts = [np.array(x, np.uint16) for x in ([1, 5, 2], [4, 0])]
    counts, moves, starts = np.zeros((6, h.STATES)), np.zeros((h.STATES, h.STATES)), np.zeros(h.STATES)
    h.expected(m, texts, np.array([True, True]), counts, moves, starts)
    want = [np.zeros_like(x) for x in (counts, moves, starts)]
    for text in texts:
        weights = {}
        for path in product(range(h.STATES), repeat=len(text)):
            p = m.start[path[0]] * m.emit[text[0], path[0]]
            for k in range(1, len(text)):
                p *= m.move[path[k - 1], path[k]] * m.emit[text[k], path[k]]
            weights[path] = p
        total = sum(weights.values())
        for path, p in weights.items():
            want[2][path[0]] += p / total
            for k, s in enumerate(path):
                want[0][text[k], s] += p / total
                if k:
                    want[1][path[k - 1], s] += p / total
    for got, w in zip((counts, moves, starts), want):
        assert np.allclose(got, w)


def test_lookup_finds_what_it_holds():
    codes = np.unique(np.random.default_rng(4).integers(-(1 << 62), 1 << 62, 50_000))
    table = h.Lookup(codes[::2])
    got = table(codes)
    assert (got[::2] == np.arange(len(codes[::2]))).all() and (got[1::2] == -1).all()


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in c.quality_scores(spark, docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    out = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in out) / len(out) > 0.93


def test_classifier_takes_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1), (6, 1), (5, 0)], "doc_id long, quality int")
    got = c.quality_scores(spark, awkward, labels).collect()
    assert len(got) == awkward.count() and all(math.isfinite(r.score) for r in got)
    assert {r.score for r in c.quality_scores(spark, awkward, labels.limit(0)).collect()} == {0.5}
    assert c.quality_scores(spark, empty, labels).count() == 0


def test_isotonic_points_rise():
    at, chance = c.isotonic([(0, 5, 0), (3, 4, 3), (5, 4, 1), (9, 10, 9)])
    assert (np.diff(at) > 0).all() and (np.diff(chance) > 0).all() and len(at) == 3


def test_statistics_of_one_text_do_not_depend_on_others():
    texts = ["A b b!\nc | 12", None, "é " * 50, "x"]
    together = c.statistics(pa.array(texts))
    alone = np.concatenate([c.statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone) and (together[1] == 0).all()


def plain_statistics(text):
    data = (text or "").encode()
    words = data.lower().split()
    size, some = max(len(data), 1), max(len(words), 1)
    kinds = [b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b"!?", b".,;:", b"\n", bytes(range(128, 256))]
    counts = [sum(x in k for x in data) for k in kinds]
    often = Counter(words)
    again = sum(a == b for a, b in zip(words, words[1:]))
    return [n / size for n in counts] + [
        math.log1p(len(words)), sum(map(len, words)) / some, math.log1p(max(map(len, words), default=0)), len(often) / some,
        max(often.values(), default=0) / some, again / some, math.log1p(len(words) / (counts[5] + 1)),
    ]


def plain_isotonic(levels):
    """Largest of least means over all spans that hold a level; equal neighbours are one block."""
    fitted = []
    for i in range(len(levels)):
        means = [min(sum(g for _, _, g in levels[a:b]) / sum(n for _, n, _ in levels[a:b]) for b in range(i + 1, len(levels) + 1)) for a in range(i + 1)]
        fitted.append(max(means))
    points = []
    for value in sorted(set(round(f, 12) for f in fitted)):
        block = [x for x, f in zip(levels, fitted) if round(f, 12) == value]
        n, good = sum(b[1] for b in block), sum(b[2] for b in block)
        level = sum(b[0] * b[1] for b in block) / n
        points.append((c.LOW + (level + 0.5) * (c.HIGH - c.LOW) / c.LEVELS, (good + 0.5) / (n + 1)))
    return points


def test_classifier_equals_a_plain_version(spark):
    """Features, equations, ridge weights and calibration from whole matrices."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.select("doc_id", "text").collect()
    known = {r.doc_id: float(r.quality) for r in labels.collect() if r.quality is not None}
    x = np.array([plain_statistics(r.text) for r in rows])
    spread = x.std(axis=0)
    x = np.clip((x - x.mean(axis=0)) / np.where(spread > 1e-9, spread, 1), -8, 8)
    n = x.shape[1]
    unit = [(int(v) >> 11) / 2**53 + 2**-54 for v in numbers(2 * n * c.FEATURES, 7)]
    half = n * c.FEATURES
    normal = np.array([math.sqrt(-2 * math.log(unit[k])) * math.cos(2 * math.pi * unit[half + k]) for k in range(half)]).reshape(n, c.FEATURES)
    phase = np.array([(int(v) >> 11) * 2 * math.pi / 2**53 for v in numbers(c.FEATURES, 8)])
    z = np.hstack([np.cos(x @ normal / c.WIDTH + phase) * math.sqrt(2 / c.FEATURES), np.ones((len(x), 1))])
    fold = np.array([zlib.crc32(str(r.doc_id).encode()) % 3 for r in rows])
    y = np.array([known.get(r.doc_id, np.nan) for r in rows])
    fit = (fold == 0) & ~np.isnan(y)
    calibrate = (fold == 2) & ~np.isnan(y)
    # Ridge as least squares with rows of their own for the penalty.
    penalty = math.sqrt(c.RIDGE * fit.sum() / c.FEATURES) * np.eye(c.FEATURES + 1)
    weights = np.linalg.lstsq(np.vstack([z[fit], penalty]), np.concatenate([y[fit], np.zeros(c.FEATURES + 1)]), rcond=None)[0]
    raw = z @ weights
    level = np.clip((raw - c.LOW) / (c.HIGH - c.LOW) * c.LEVELS, 0, c.LEVELS - 1).astype(int)
    counted = [(k, int((level[calibrate] == k).sum()), y[calibrate][level[calibrate] == k].sum()) for k in sorted(set(level[calibrate]))]
    want = np.interp(raw, *zip(*plain_isotonic(counted)))
    got = {r.doc_id: (r.held_out, r.score) for r in c.quality_scores(spark, docs, labels).collect()}
    assert all(got[r.doc_id][0] == (f == 1) for r, f in zip(rows, fold))
    assert max(abs(got[r.doc_id][1] - w) for r, w in zip(rows, want)) < 1e-6
