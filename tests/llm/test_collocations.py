import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from monthfusion.llm import collocations as c


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longest[p[i : i + k]] = max(longest[p[i : i + k]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * longest[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def result(spark, df, least=3, top=2000):
    return sorted(tuple(r) for r in c.collocations(spark, df, least, top).collect())


def rows_of(df):
    return [(r.lang, r.text) for r in df.select("lang", "text").collect()]


def invented(seed, n):
    rng = np.random.default_rng(seed)
    parts = ["the", "Of", "of", "a b", "new york", "New York city", "x x x", ".", ",", "\n", "\t", "!", "é", "É", "中 中", "w\x0bq", "\r\n", "a;b"]
    p = rng.dirichlet(np.ones(len(parts)))
    return [(["en", "de", None, "und"][rng.integers(4)], " ".join(rng.choice(parts, rng.integers(0, 60), p=p))) for k in range(n)]


@pytest.mark.parametrize("seed, least, top", [(1, 3, 2000), (2, 3, 2000), (3, 5, 7)])
def test_equal_to_brute_force(spark, seed, least, top):
    rows = invented(seed, 120)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert result(spark, df, least, top) == brute(rows, least, top)


def test_filters_are_lossless_and_merge(monkeypatch):
    rng = np.random.default_rng(4)
    for n, size, ids in ((2, 5000, 40), (3, 20_000, 9), (4, 1, 5), (2, 300, 1), (4, 4000, 1 << 40)):
        words = [rng.integers(0, ids, size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(n)]
        whole = c.Filter.of(words)
        plain = Counter(zip(*(w.tolist() for w in words)))
        growing = c.Growing()
        for k in range(0, size, 700):
            growing.add(c.Filter.from_bytes(c.Filter.of([w[k : k + 700] for w in words]).to_bytes()))
        for f in (whole, c.Filter.from_bytes(whole.to_bytes()), growing.take()):
            got = [c.first_word(f.first, f.others), *f.others]
            assert dict(zip(zip(*(w.tolist() for w in got)), f.counts.tolist())) == plain
            assert len(f) == len(plain) and (f.first[1:] >= f.first[:-1]).all()


def test_different_phrases_with_one_permuted_id_stay_apart():
    a, b = np.array([5, 5, 9], np.uint64), np.array([7, 8, 7], np.uint64)
    first = np.array([1, 1, 1], np.uint64)
    f = c.Filter.summed(np.tile(first, 2), [np.tile(a, 2), np.tile(b, 2)], np.array([1, 300, 2, 1, 1, 1]))
    again = c.Filter.from_bytes(f.to_bytes())
    found = dict(zip(zip(again.others[0].tolist(), again.others[1].tolist()), again.counts.tolist()))
    assert found == {(5, 7): 2, (5, 8): 301, (9, 7): 3}


def test_small_limits_change_nothing(spark, monkeypatch):
    rows = invented(6, 60)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    column = df.toArrow().combine_chunks().to_batches()[0]
    whole = [x[0].tolist() for x in c.occurrences(column, 0)]
    monkeypatch.setattr(c, "CHUNK", 50)
    assert sum((x[0].tolist() for x in c.occurrences(column, 0)), []) == sum(whole, [])
    monkeypatch.setattr(c, "BITS", 7)
    bits = np.full(1 << (c.BITS - 6), ~np.uint64(0))
    ids, joined, *_ = next(c.occurrences(column, 0))
    for n in (2, 3, 4):
        for size in range(7):
            assert len(c.phrases(ids[:size], joined[: max(size - 1, 0)], n, bits)[0]) <= max(size - n + 1, 0)


def test_awkward_rows(spark, awkward, empty):
    assert result(spark, awkward, 2) == brute(rows_of(awkward), 2, 2000)
    assert result(spark, empty) == []
    assert result(spark, awkward.selectExpr("CAST(NULL AS string) AS text", "lang")) == []
