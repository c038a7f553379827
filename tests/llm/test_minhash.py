from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from monthfusion.llm import minhash as m
from monthfusion.llm.words import BLANK, shingle_sets, text_bytes, word_hashes, word_spans

SMALL = "/root/testdata/sf0.001"


def plain_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(5))))


def brute(rows):
    """(id, size, least id reachable) per row, by comparing all pairs that share a shingle."""
    sets = [plain_set(t) for _, t in rows]
    where = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            where[x].append(k)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in where[x] if j < k).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                root[max(find(k), find(j))] = min(find(k), find(j))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k), i)) for k, (i, _) in enumerate(rows)), key=str)


def spark_result(spark, df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in m.near_duplicates(spark, df).collect()), key=str)


def test_words_are_bytes_between_blanks():
    texts = ["Ab  c\x0bD", None, "", "no break \u0085x", "end", " start"]
    data, offsets = text_bytes(pa.array(texts))
    starts, ends, rows = word_spans(data, offsets, BLANK)
    got = [[] for _ in texts]
    for s, e, r in zip(starts, ends, rows):
        got[r].append(data[s:e].tobytes())
    assert got == [(t or "").encode().split() for t in texts]
    hashes = word_hashes(data, starts, ends)
    again = {}
    for s, e, h in zip(starts, ends, hashes):
        assert again.setdefault(data[s:e].tobytes().lower(), h) == h
    assert len(set(again.values())) == len(again)


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    from monthfusion.llm import words

    column = pa.array([" ".join(f"t{i % 50}" for i in range(k)) for k in (3, 5, 400, 4000)])
    whole = [s.tolist() for s in shingle_sets(column)]
    monkeypatch.setattr(words, "BLOCK", 7)
    monkeypatch.setattr(words, "CHUNK", 11)
    assert [s.tolist() for s in shingle_sets(column)] == whole


def test_signature_bins_match_with_chance_of_similarity():
    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 100, 100))
    one, two = (m.signature(np.unique(np.concatenate([both, x]))) for x in (a, b))
    assert abs((one == two).mean() - 600 / 800) < 0.1
    tiny = m.signature(np.unique(both[:1]))
    assert (tiny == both[0]).all()


def test_equal_to_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert spark_result(spark, df) == brute(rows)


def chain(n, words, step):
    """Texts of which neighbours are alike and distant ones are not."""
    stream = [f"s{i}" for i in range(words + n * step)]
    return [" ".join(stream[k * step : k * step + words]) for k in range(n)]


def test_chains_and_crowded_buckets(spark):
    texts = chain(40, 60, 3) + chain(30, 40, 8) + ["same text of six words here"] * 25
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    assert spark_result(spark, spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("stars", [0, 1, 5])
def test_any_number_of_star_rounds_finds_the_same(spark, monkeypatch, stars):
    monkeypatch.setattr(m, "STARS", stars)
    rows = list(enumerate(chain(24, 60, 4) + chain(20, 40, 7)))
    assert spark_result(spark, spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_texts_are_fetched_whatever_the_ends_of_their_hashes(spark, monkeypatch):
    monkeypatch.setattr(m, "ENDS", 2)
    rows = list(enumerate(chain(12, 60, 4)))
    assert spark_result(spark, spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def in_buckets(spark, texts, bands):
    """Groups of text numbers that the search links, with the buckets given."""
    run = m.NearDuplicates(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    keys = F.create_map(*(F.lit(x) for k, b in enumerate(bands) for x in (k, b)))
    nodes = run.save(run.nodes(run.sketches()).withColumn("node", F.col("doc_id")).withColumn("bands", keys[F.col("doc_id").cast("int")]))
    return sorted((r.node, r.label) for r in run.search(nodes).collect())


def test_one_common_bucket_is_enough_across_components(spark):
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(f"z{k}" for k in range(60)), " ".join(words), " ".join([*words[:57], "x", "y"])]
    assert in_buckets(spark, texts, [[7, 1], [7, 2], [7, 3]]) == [(2, 1)]


def test_no_pair_is_compared_twice(spark, monkeypatch):
    """Texts that the bounds take for near copies but that are none stay apart in every round."""
    compared, verify = [], m.NearDuplicates.verify

    def recorded(self, pairs, nodes):
        compared.extend(tuple(sorted((r.a, r.b))) for r in self.bounded(pairs, nodes).collect())
        return verify(self, pairs, nodes)

    monkeypatch.setattr(m.NearDuplicates, "verify", recorded)
    words = [f"w{k}" for k in range(510)]
    texts = [" ".join([*words, *(f"own{j}x{k}" for k in range(90))]) for j in range(8)]
    assert in_buckets(spark, texts, [[7, 8]] * 8) == []
    assert sorted(compared) == sorted(set(compared)) == [(a, b) for a in range(8) for b in range(a + 1, 8)]


@pytest.mark.parametrize("stars", [0, 3])
def test_a_bucket_in_several_parts(spark, monkeypatch, stars):
    monkeypatch.setattr(m, "STARS", stars)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        words = [[f"w{j}x{k}" for k in range(60)] for j in range(6)]
        texts = [" ".join(w) for w in words] + [" ".join([*w[:57], "x", "y"]) for w in words]
        assert in_buckets(spark, texts, [[7]] * 12) == [(k + 6, k) for k in range(6)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bitmaps_never_differ_more_than_sets():
    rng = np.random.default_rng(2)
    for n, own in ((1, 0), (3, 1), (40, 9), (900, 150), (9000, 1500)):
        both, a, b = (rng.integers(0, 1 << 63, k, dtype=np.uint64) for k in (n, own, own // 2))
        one, two = (np.unique(np.concatenate([both, x])) for x in (a, b))
        flipped = np.unpackbits((m.bitmap(one) ^ m.bitmap(two)).view(np.uint8)).sum()
        assert flipped <= len(np.setxor1d(one, two))


def test_awkward_rows(spark, awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert spark_result(spark, awkward) == brute(rows)
    assert spark_result(spark, empty) == []


def test_keep_one_row_of_each_class(spark, awkward, empty):
    kept = m.keep_one(spark, awkward)
    assert kept.columns == awkward.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert max(got.values()) == 1
    classes = {c for _, n, c in brute([(r.doc_id, r.text) for r in awkward.collect()]) if n}
    with_words = [i for i, t in got if plain_set(t)]
    assert sorted(with_words) == sorted(classes)
    assert m.keep_one(spark, empty).count() == 0
    assert kept.select(F.count("*")).first()[0] == len(got)


def test_star_rounds_need_few_steps(spark, monkeypatch):
    """All further centres of a bucket are compared in one round: every step costs the driver memory."""
    runs, search = [], m.NearDuplicates.search

    def kept(self, nodes):
        runs.append(self)
        return search(self, nodes)

    monkeypatch.setattr(m.NearDuplicates, "search", kept)
    rows = list(enumerate(chain(24, 60, 4) + chain(20, 40, 7)))
    assert spark_result(spark, spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    words = [f"w{k}" for k in range(510)]
    texts = [" ".join([*words, *(f"own{j}x{k}" for k in range(90))]) for j in range(8)]
    assert in_buckets(spark, texts, [[7, 8]] * 8) == []
    assert all(run.step <= 24 for run in runs)
