import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from monthfusion.llm import decontaminate as d

SMALL = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def shingles(w):
    k = min(5, len(w))
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(docs, items):
    """Best similarity over all windows of all documents and items that share a shingle."""
    where, out = defaultdict(list), {}
    items = [(i, words(t)) for i, t in items]
    for n, (_, w) in enumerate(items):
        k = min(5, len(w))
        for q in range(len(w) - k + 1 if w else 0):
            where[k, " ".join(w[q : q + k])].append((n, q))
    for doc, text in docs:
        w = words(text)
        starts = {(n, p - q) for k in range(1, 6) for p in range(len(w) - k + 1) for n, q in where.get((k, " ".join(w[p : p + k])), ())}
        for n, s in starts:
            item, v = items[n]
            a, b = shingles(w[max(s, 0) : s + len(v)]), shingles(v)
            value = sum(map(len, a & b)) / sum(map(len, a | b))
            if value >= 0.75:
                out[doc, item] = max(value, out.get((doc, item), 0))
    return out


def result(spark, docs, items):
    return {(r.doc_id, r.item_id): r.similarity for r in d.contaminated(spark, docs, items).collect()}


def same(a, b):
    return a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_given_tables(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    found = result(spark, docs, items)
    assert found and same(found, brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]))


def test_edited_passages_and_short_items(spark, awkward):
    item = " ".join(f"q{i}" for i in range(40))
    changed = item.split()
    edits = {10: item, 11: item.upper().replace(" ", "! "), 12: " ".join(changed[:37] + ["odd"] + changed[38:]), 13: " ".join(changed[:9] + ["new"] + changed[9:]), 14: " ".join(changed[5:]), 15: " ".join(changed[::2])}
    docs = [(k, f"before {v} after " * (1 + k % 2)) for k, v in edits.items()] + [(20, "only three short words here"), (None, item)]
    items = [(1, item), (2, "three short words"), (3, None), (4, ""), (None, "word1 thing1 of the word2 thing2 of the word3")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = result(spark, table, bench)
    assert same(found, brute(docs, items))
    assert {(k, 1) for k in (10, 11, 12, 13, None)} <= found.keys() and (15, 1) not in found
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert same(result(spark, awkward, bench), brute(rows, items))
    clean = d.drop_contaminated(spark, awkward, bench)
    bad = {i for i, _ in brute(rows, items)}
    assert clean.columns == awkward.columns
    assert sorted((r.doc_id, r.text) for r in clean.where("doc_id IS NOT NULL").collect() if r.text) == sorted((i, t) for i, t in rows if i is not None and i not in bad and t)
    assert clean.where("text IS NULL").count() == 2


def test_one_word_replaced_in_the_middle_of_a_short_item(spark):
    """What the threshold does with it: at 40 words the length of the words decides."""
    short, even = [f"q{i}" for i in range(40)], [f"q{i + 10}" for i in range(40)]
    docs = [(k, " ".join(w[:20] + ["odd"] + w[21:])) for k, w in ((1, short), (2, even[:30]), (3, even))]
    items = [(1, " ".join(short)), (2, " ".join(even[:30])), (3, " ".join(even))]
    found = result(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert same(found, brute(docs, items))
    assert (1, 1) not in found and (2, 2) not in found and (3, 3) in found


def test_empty_tables(spark, awkward, empty):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert result(spark, empty, bench) == {} and result(spark, awkward, bench.limit(0)) == {}
    assert d.drop_contaminated(spark, awkward, bench.limit(0)).count() == awkward.count()


def test_blocks_guarantee_the_radius(spark):
    assert sum(n for _, n in d.CUTS) == d.BITS and min(n for _, n in d.CUTS) >= 8 and d.RADIUS == 38
    rng = random.Random(3)
    rows = []
    for k in range(200):
        a = rng.getrandbits(d.BITS)
        flips = rng.sample(range(d.BITS), d.RADIUS if k % 2 else rng.randint(0, d.RADIUS))
        rows.append((k, *(signed(x) for x in (a, a ^ sum(1 << f for f in flips)))))
    df = spark.createDataFrame(rows, "k long, a array<long>, b array<long>")
    one = df.select("k", F.col("a").alias("fingerprint")).select("k", F.expr(d.own_blocks()))
    two = df.select("k", F.col("b").alias("fingerprint")).select("k", F.expr(d.near_blocks()))
    assert one.count() == 200 * d.BLOCKS and two.count() == 200 * sum(len(d.masks(n)) for _, n in d.CUTS)
    assert one.join(two, ["k", "block", "bits"]).select("k").distinct().count() == 200


def signed(x):
    return [v - (1 << 64) if v >> 63 else v for v in (x & (1 << 64) - 1, x >> 64)]


def test_recall_against_brute_force(spark):
    """Items of 16 to 59 words with one to three words replaced, dropped or put in: of all
    windows that reach the threshold at least nine in ten are found."""
    rng = random.Random(8)
    items, docs = [], []
    for k in range(90):
        n = 16 + k % 44
        item = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(n)]
        items.append((k, " ".join(item)))
        for e in range(4):
            w = list(item)
            for _ in range(e):
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 1)] = [f"new{rng.random()}"] * rng.randint(0, 1)
            docs.append((10 * k + e, " ".join(["lead"] * rng.randint(0, 9) + w + ["trail"] * 5)))
    want = brute(docs, items)
    found = result(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert len(want) > 150 and set(found) <= set(want)
    assert len(found) >= 0.99 * len(want) and all(abs(found[k] - want[k]) < 1e-9 for k in found)
    # Some are far from exact copies, so fingerprints do differ.
    assert sum(v < 0.9 for v in want.values()) > 50


def test_long_item_lists_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    items = [(1, " ".join(f"q{i}" for i in range(40))), (2, "three short words")]
    docs = [(1, f"a {items[0][1]} b"), (2, "with three short words in it"), (2, "with three short words in it"), (None, items[0][1]), (3, "none")]
    found = result(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert same(found, brute(docs, items)) and len(found) == 3


def test_native(spark):
    items = d.items_of(spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    plan = d.windows(spark.read.parquet(f"{SMALL}/documents.parquet"), items, spark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan and "Cartesian" not in plan
