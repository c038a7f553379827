import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from monthfusion.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def stats(df):
    rows = q.statistics(df.select("doc_id", "text")).select("text", "stats.*").collect()
    return [(r.text, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in rows]


def test_statistics_equal_plain_counts(spark, awkward):
    texts = ["a a a a", "a b c a b c", "x\nx\n\n x\n", "a b c d a b c x b c d", "| || #", "one word still one", " ".join("ab"[i % 2] for i in range(999))]
    for df in (awkward, spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), spark.read.parquet(f"{SMALL}/documents.parquet")):
        for text, got in stats(df):
            assert got == brute(text)


def test_model_tells_junk_from_prose_without_labels(spark):
    rows = {r.doc_id: r for r in q.judge(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    right = [(rows[i].kept or rows[i].n_words < 50) == bool(y) for i, y in labels if y == 1 or not rows[i].base_failed]
    assert sum(right) / len(right) > 0.97
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows.values())
    assert not any(r.kept and r.base_failed for r in rows.values())


def test_iterations_raise_likelihood(spark):
    votes = [{-1: 0.1, 0: 0.9}, {-1: 0.1, 0: 0.9}]
    rules = (q.Rule("one", "x < 0"), q.Rule("two", "y < 0"))
    rows = [(-1, -1)] * 90 + [(0, 0)] * 890 + [(-1, 0)] * 10 + [(0, -1)] * 10
    voted = spark.createDataFrame(rows, "x int, y int").select(*q.votes(rules))
    model = q.fit(voted, rules)
    assert 0.85 < model.prior < 0.95 and model.bad["one"][-1] > 0.7 and len(votes) == 2
    low = voted.withColumn("p", model.probability()).groupBy("vote_one", "vote_two").agg(F.max("p").alias("p")).collect()
    by_votes = {(r.vote_one, r.vote_two): r.p for r in low}
    assert by_votes[-1, -1] < 0.05 < 0.95 < by_votes[0, 0]


def test_keep_good_keeps_columns_and_rows(spark, awkward, empty):
    kept = q.keep_good(spark, awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in q.judge(spark, awkward).where("kept").collect()} == {r.doc_id for r in kept.collect()}
    assert q.judge(spark, empty).count() == 0 and q.keep_good(spark, empty).count() == 0


@pytest.mark.parametrize("node", ["Python", "Exchange", "MapInArrow"])
def test_statistics_stay_in_one_native_stage(spark, node):
    plan = q.statistics(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert node not in plan
