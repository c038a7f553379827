"""The pipeline's stages on a small table with cases planted in it."""

from collections import Counter

import corpus_pipeline as p
from monthfusion.llm.queries import QUERIES, table

SMALL = "/root/testdata/sf0.001"


def test_names():
    assert [n for n, _ in p.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mixing", "token_records"]
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_stages_act_on_what_is_left(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    item = table(spark, SMALL, "benchmark").first().text
    words = [f"own{i} word" for i in range(120)]
    planted = {
        9001: " ".join(words), 9002: " ".join(words) + " and a bit more", 9003: " ".join(words),
        9004: "junk $$$ ### " * 60, 9005: " ".join(f"other{i} text" for i in range(60)) + " " + item,
        9006: " ".join(f"clean{i} prose" for i in range(80)),
    }
    rows = spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in planted.items()], docs.schema)
    docs = docs.unionByName(rows)
    left = {}
    for name, stage in p.STAGES:
        before = docs
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "token_records":
            assert docs.dtypes == before.dtypes
        left[name] = [r.doc_id for r in docs.select("doc_id").collect()]
    assert 9004 not in left["quality_rules"] and {9001, 9002, 9003, 9005, 9006} <= set(left["quality_rules"])
    assert 9001 in left["near_dedup"] and not {9002, 9003} & set(left["near_dedup"])
    assert 9005 not in left["decontamination"] and {9001, 9006} <= set(left["decontamination"])
    assert set(left["mixing"]) <= set(left["decontamination"]) and left["token_records"].count(9006) <= 3
    assert sorted(left["token_records"]) == sorted(left["mixing"])
    starts = docs.orderBy("doc_id", "start").collect()
    assert [r.start for r in starts][0] == 0 and sum(r.n_tokens for r in starts) == max(r.start + r.n_tokens for r in starts)


def test_stages_take_awkward_and_empty_tables(spark, awkward, empty):
    """NULL, empty, repeated and very long rows, and columns with names of the operators."""
    for docs in (awkward, empty):
        for name, stage in p.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.dtypes == docs.dtypes
            given, left = (Counter(map(str, df.collect())) for df in (docs, out))
            assert left.keys() <= given.keys()
            if name != "mixing":
                assert left <= given
        last = p.STAGES[-1][1](spark, docs, SMALL)
        assert sorted(str(r.doc_id) for r in last.collect()) == sorted(str(r.doc_id) for r in docs.collect())
