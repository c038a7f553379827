import re

from monthfusion.llm import mixing as m


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    free, left, target = set(names), sum(sizes.values()), {}
    while free:
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]]
        if not over:
            total = sum(weight[x] for x in free)
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = 3 * sizes[s]
            free.discard(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def taken(spark, df):
    return m.with_copies(df, m.mix(spark, df)).collect()


def sums(rows, value):
    out = {}
    for r in rows:
        out[r.source] = out.get(r.source, 0) + value(r)
    return out


def test_targets_are_met(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = taken(spark, df)
    target = plain_targets(sums(rows, lambda r: size(r.text)))
    reached = sums(rows, lambda r: r.mix_taken * r.mix_size)
    for r in rows:
        assert r.mix_size == size(r.text) and 0 <= r.mix_taken <= 3 and abs(r.mix_target - target[r.source]) < 1e-6 * target[r.source]
    assert all(abs(reached[s] - t) < 0.03 * t for s, t in target.items())
    again = taken(spark, df.repartition(5))
    assert sorted((r.doc_id, r.mix_taken) for r in again) == sorted((r.doc_id, r.mix_taken) for r in rows)


def test_small_source_is_capped_and_longer_documents_preferred(spark):
    rows = [(k, "w " * (1 + k % 40), "big") for k in range(2000)] + [(5000 + k, "w w w", "tiny") for k in range(4)]
    got = taken(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert all(r.mix_taken == 3 for r in got if r.source == "tiny")
    big = [r for r in got if r.source == "big"]
    rate = [sum(r.mix_taken for r in part) / len(part) for part in ([r for r in big if r.mix_size < 8], [r for r in big if r.mix_size >= 32])]
    assert rate[0] < rate[1] and abs(sum(r.mix_taken * r.mix_size for r in big) - big[0].mix_target) <= 20


def test_mixture_repeats_rows(spark, awkward, empty):
    rows = taken(spark, awkward)
    out = m.mixture(spark, awkward)
    assert out.columns == awkward.columns
    assert out.count() == sum(r.mix_taken for r in rows)
    assert all(r.mix_taken == 0 for r in rows if size(r.text) == 0)
    assert {(r.source, r.mix_source_size) for r in rows} == set(sums(rows, lambda r: size(r.text)).items())
    assert taken(spark, empty) == [] and m.mixture(spark, empty).count() == 0


def test_columns_with_names_of_the_figures_are_kept(spark):
    rows = [(k, f"word number {k} of the text", "s", f"keep{k}", k / 2, "own") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_size string, mix_rank double, `mix_row` string")
    out = m.mixture(spark, df)
    assert out.dtypes == df.dtypes
    assert {tuple(r) for r in out.collect()} <= set(rows) and out.count() > 0
