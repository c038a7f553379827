import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from monthfusion.llm import centroids as c

SMALL = "/root/testdata/sf0.01"


def brute(rows, k=40, rounds=5, components=64):
    """Plain integers throughout."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centers = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(centers))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for j in range(len(centers)):
            own = [v for (_, v), f in zip(kept, found) if f == j]
            if own:
                centers[j] = [sum(x) // len(own) for x in zip(*own)]
    final = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in final:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in centers]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, d, j in final)


def result(spark, df, **given):
    return Counter(tuple(r) for r in c.clusters(spark, df, **given).collect())


def test_equal_to_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet").repartition(3)
    assert result(spark, df) == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_tables_give_plain_distances():
    rng = np.random.default_rng(1)
    for spread in (3, 200, 100_000, c.LIMIT):
        vectors, centers = rng.integers(-spread, spread, (9, 500)), rng.integers(-spread, spread, (9, 7))
        plain = ((vectors[:, :, None] - centers[:, None, :]) ** 2).sum(axis=0)
        cluster, distance = c.nearest(vectors, centers)
        assert (cluster == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


def test_awkward_vectors(spark):
    rows = [
        (1, [0.5, 1.25]), (1, [0.5, 1.25]), (1, [0.5, -3.0]), (None, [9.0, 9.0]), (None, [9.0, 8.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [-0.001, 0.0]), (9, [1.0, 2.0, 3.0]), (10, [-100000.5, 99999.75]), (11, [4.0, 4.0]), (12, [4.5, 4.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cluster", "2 AS hash", "'x' AS vector", "3 AS n")
    for k in (1, 3, 40):
        assert result(spark, df, k=k, components=2) == brute(rows, k, components=2)
    assert result(spark, df.limit(0), components=2) == Counter()
    same = spark.createDataFrame([(i % 3, [1.0, 2.0]) for i in range(50)], "vec_id long, embedding array<double>")
    assert result(spark, same, k=4, components=2) == brute([(i % 3, [1.0, 2.0]) for i in range(50)], 4, components=2)


def test_components_beyond_the_bound_are_named():
    with pytest.raises(ValueError, match="524288"):
        c.integers(pa.array([[1e30, 0.0]]), 2)
