import hashlib
import math
import random

import numpy as np
from pyspark.sql import types as T

from lamella.llm import centroids

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("cluster", T.StringType()), T.StructField("id", T.IntegerType())])


def brute(rows, k, rounds, dims):
    kept = [(r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]]) for r in rows if r[1] is not None and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1])]
    by_hash = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in by_hash[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(cents))

    for _ in range(rounds):
        held = [[] for _ in cents]
        for _, v in kept:
            held[nearest(v)[1]].append(v)
        cents = [[sum(col) // len(h) for col in zip(*h, strict=True)] if h else c for h, c in zip(held, cents, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for *_, d in found)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, sum(e for _, b, e in found if b == c), total, digest[c]) for i, c, d in found), key=str)


def rows_of(seed, n, dims):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.01, rnd.gauss(0.1 * (i % 4), 0.3)]) for _ in range(dims)], "x", 1) for i in range(n)]
    rows += [(n, None, "x", 1), (n + 1, [0.1] * (dims - 1), "x", 1), (n + 2, [0.1] * (dims - 1) + [None], "x", 1), (n + 3, [float("nan")] * dims, "x", 1), (n + 4, [float("-inf")] * dims, "x", 1), (n + 5, [], "x", 1)]
    return rows + [(None, [0.2] * dims, "x", 1), (5, [0.2] * dims, "x", 1)] + rows[:3] + [(n + 10 + i, [0.25] * dims, "x", 1) for i in range(n // 2)]


def result(frame, **how):
    found, cents = centroids.cluster(frame, **how)
    return sorted((tuple(r) for r in centroids.with_inertia(found, cents).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


def test_matches_brute_force(spark):
    rows = rows_of(3, 90, 7)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows, 6, 5, 7)
    assert result(frame, k=6, dims=7) == want
    assert result(frame.repartition(1), k=6, dims=7) == want


def test_few_and_no_vectors(spark):
    rows = rows_of(4, 3, 64)[:3]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows, 40, 5, 64)
    assert result(spark.createDataFrame([], SCHEMA)) == []
    same = [(i, [0.5] * 64, "x", 1) for i in range(50)]  # 40 equal centroids: all vectors go to the first
    assert {r[1] for r in result(spark.createDataFrame(same, SCHEMA))} == {0}


def test_the_scan_is_exact_and_leaves_centroids_out():
    rnd = np.random.default_rng(5)
    x = np.concatenate([rnd.integers(-9, 9, (300, 5)), rnd.integers(-(1 << 24), 1 << 24, (60, 5)), np.tile([[3, 3, 3, 3, 3]], (30, 1))])
    cents = np.concatenate([x[::30], x[:1], rnd.integers(-9, 9, (8, 5))])
    scan = centroids.Scan(cents)
    number, distance = scan.nearest(x.astype("<i4"))
    full = ((x[:, None, :] - cents[None]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    spread = np.arange(0, 4000, 100)[:, None] + rnd.integers(-5, 5, (40, 5))
    scan = centroids.Scan(spread)
    scan.nearest(np.repeat(spread, 10, axis=0) + 1)
    assert scan.measured < 3 * 400  # of 40 x 400
