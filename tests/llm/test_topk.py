import math
import random

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.llm import topk

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType()), T.StructField("id", T.IntegerType())])


def brute(rows, k, every):
    kept = [(i, r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]]) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for at, vec_id, v in kept:
        if vec_id is None or vec_id % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i is None, i or 0) for other, i, w in kept if other != at)[:k]
        out += [(vec_id, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(scored, 1)]
    return sorted(out, key=str)


def rows_of(seed, n, dims=6):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice([-0.5, -0.25, 0.0, 0.125, 0.5, rnd.gauss(0, 1)]) for _ in range(dims)], "x", 1) for i in range(n)]
    rows += [(n, None, "x", 1), (n + 1, [0.1, None, 0.2], "x", 1), (n + 2, [float("nan")] * dims, "x", 1), (n + 3, [float("inf")] + [0.0] * (dims - 1), "x", 1)]
    rows += [(None, [2.0] * dims, "x", 1), (100, [], "x", 1), (100, [0.0] * dims, "x", 1), (50, [0.5, -0.5], "x", 1)]
    return rows + [rows[7], rows[50], rows[50]]


def test_matches_brute_force_with_ties_repeats_and_odd_rows(spark):
    rows = rows_of(1, 120)
    for block, query_block in ((8192, 1024), (16, 2)):
        got = topk.top_k(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 10 == 0, block=block, query_block=query_block).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, 5, 10)


def test_one_vector_copied_many_times(spark):
    rows = [(i, [0.25, -1.0, 0.5], "x", 1) for i in range(150)] + [(i, [0.5, -1.0, 0.5], "x", 1) for i in range(150, 155)]
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, block=40).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 5, 50)


def test_fewer_rows_than_results_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0], "x", 1), (3, [2.0], "x", 1)], SCHEMA)
    assert [tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 3, 256 * 512)]
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(frame.where("vec_id = 3"), F.col("vec_id") % 50 == 0).count() == 0


def test_the_walk_stops_where_lists_fall_off():
    rnd = np.random.default_rng(2)
    x = (rnd.pareto(1.0, (4000, 3)) * 100).astype(np.int64).astype(float)
    lists, best = topk.Lists(x), topk.Best(5)
    name = [(False, i, 0, i) for i in range(len(x))]
    q = np.array([3.0, 1.0, 2.0])
    lists.walk(q, best, name, None)
    assert [s for s, *_ in best.found] == sorted((-(x @ q)).tolist())[:5]
    assert lists.met < 400


def test_large_components_stay_exact(spark):
    rows = [(0, [8388607.0] * 2, "x", 1), (1, [8388607.0, 8388606.996], "x", 1), (2, [8388606.5] * 2, "x", 1)]
    schema = T.StructType([SCHEMA[0], T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    got = topk.top_k(spark.createDataFrame([r[:2] for r in rows], schema), F.col("vec_id") == 0).orderBy("rank").collect()
    one = [math.floor(256 * x) for x in rows[1][1]]
    assert [(r.vec_id, r.score) for r in got] == [(1, sum(a * math.floor(256 * 8388607.0) for a in one)), (2, 2 * math.floor(256 * 8388606.5) * math.floor(256 * 8388607.0))]
