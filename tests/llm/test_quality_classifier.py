import numpy as np
from pyspark.sql import types as T

from lamella.llm import quality_classifier as q

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("tails", T.StringType())])
DATA = "/root/testdata/sf0.1"


def test_gradient_and_order():
    rnd = np.random.default_rng(1)
    n, k = 400, 4
    slots = rnd.integers(0, 40, (n, 5))
    truth = rnd.normal(size=40) * 3
    latent = truth[slots].sum(1) / 5 + rnd.logistic(size=n) * 0.1
    grades = np.digitize(latent, [-1.0, 0.0, 1.0])
    model = q.fit(np.repeat(np.arange(n), 5), slots.ravel(), np.full(5 * n, 0.2), grades, k)
    assert (np.diff(model.thresholds) > 0).all()
    guess = np.array([sum(t > 0.5 for t in model.tails(model.weights[s].mean())) for s in slots])
    assert (np.abs(guess - grades) <= 1).mean() > 0.97 and (guess == grades).mean() > 0.75


def test_held_out_accuracy(spark):
    rows = q.op8_quality_classifier(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r.kept for r in rows if r.quality == 1]
    poor = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(poor) <= 0.2 * len(poor), (sum(good), len(good), sum(poor), len(poor))


def test_edges(spark):
    rows = [(1, None, "t"), (1, None, "t"), (2, "", "t"), (None, "x y", "t"), (3, "word " * 50_000, "t")]
    df = spark.createDataFrame(rows, SCHEMA)
    model = q.train(df, spark.createDataFrame([], "doc_id long, grade int"))
    got = q.score(df, model).collect()
    assert len(got) == 5 and all(0 <= r.expected_grade <= 2 and len(r.tails) == 2 for r in got)
    assert q.score(df.limit(0), model).collect() == []


def test_gradients_match_finite_differences():
    rnd = np.random.default_rng(3)
    rows, slots = np.repeat(np.arange(30), 6), rnd.integers(0, 12, 180)
    data = (rows, slots, rnd.normal(size=180), rnd.integers(0, 4, 30))
    weights, cuts = rnd.normal(size=12), np.array([-0.7, 0.2, -0.4])
    _, by_weight, by_cut = q.loss_and_gradients(weights, cuts, *data)
    for k, got in [*enumerate(by_weight), *((12 + k, g) for k, g in enumerate(by_cut))]:
        step = np.zeros(15)
        step[k] = 1e-6
        ends = [q.loss_and_gradients(weights + sign * step[:12], cuts + sign * step[12:], *data)[0] for sign in (1, -1)]
        assert abs((ends[0] - ends[1]) / 2e-6 - got) < 1e-6


def test_long_words_are_read_whole():
    assert q.shape("a" * 70 + "9") != q.shape("a" * 71)
