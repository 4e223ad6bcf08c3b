"""Quality classifier: ordinal cumulative-link regression on hashed text.

A text is the mean of its hashed features: each word, each word's shape (case, digits,
marks, length) and whether it repeats the word before. One weight vector is shared by
all grades; ordered thresholds cut its score, so that

    P(grade <= k) = logistic(threshold[k] - score),

which gives an expected grade and the tail probability used for selection. The
thresholds stay ordered because the gaps between them are fitted as exponentials.

Ratings are graded 0 (poor), 1 (good but toxic) and 2 (good). The model is fitted on a
bounded sample of rated rows; every document is scored.

Defined results: null, empty and wordless texts have the feature "empty" alone;
repeated rows each get a row; extra columns are ignored by ``score``; without ratings
the weights are zero and the thresholds spread evenly.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.llm.common import table

#: Hashed features, rated rows used for fitting at most, and the tail probability that is kept.
FEATURES, SAMPLE_ROWS, KEEP = 1 << 13, 6_000, 0.5
#: Steps and rate of the optimiser, and the pull of weights to zero.
STEPS, RATE, RIDGE = 250, 0.3, 1e-5
#: Weights of the three kinds of features, so that shapes and repeats carry on unseen words.
KINDS = {"word": 0.5, "shape": 2.0, "repeat": 3.0}


def _slot(name: str) -> int:
    return xxhash.xxh32_intdigest(name.encode()) % FEATURES


def shape(word: str) -> str:
    """Runs of lower, upper, digit and mark characters, and a length class."""
    out, last = [], ""
    for c in word:
        kind = "x" if c.islower() else "X" if c.isupper() else "9" if c.isdigit() else "w" if c.isalpha() else c
        if kind != last:
            out.append(kind)
        last = kind
    return f"{''.join(out)}:{min(len(word), 24) // 4}"


_SLOTS: dict[str, tuple[int, int]] = {}


def _slots(word: str) -> tuple[int, int]:
    if (got := _SLOTS.get(word)) is None:
        if len(_SLOTS) > 100_000:
            _SLOTS.clear()
        got = _SLOTS[word] = (_slot(f"word {word.lower()}"), _slot(f"shape {shape(word)}"))
    return got


REPEAT, EMPTY = _slot("repeat"), _slot("empty")


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return np.array([EMPTY], np.int32), np.ones(1, np.float32)
    pairs = np.array([_slots(w) for w in words], np.int32)
    repeats = sum(map(operator.eq, words, words[1:]))
    slots = np.concatenate((pairs[:, 0], pairs[:, 1], [REPEAT]))
    values = np.concatenate((np.full(n, KINDS["word"] / n), np.full(n, KINDS["shape"] / n), [KINDS["repeat"] * repeats / n]))
    own, where = np.unique(slots, return_inverse=True)
    return own.astype(np.int32), np.bincount(where, values).astype(np.float32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, text: str | None) -> float:
        slots, values = features(text)
        return float(values @ self.weights[slots])

    def tails(self, score: float) -> list[float]:
        """P(grade >= k) for k of 1 and up."""
        return (1 / (1 + np.exp(np.clip(self.thresholds - score, -40, 40)))).tolist()


def loss_and_gradients(weights: np.ndarray, cuts: np.ndarray, rows: np.ndarray, slots: np.ndarray, values: np.ndarray, grades: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood with the pull of the weights, and its gradients; the first cut is a threshold, the others logs of gaps."""
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    thresholds = np.cumsum(np.concatenate((cuts[:1], np.exp(cuts[1:]))))
    score = np.bincount(rows, values * weights[slots], len(grades))
    upper = np.append(thresholds, np.inf)[grades] - score
    lower = np.insert(thresholds, 0, -np.inf)[grades] - score
    su, sl = np.where(np.isinf(upper), 1, sigmoid(upper)), np.where(np.isinf(lower), 0, sigmoid(lower))
    p = np.maximum(su - sl, 1e-12)
    du, dl = su * (1 - su) / p, sl * (1 - sl) / p
    d_score = (du - dl) / len(grades)
    d_cut = np.array([dl[grades == k + 1].sum() - du[grades == k].sum() for k in range(len(cuts))]) / len(grades)
    tail = np.cumsum(d_cut[::-1])[::-1]
    loss = -np.log(p).mean() + RIDGE / 2 * (weights @ weights)
    return float(loss), np.bincount(slots, values * d_score[rows], len(weights)) + RIDGE * weights, np.concatenate((tail[:1], tail[1:] * np.exp(cuts[1:])))


def fit(rows: np.ndarray, slots: np.ndarray, values: np.ndarray, grades: np.ndarray, n_grades: int) -> Model:
    """Full-batch Adam on the cumulative-link likelihood; entries are (row, slot, value)."""
    weights, cuts = np.zeros(FEATURES), np.concatenate(([-0.5 * (n_grades - 2)], np.zeros(n_grades - 2)))
    params = [weights, cuts]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, (STEPS if len(grades) else 0) + 1):
        _, *gradients = loss_and_gradients(weights, cuts, rows, slots, values, grades)
        for k, g in enumerate(gradients):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] -= RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-9)
    return Model(weights, np.cumsum(np.concatenate((cuts[:1], np.exp(cuts[1:])))))


def train(docs: DataFrame, ratings: DataFrame, n_grades: int = 3, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``sample_rows`` rated rows, drawn by a hash of the id."""
    drawn = ratings.where(F.col(grade_col).between(0, n_grades - 1)).select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade"))
    drawn = drawn.orderBy(F.xxhash64("id"), "id", "grade").limit(sample_rows)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "id")  # bounded by sample_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column("text")]
            arrays = [batch.column("grade"), pa.array([s.tobytes() for s, _ in found], pa.binary()), pa.array([v.tobytes() for _, v in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["grade", "slots", "values"])

    # A document has no more slots than FEATURES; the sample's rows bound what is gathered.
    got = sample.select("grade", "text").mapInArrow(run, "grade int, slots binary, values binary").limit(sample_rows).collect()
    slots = [np.frombuffer(r.slots, np.int32) for r in got]
    values = [np.frombuffer(r["values"], np.float32) for r in got]
    rows = np.repeat(np.arange(len(got)), [len(s) for s in slots])
    flat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return fit(rows, flat(slots, np.int32), flat(values, np.float32), np.array([r.grade for r in got], int), n_grades)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, expected_grade, tails): tails[k] is P(grade >= k + 1)."""
    df = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, score double, expected_grade double, tails array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.scores(t.as_py()) for t in batch.column("_text")]
            tails = [model.tails(s) for s in scores]
            arrays = [batch.column(id_col), pa.array(scores, pa.float64()), pa.array(map(sum, tails), pa.float64()), pa.array(tails, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, [id_col, "score", "expected_grade", "tails"])

    return df.mapInArrow(run, schema)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the label table: poor, good but toxic, good."""
    grade: Column = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = lambda: F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    model = train(docs, graded(labels.where(~out())))
    found = score(docs, model)
    p_good = F.element_at("tails", 1)
    return found.select("doc_id", out().alias("held_out"), "score", "expected_grade", p_good.alias("p_good"), (p_good >= KEEP).alias("kept"))


QUERIES = {"op8_quality_classifier": op8_quality_classifier}
SQL: dict[str, str] = {}
