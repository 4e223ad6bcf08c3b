"""Toxicity by a weighted finite-state grammar over clauses.

Words are first mapped to symbols: insult, threat, target, negation, report, intensifier,
intent, or other; marks that end a clause are a symbol of their own. Six transducers are
composed, each reading what the one before writes:

* insult takes its stronger arc where an intensifier stands at most ``REACH`` words before,
* threat takes its stronger arc where words of intent stand at most ``REACH`` words before,
* negation denies an insult or threat at most ``REACH`` words after it,
* reported speech covers those from a reporting word to the end of the clause,
* target notes whether the clause names someone,
* clause keeps the heaviest path to an insult and to a threat, and when the clause ends
  writes the heavier of the two.

Arcs have weights and a path weighs the sum of its arcs, so an insult word counts by the
clause it stands in. What a clause writes are the arcs of its path. A document's score is
a logistic function of the sum, over arcs, of weight times the logarithm of one more than
the number of its clauses that take the arc; for a single clause that is its path's weight,
scaled. The arcs' weights start from the priors below and are fitted to labels, but keep
their sign: targets, intent and intensifiers never lower a score, denial and report never
raise one. Which path of a clause is the heaviest is decided by the priors. The insult arcs
are widened by words that the labelled sample shows in toxic texts only, in ever different
surroundings.

Only clauses with an insult or threat can match, so the transducers run on those alone.
How far the score rests on each part of the grammar on the given labels is told in the
README.

Defined results: null, empty and wordless texts match nothing and get the score of the
bias; repeated rows each get a row; extra columns are ignored; without labels the
priors are used as they are; a null id counts as the empty text where held out rows
are told apart.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.llm.common import table

#: The seed lexicon.
INSULTS = "idiot moron stupid scum trash pathetic worthless disgusting loser clown fool dumb imbecile vermin filth coward freak creep".split()
THREATS = "kill hurt destroy beat stab shoot burn punish crush murder strangle".split()
TARGETS = "you your yours u he she they him her them his their these those people everyone".split()
NEGATIONS = "not no never nor neither without isn't aren't wasn't don't doesn't didn't won't cannot can't".split()
REPORTS = "said says say called calls wrote writes quoted quote claimed claims alleged reportedly according told".split()

INTENSIFIERS = "such so very really truly total complete utter absolute damn bloody fucking".split()
INTENTS = "will shall must should want wants gonna going deserve deserves i'll we'll let's".split()

#: Labelled rows used for fitting at most, drawn by a hash of the id.
SAMPLE_ROWS = 20_000
#: Words back that a negation, an intensifier and words of intent reach.
REACH = 3
#: For a learned insult: documents, share of toxic ones, share of different surroundings, and words at most.
LEARNED_DOCS, LEARNED_SHARE, LEARNED_VARIETY, LEARNED_WORDS = 10, 0.9, 0.6, 200

#: Arcs and their prior weights; a fitted weight keeps the sign.
ARCS = {
    "insult": 6.0,
    "intense": 0.5,
    "threat": 0.3,
    "intent": 2.0,
    "insult_target": 0.5,
    "threat_target": 5.2,
    "denied": -3.0,
    "reported": -2.0,
}
BIAS = -4.5
#: Strength of the pull to the priors, in labelled rows.
PULL = 2.0

_END = re.compile(r"[.!?;:\n]+")
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")


class Transducer:
    """A deterministic transducer: ``step(state, symbol)`` gives the next state and the symbol written."""

    start: object = 0

    def step(self, state, symbol):
        raise NotImplementedError

    def __rshift__(self, after: Transducer) -> Transducer:
        return _Composed(self, after)


class _Composed(Transducer):
    """What the first writes is read by the second; reached transitions are remembered."""

    def __init__(self, first: Transducer, second: Transducer):
        self.first, self.second, self.start = first, second, (first.start, second.start)
        self.known: dict = {}

    def step(self, state, symbol):
        if (got := self.known.get((state, symbol))) is None:
            a, middle = self.first.step(state[0], symbol)
            b, out = self.second.step(state[1], middle)
            got = self.known[state, symbol] = ((a, b), out)
        return got


class Near(Transducer):
    """Adds an arc to the named symbols while a cue is at most ``REACH`` words back in the clause.

    A symbol of an insult or threat is a tuple: its kind and the arcs taken so far.
    """

    def __init__(self, cue: str, arc: str, kinds: tuple[str, ...]):
        self.cue, self.arc, self.kinds = cue, arc, kinds

    def step(self, state, symbol):
        if symbol == self.cue:
            return REACH, symbol
        if symbol == "end":
            return 0, symbol
        return max(0, state - 1), (*symbol, self.arc) if state and symbol[0] in self.kinds else symbol


class Reported(Transducer):
    def step(self, state, symbol):
        if symbol in ("report", "end"):
            return int(symbol == "report"), symbol
        return state, (*symbol, "reported") if state and isinstance(symbol, tuple) else symbol


class Target(Transducer):
    """Writes a targeted end for a clause that names someone."""

    def step(self, state, symbol):
        if symbol == "end":
            return 0, "targeted end" if state else "end"
        return int(state or symbol == "target"), symbol


def weight(path: tuple[str, ...]) -> float:
    """Prior weight of a path, the sum of its arcs; of no path, less than any."""
    return sum(ARCS[a] for a in path) if path else -np.inf


class Clause(Transducer):
    """Keeps the heaviest path to an insult and to a threat, and writes the heavier when the clause ends."""

    start = ((), ())

    def step(self, state, symbol):
        if isinstance(symbol, tuple):
            at = ("insult", "threat").index(symbol[0])
            best = max(state[at], symbol, key=weight)
            return (best, state[1]) if at == 0 else (state[0], best), None
        if not symbol.endswith("end"):
            return state, None
        ends = [(*p, f"{p[0]}_target") if symbol == "targeted end" else p for p in state if p]
        return self.start, max(ends, key=weight, default=None)


class Grammar:
    """The composed transducers over a lexicon."""

    def __init__(self, insults: list[str]):
        self.symbols: dict = {w: "target" for w in TARGETS} | {w: "negation" for w in NEGATIONS} | {w: "report" for w in REPORTS}
        self.symbols |= {w: "intensifier" for w in INTENSIFIERS} | {w: "intent" for w in INTENTS}
        self.symbols |= {w: ("threat",) for w in THREATS} | {w: ("insult",) for w in insults}
        self.triggers = frozenset(THREATS) | frozenset(insults)
        insult, threat = Near("intensifier", "intense", ("insult",)), Near("intent", "intent", ("threat",))
        self.machine = insult >> threat >> Near("negation", "denied", ("insult", "threat")) >> Reported() >> Target() >> Clause()

    def paths(self, text: str) -> list[tuple[str, ...]]:
        """The path of each clause that matches, as the arcs it takes."""
        found = []
        for clause in _END.split(text.lower().replace("’", "'")):
            words = _WORD.findall(clause)
            if self.triggers.isdisjoint(words):
                continue
            state = self.machine.start
            for w in words:
                state, _ = self.machine.step(state, self.symbols.get(w, "other"))
            found.append(self.machine.step(state, "end")[1])
        return found


def match_clauses(docs: DataFrame, insults: list[str], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, for each arc the number of clauses that take it) of every document."""
    df = docs.select(F.col(id_col), *keep, F.col(text_col).alias("_text"))
    others, names = [id_col, *keep], list(ARCS)
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in others) + "".join(f", `{t}` int" for t in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(insults)
        for batch in batches:
            found = [Counter(a for path in grammar.paths(t.as_py() or "") for a in path) for t in batch.column("_text")]
            counts = [pa.array([f[a] for f in found], pa.int32()) for a in names]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], *counts], [*others, *names])

    return df.mapInArrow(run, schema)


def learn_insults(sample: DataFrame) -> list[str]:
    """Words of a labelled sample (text, toxic) that mark toxic texts wherever they stand.

    Words that come with the same neighbours each time belong to copied text and are
    left out.
    """
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}']+"), lambda w: w != "")
    near = F.zip_with("w", F.concat(F.array(F.lit("")), F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0)))), lambda w, p: F.struct(w.alias("word"), p.alias("before")))
    df = sample.select("toxic", F.xxhash64("text").alias("d"), words.alias("w")).select("toxic", "d", F.explode(near).alias("x")).select("toxic", "d", "x.*")
    counted = df.groupBy("word").agg(
        F.count_distinct(F.when(F.col("toxic") == 1, F.col("d"))).alias("bad"),
        F.count_distinct("d").alias("all"),
        F.count_distinct("before").alias("variety"),
        F.count(F.lit(1)).alias("n"),
    )
    good = counted.where((F.col("bad") >= LEARNED_DOCS) & (F.col("bad") >= LEARNED_SHARE * F.col("all")) & (F.col("variety") >= LEARNED_VARIETY * F.least("n", F.lit(40))))
    return [r.word for r in good.orderBy(F.desc("bad"), "word").limit(LEARNED_WORDS).collect()]


def fit(counts: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> tuple[float, list[float]]:
    """Bias and arc weights by Newton steps on the penalised logistic likelihood; weights keep their priors' signs."""
    x = np.column_stack([np.ones(len(counts)), np.log1p(counts)])
    prior = np.array([BIAS, *ARCS.values()])
    sign = np.array([0.0, *np.sign(list(ARCS.values()))])
    w = prior.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (rows * (p - labels)) + PULL * (w - prior)
        curvature = (x * (rows * p * (1 - p))[:, None]).T @ x + PULL * np.eye(len(w))
        free = (w * sign != 0) | (gradient * sign < 0) | (sign == 0)  # at 0 a weight moves only to its own side
        step = np.zeros(len(w))
        step[free] = np.linalg.solve(curvature[np.ix_(free, free)], gradient[free])
        new = w - np.clip(step, -2, 2)
        new = np.where(new * sign < 0, 0.0, new)
        moved, w = np.abs(new - w).max(), new
        if moved < 1e-6:
            break
    return float(w[0]), [float(v) for v in w[1:]]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> dict:
    """Insults, bias and weights from at most ``sample_rows`` labelled rows."""
    drawn = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    drawn = drawn.orderBy(F.xxhash64("id"), "id", "toxic").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(drawn), "id")  # at most sample_rows rows of an id and a label
    learned = learn_insults(sample)
    insults = list(dict.fromkeys(INSULTS + learned))
    matched = match_clauses(sample, insults, "id", "text", ("toxic",)).groupBy("toxic", *ARCS).agg(F.count(F.lit(1)).alias("rows")).collect()
    if not matched:
        return {"insults": insults, "bias": BIAS, "weights": list(ARCS.values())}
    counts = np.array([[r[t] for t in ARCS] for r in matched], float)
    bias, weights = fit(counts, np.array([r.toxic for r in matched], float), np.array([r.rows for r in matched], float))
    return {"insults": insults, "bias": bias, "weights": weights}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, clauses by arc)."""
    matched = match_clauses(docs, model["insults"], id_col, text_col)
    z = F.lit(model["bias"])
    for arc, w in zip(ARCS, model["weights"], strict=True):
        z = z + F.log1p(arc) * w
    scored = matched.withColumn("score", 1 / (1 + F.exp(-z)))
    return scored.select(id_col, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *ARCS)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = lambda: F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    model = train(docs, labels.where(~out()))
    return score(docs, model).select("doc_id", out().alias("held_out"), "score", "predicted")


QUERIES = {"op6_toxicity": op6_toxicity}
SQL: dict[str, str] = {}
