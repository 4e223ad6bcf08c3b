import random
import re

import numpy as np
from pyspark.sql import types as T

from lamella.llm import toxicity as x

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])
DATA = "/root/testdata/sf0.1"


def test_grammar_reads_clauses():
    g = x.Grammar(x.INSULTS)
    assert g.paths("You are an idiot. A fine day, you see.") == [("insult", "insult_target")]
    assert g.paths("What a pathetic show; the end") == [("insult",)]
    assert g.paths("I will kill you! Do not kill them") == [("threat", "intent", "threat_target"), ("threat", "denied", "threat_target")]
    assert g.paths("He said the plan was stupid and pathetic") == [("insult", "reported", "insult_target")]
    assert g.paths("they kill time. no. stupid") == [("threat", "threat_target"), ("insult",)]
    assert g.paths("it is not at all a very stupid idea") == [("insult", "intense")]
    assert g.paths("") == g.paths("the clownfish") == []


def test_context_moves_the_score(spark):
    """With the priors: whom it aims at, intent and force raise a score, denial and report lower it."""
    texts = ["kill it", "kill you", "i will kill you", "i will not kill you", "stupid", "stupid they", "so stupid they", "they said stupid", "they aren't stupid", "fine"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {texts[r.doc_id]: r.score for r in x.score(df, x.train(df, spark.createDataFrame([], "doc_id long, toxic int"))).collect()}
    assert got["kill it"] < got["kill you"] < got["i will kill you"] > got["i will not kill you"]
    assert got["stupid"] < got["stupid they"] < got["so stupid they"] and got["stupid they"] > max(got["they said stupid"], got["they aren't stupid"])
    assert got["fine"] < got["kill it"] < 0.5 < got["i will kill you"]


def test_fit_finds_the_minimum_within_signs():
    rnd = np.random.default_rng(5)
    counts = rnd.integers(0, 3, (400, len(x.ARCS))).astype(float)
    labels = (rnd.random(400) < 0.3).astype(float)
    bias, weights = x.fit(counts, labels, np.ones(400))
    design, prior = np.column_stack([np.ones(400), np.log1p(counts)]), np.array([x.BIAS, *x.ARCS.values()])

    def loss(w):
        z = design @ w
        return np.sum(np.logaddexp(0, z) - labels * z) + x.PULL / 2 * np.sum((w - prior) ** 2)

    sign = np.sign(prior)
    w = np.array([bias, *weights])
    assert (w[1:] * sign[1:] >= 0).all() and (w[1:] == 0).any()
    for k in range(len(w)):
        for d in (-1e-3, 1e-3):
            near = w.copy()
            near[k] += d
            assert (k > 0 and near[k] * sign[k] < 0) or loss(near) >= loss(w) - 1e-9


def test_composition_matches_running_each_in_turn():
    rnd = random.Random(1)
    parts = [x.Near("intensifier", "intense", ("insult",)), x.Near("intent", "intent", ("threat",)), x.Near("negation", "denied", ("insult", "threat")), x.Reported(), x.Target(), x.Clause()]
    machine = parts[0] >> parts[1] >> parts[2] >> parts[3] >> parts[4] >> parts[5]
    symbols = [rnd.choice(["other", ("insult",), ("threat",), "target", "negation", "report", "intensifier", "intent", "end"]) for _ in range(4000)]
    state, states = machine.start, [p.start for p in parts]
    for s in symbols:
        state, out = machine.step(state, s)
        for k, p in enumerate(parts):
            states[k], s = p.step(states[k], s)
        assert s == out


def test_held_out_accuracy(spark):
    rows = x.op6_toxicity(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").where("held_out").collect()
    found = [r.predicted for r in rows if r.toxic == 1]
    wrong = [r.predicted for r in rows if r.toxic == 0]
    assert sum(found) >= 0.8 * len(found) and sum(wrong) <= 0.01 * len(wrong)


def test_edges(spark):
    rows = [(1, None, "s"), (1, None, "s"), (2, "", "s"), (None, "you idiot", "s"), (3, "x " * 50_000 + "you stupid clown", "s")]
    df = spark.createDataFrame(rows, SCHEMA)
    model = x.train(df, spark.createDataFrame([], "doc_id long, toxic int"))
    got = x.score(df, model).collect()
    assert sorted((str(r.doc_id), r.predicted) for r in got) == [("1", 0), ("1", 0), ("2", 0), ("3", 1), ("None", 1)]
    assert x.score(df.limit(0), model).collect() == []


def brute_paths(text):
    """Arcs of each matching clause, worked out without transducers."""
    found = []
    for clause in re.split(r"[.!?;:\n]+", text.lower()):
        words = re.findall(r"[^\W_]+(?:'[^\W_]+)?", clause)
        ways = []
        for i, w in enumerate(words):
            if w in x.INSULTS or w in x.THREATS:
                kind, near = "insult" if w in x.INSULTS else "threat", words[max(0, i - 3) : i]
                way = [kind]
                way += ["intense"] * (kind == "insult" and any(v in x.INTENSIFIERS for v in near))
                way += ["intent"] * (kind == "threat" and any(v in x.INTENTS for v in near))
                way += ["denied"] * any(v in x.NEGATIONS for v in near)
                way += ["reported"] * any(v in x.REPORTS for v in words[:i])
                way += [f"{kind}_target"] * any(v in x.TARGETS for v in words)
                ways.append(tuple(way))
        if ways:
            found.append(max(ways, key=lambda p: round(sum(x.ARCS[a] for a in p), 9)))
    return found


def test_clauses_match_brute_force():
    rnd = random.Random(17)
    vocab = [*x.INSULTS[:3], *x.THREATS[:2], "you", "them", "not", "never", "said", "wrote", "will", "deserve", "such", "so", "fine", "day", "sky", ".", "!", "\n", ";"]
    grammar = x.Grammar(x.INSULTS)
    seen = set()
    for _ in range(4000):
        text = " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(0, 14)))
        want = brute_paths(text)
        got = grammar.paths(text)
        assert [round(x.weight(p), 9) for p in got] == [round(x.weight(p), 9) for p in want], text
        seen |= {a for p in got for a in p}
    assert seen == set(x.ARCS)
