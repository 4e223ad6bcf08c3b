import random
import re

from pyspark.sql import types as T

from lamella.llm import quality_rules as q

SEP = r"[\x20\x09-\x0D]+"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType())])


def brute(text):
    text = text or ""
    words = [w for w in re.split(SEP, text) if w]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(spark):
    rnd = random.Random(3)
    words = ["a", "be", "éç", "the", "x|y", "#", "漢字", "\U0001f600"]
    texts = [None, "", " ", "\n\n", "one", "a b c d e f g h " * 5, "Nd " * 4000]
    texts += ["".join(rnd.choice(words) + rnd.choice(" \t\n\x0b ") for _ in range(rnd.randrange(1, 90))) for _ in range(150)]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(3, "\n\n", 7), (None, "x y", 7)]
    got = q.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), *brute(t)) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed) for r in got)


def test_filter_keeps_columns_and_clean_rows(spark):
    clean = "The cat of the house is on the mat and it was warm there for most of the long day by the fire."
    df = spark.createDataFrame([(1, clean, 1), (1, clean, 1), (2, clean.upper(), 2), (3, None, 3)], SCHEMA)
    got = q.filter_documents(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 1]
    assert q.filter_documents(df.limit(0)).collect() == []


def test_no_shuffle_and_no_python(spark):
    plan = q.judge(spark.createDataFrame([(1, "x", 1)], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_filter_holds_each_step_once(spark):
    df = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    plan = q.filter_documents(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with") < 20
