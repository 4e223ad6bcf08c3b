import random
import re

from pyspark.sql import types as T

from lamella.llm import decontaminate as d

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("item", T.StringType()), T.StructField("h", T.IntegerType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("need", T.StringType())])


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items):
    out = []
    for i, text, *_ in docs:
        dw = words(text)
        for j, item, _ in items:
            iw = words(item)
            k = min(5, len(iw))
            if not k:
                continue
            wanted = {tuple(iw[a : a + k]) for a in range(len(iw) - k + 1)}
            found = wanted & {tuple(dw[a : a + k]) for a in range(len(dw) - k + 1)}
            if len(found) / len(wanted) >= 0.8:
                out.append((str(i), str(j), len(wanted), len(found)))
    return sorted(out)


def tables():
    rnd = random.Random(6)
    vocab = [f"w{i}" for i in range(400)]
    some = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(some(n)), "x") for i, n in enumerate([1, 2, 3, 4, 5, 6, 12, 40, 40, 70, 150, 900])] + [(50, None, ""), (51, "", ""), (52, "!!", ""), (7, None, "")]
    docs = []
    for k in range(60):
        body = some(rnd.choice([0, 3, 50, 600]))
        item = rnd.choice(items[:12])[1].split()
        if rnd.random() < 0.5:
            item[rnd.randrange(len(item))] = "changed"
        at = rnd.randrange(len(body) + 1)
        mark = rnd.choice([" ", "%%% ", "\n", ", "])
        docs.append((k, mark.join(body[:at] + item + body[at:]).title(), "c", 1))
    return docs + [docs[0], (None, docs[1][1], "c", 1), (70, None, None, None), (71, "", "", 0)], items


def test_matches_brute_force(spark):
    docs, items = tables()
    df, tests = spark.createDataFrame(docs, DOCS).repartition(3, "doc_id"), spark.createDataFrame(items, ITEMS)
    got = d.find_items(df, tests).collect()
    want = brute(docs, items)
    assert sorted((str(r.doc_id), str(r.item_id), r.n_shingles, r.n_found) for r in got) == want
    kept = d.remove_contaminated(df, tests)
    assert kept.columns == df.columns
    bad = {i for i, *_ in want}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in docs if str(r[0]) not in bad)
    clash = df.withColumnRenamed(df.columns[-1], "_row").withColumnRenamed(df.columns[-2], "_words")
    kept = d.remove_contaminated(clash, tests)
    assert kept.columns == clash.columns and kept.where("_row is not null").count() > 0


def test_empty_tables_and_no_python(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f", "", 0)], DOCS), spark.createDataFrame([], ITEMS)
    assert d.find_items(docs, items).collect() == []
    assert d.remove_contaminated(docs, items).count() == 1
    some = spark.createDataFrame([(1, "a b c d e f", "")], ITEMS)
    assert d.find_items(docs.limit(0), some).collect() == []
    plan = d.find_items(docs, some)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
