import random

from pyspark.sql import types as T

from lamella.llm import substring_dedup as d

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("uid", T.StringType())])


def brute(rows):
    units = [(r, p, s, e, n) for r, (_, t, _) in enumerate(rows) for p, (s, e, n) in enumerate(d.paragraphs(t or ""))]
    sets = [d.shingles(u[4]) for u in units]
    top = list(range(len(units)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(units)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    held, first = {}, {}
    for k, u in enumerate(units):
        held.setdefault(find(k), set()).add(u[0])
        first[find(k)] = min(u[:2], first.get(find(k), u[:2]))
    hits = {u[:2]: (u, first[find(k)]) for k, u in enumerate(units) if len(held[find(k)]) > 1}
    out = []
    for (r, p), (u, stays) in hits.items():
        lo = hi = p
        while (r, lo - 1) in hits:
            lo -= 1
        while (r, hi + 1) in hits:
            hi += 1
        n = sum(hits[r, q][0][4].count(" ") + 1 for q in range(lo, hi + 1))
        if n >= d.LEAST_WORDS:
            out.append((str(rows[r][0]), p, u[2], u[3], n, stays != (r, p)))
    return sorted(out)


def test_matches_all_pairs(spark):
    rnd = random.Random(21)
    vocab = [f"w{k}" for k in range(300)]

    def passage(n):
        return " ".join(rnd.choice(vocab) + rnd.choice(["", "", "", "", "", "", ".", "!"]) for _ in range(n))

    shared = [passage(80) + "." for _ in range(5)]
    rows = []
    for i in range(60):
        words = rnd.choice(shared).split()
        if i % 3 == 0:
            words[rnd.randrange(len(words))] = "changed"
        middle = " ".join(words) if i % 4 else ""
        rows.append((i, "A common line.\n" + passage(rnd.randrange(40)) + rnd.choice([". ", "\n", " "]) + middle + " " + passage(rnd.randrange(60)), "u"))
    rows += [(70, None, "u"), (None, shared[0], None), (71, "", "u"), (72, (passage(40) + ". ") * 3, "u"), (73, "x " * 5000, "u"), (5, rows[5][1], "u")]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    got = sorted((str(r.doc_id), r.paragraph, r.start, r.end, r.run_words, r.removed) for r in d.repeated_passages(df).collect())
    want = brute(rows)
    assert {g[0] for g in got} == {w[0] for w in want}
    assert len(set(want) ^ set(got)) <= 0.05 * len(want)  # banding may miss pairs near the threshold
    assert d.repeated_passages(df.limit(0)).collect() == []
    assert "72" not in {g[0] for g in got}
