import hashlib
import random
import re

from pyspark.sql import types as T

from lamella.llm import secrets

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("base", T.StringType())])
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


FLAT = [[0.0] * len(secrets.ALPHABET) ** 2] * 2


def brute(text):
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ["assign", "access", "hex"]
    return sorted(out, key=lambda x: (x[1], order.index(x[0])))


def cases():
    rnd = random.Random(8)
    hexes = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    parts = ["token", "Token: ", "secret=", "API_KEY = '", "apikey:", "passwd", "\"", " ", "\n", "=", "é\U0001f600", "AKIA", "AKIAAKIAAKIAAKIA9Z", hexes(31), hexes(32), "abcdefgh", "short", "ſecret: abcdefghij", "deadbeef" * 5]
    out = [None, "", "token: secret: longvalue1", "token=secret=abcdefghij", "x token=short token=short token=longenough1"]
    return out + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 25))) for _ in range(250)]


def test_base_spans_match_brute_force(spark):
    rows = [(i, t, "b") for i, t in enumerate(cases())] + [(1, "", "b"), (None, "token=abcdefgh", None)]
    got = secrets.find_secrets(spark.createDataFrame(rows, SCHEMA), FLAT).collect()
    assert sorted((str(r.doc_id), [(x.kind, x.s, x.e) for x in r.base]) for r in got) == sorted((str(i), brute(t)) for i, t, _ in rows)
    assert all(not r.added for r in got)


def test_models_find_random_strings_only(spark):
    rnd = random.Random(9)
    rand = lambda n: "".join(rnd.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(n))
    words = "configuration_manager internationalization data_processing_pipeline administrator_privileges".split()
    rows = [(i, f"the {rnd.choice(words)} uses {rnd.choice(words)} token = {rand(24)} {hashlib.sha1(bytes([i])).hexdigest()} end", "") for i in range(200)]
    rows += [(900, f"value {(key := rand(40))} here", ""), (901, "international_data_processing_pipeline_2024 here", ""), (902, None, "")]
    got = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [(x.s, x.e, x.v) for x in got[900].added] == [(6, 46, key)]
    assert not got[901].added and not got[902].added
    assert sum(len(r.added) for r in got.values()) == 1


def test_tokens_of_letters_or_digits_only_are_scored(spark):
    rnd = random.Random(10)
    rand = lambda n, of="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789": "".join(rnd.choice(of) for _ in range(n))
    words = "configuration_manager internationalization data_processing_pipeline_2024 administrator_privileges".split()
    words += [f"{c}lphabetical" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"] + [f"{c}ATALOGUE" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    rows = [(i, f"the {' '.join(rnd.choices(words, k=200))} token = {rand(24)} end", "") for i in range(400)]
    letters, digits = rand(40, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), rand(30, "0123456789")
    rows += [(900, f"value {letters} and {letters} here", ""), (901, f"value {digits} here", ""), (902, "international_data_processing_pipeline_2024 here", "")]
    got = {r.doc_id: [x.v for x in r.added] for r in secrets.find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[900] == [letters, letters] and got[901] == [digits] and got[902] == []
    assert sum(map(len, got.values())) == 3


def test_runs_no_python(spark):
    df = spark.createDataFrame([(1, "x", "")], SCHEMA)
    plan = secrets.find_secrets(df, FLAT)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert secrets.find_secrets(df.limit(0)).collect() == []


def brute_added(text, base, ratios):
    """Tokens that touch no base span and that a chain finds random, one by one."""
    k, out = len(secrets.ALPHABET), []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text or ""):
        if any(s < m.end() and m.start() < e for _, s, e in base):
            continue
        at = [secrets.ALPHABET.index(c) for c in m[0]]
        if max(sum(round(chain[a * k + b], 6) for a, b in zip(at, at[1:])) for chain in ratios) / (len(at) - 1) >= secrets.THRESHOLD:
            out.append((m.start(), m.end()))
    return out


def test_added_spans_match_brute_force_on_long_texts(spark):
    rnd = random.Random(11)
    rand = lambda n, of: "".join(rnd.choice(of) for _ in range(n))
    mixed, hexes, small = "ABCXYZabcxyz0123456789+/_-=", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
    parts = [lambda: rand(rnd.randrange(18, 60), mixed), lambda: rand(40, hexes), lambda: rand(25, small), lambda: "é漢 word", lambda: f"token={rand(12, mixed)}", lambda: "AKIA" + rand(14, "ABC123")]
    texts = [" ".join(rnd.choice(parts)() for _ in range(n)) for n in (0, 1, 3, 40, 700, 6000)] + [rand(50_000, mixed), None]
    ratios = [[rnd.uniform(-1, 1.6) for _ in range(len(secrets.ALPHABET) ** 2)] for _ in range(2)]
    got = secrets.find_secrets(spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], SCHEMA), ratios).collect()
    for r in got:
        base = brute(texts[r.doc_id])
        assert [(x.kind, x.s, x.e) for x in r.base] == base
        assert [(x.s, x.e) for x in r.added] == brute_added(texts[r.doc_id], base, ratios)
    assert len(got) == len(texts) and sum(len(r.added) for r in got) > 100


#: English words that texts are made of, and others that identifiers are made of.
WORDS = """government information development university international community education president
experience management department production particular individual technology political association
relationship environment performance environmental professional administration organization responsibility
understanding communication investigation available financial difficult important together different
everything themselves including American something national business military position director building
response activity analysis approach material movement behavior audience property security statement strategy
population opportunity traditional conference television attention beautiful commercial""".split()
OTHER = """user account settings update handler request parser value config cache index query result buffer
stream client server session manager factory builder list page order payment invoice customer profile
image file path name count size total date time event queue worker thread table column filter report""".split()


def identifiers(rnd):
    while True:
        words = [rnd.choice(OTHER) for _ in range(4)]
        yield "snake", "_".join(words)
        yield "snake with digits", "_".join(words) + f"_{rnd.randrange(100)}"
        yield "constant", "_".join(words).upper()
        yield "camel", words[0] + "".join(w.capitalize() for w in words[1:])
        yield "pascal", "".join(w.capitalize() for w in words)
        yield "path", "/" + "/".join(words)
        yield "slug", "-".join(words)


def random_strings(rnd):
    draw = lambda n, of: "".join(rnd.choice(of) for _ in range(n))
    hexes, base62 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    while True:
        for n in (16, 20, 24, 32, 40):
            yield f"base62 of {n}", draw(n, base62)
        yield "base64url", draw(32, base62 + "-_")
        yield "capitals and digits", draw(20, base62[:26] + base62[52:])
        yield "hex of 16", draw(16, hexes)
        yield "hex of 24", draw(24, hexes)
        yield "uuid", "-".join(draw(n, hexes) for n in (8, 4, 4, 4, 12))


def test_identifiers_and_random_strings_are_told_apart(spark):
    """False rate and recall of every kind, from 16 characters on, with words that training didn't see."""
    rnd = random.Random(12)
    texts = [(i, " ".join(rnd.choices(WORDS, k=60)) + f" token = {''.join(rnd.choices('abcdefghijkmnopqrstuvwxyzABCDEFGHJKL23456789', k=24))}", "") for i in range(100)]
    ratios = secrets.train(spark.createDataFrame(texts, SCHEMA))
    share = {}
    for source in (identifiers, random_strings):
        tokens = [t for _, t in zip(range(2000), source(rnd), strict=False) if len(t[1]) >= 16]
        rows = [(i, f"see {t} there", "") for i, (_, t) in enumerate(tokens)]
        found = {r.doc_id: len(r.added) + len(r.base) for r in secrets.find_secrets(spark.createDataFrame(rows, SCHEMA), ratios).collect()}
        for kind in {k for k, _ in tokens}:
            hits = [found[i] for i, (k, _) in enumerate(tokens) if k == kind]
            share[source.__name__, kind] = sum(h > 0 for h in hits) / len(hits)
    assert len(share) == 17
    assert all(v < 0.05 for (source, _), v in share.items() if source == "identifiers"), share
    assert all(v > 0.9 for (source, _), v in share.items() if source == "random_strings"), share
