"""Secret scans: patterns, and character Markov models for random strings.

Base spans come from three patterns. Further spans are tokens whose characters
follow a model of random strings rather than one of ordinary identifiers:
first-order Markov chains over the token alphabet, compared by log-likelihood
ratio. The chains are trained from labelled samples that the corpus gives itself:
the values of base spans are random strings, with one chain for hexadecimal ones
and one for all others, and all other words of letters and joiners, with digits that
end them, are ordinary. Texts hold few identifiers, so the words also count as parts of
identifiers in each way of joining them (``_identifiers``); random strings also count as
drawn evenly, hexadecimal ones with hyphens in them (``_drawn``). Every token of the stated
length is scored, whatever characters it holds. Counts cover all documents; they are one row
per pair of characters, so the trained table has at most ``len(ALPHABET) + 2`` squared
entries whatever the corpus holds, and is put into the plan as literals.

Everything is built-in column expressions, and their work follows the length of the
text: a text is split at the matches of a pattern, and the places of the matches are
running sums of the lengths of what lies between. Running sums and maxima are taken in
blocks, as each step of a fold over an array copies what it has gathered.

Defined results: a null text counts as empty; an empty text has no spans and the
digest of the empty string; repeated rows each get a row; other columns are ignored.
Without words in the corpus all characters are alike in the ordinary chain, and without
base spans the random ones are drawn evenly.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.llm.common import table

#: The base patterns of the contract, with the least length of what is measured.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: Fixed value: characters that tokens are made of.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

#: Elements of an array that are folded at once.
BLOCK = 256
#: Tokens that are scored: this many characters of the alphabet at least.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
#: Mean log-likelihood ratio per character pair, in nats, from which a token is a secret.
THRESHOLD = 0.3
#: Added to each character's count, so that unseen ones have a finite probability.
PRIOR = 1.0
#: Weight, in counts, of a character's own frequency where a pair has been seen rarely or never.
BACK_OFF = 20.0
#: Counts of each pair of characters that are drawn evenly.
EVEN = 20.0
#: Nats a pair that the ratios are lowered by, for words that training didn't see: of random strings of
#: 16 characters 95 % score 2.3 and more before it, of identifiers in camel case, the nearest, 95 % up to 1.3.
MARGIN = 1.5
#: Hyphens for each character of a hexadecimal string, as in identifiers of 8-4-4-4-12 characters.
HYPHENS = 4 / 32
#: Words that a capital letter begins, and words in capitals, for each word after an underscore.
CAMEL, CAPITALS = 3.0, 0.3
#: Digits for each end of a word in an identifier.
DIGITS = 0.1


def _running(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step`` has gathered before each element of an array, in blocks of ``BLOCK``."""

    def fold(array: Column) -> Column:
        start = F.struct(zero.alias("now"), F.array_repeat(zero, 0).alias("seen"))
        return F.aggregate(array, start, lambda acc, x: F.struct(step(acc["now"], x).alias("now"), F.concat(acc["seen"], F.array(acc["now"])).alias("seen")))

    firsts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(BLOCK))
    blocks = F.transform(firsts, lambda at: fold(F.slice(values, at, F.lit(BLOCK))))
    return F.flatten(F.zip_with(blocks, fold(F.transform(blocks, lambda b: b["now"]))["seen"], lambda b, offset: F.transform(b["seen"], lambda x: step(offset, x))))


def _located(df: DataFrame, column: str, pattern: str, kind: str) -> DataFrame:
    """Add ``column``: (kind, s, e, v) of each match of a pattern in ``_text``, in code points, ends exclusive."""
    df = df.withColumn("_found", _of(pattern))
    gaps = F.transform(F.split("_text", pattern), F.length)
    # The last gap has no match.
    df = df.withColumn("_steps", F.zip_with(gaps, "_found", lambda g, v: F.struct(g.alias("gap"), F.length(v).alias("n"), v.alias("v"))))
    df = df.withColumn("_steps", F.when(F.size("_found") > 0, F.slice("_steps", F.lit(1), F.size("_found"))).otherwise(F.slice("_steps", F.lit(1), F.lit(0))))
    df = df.withColumn("_before", _running(F.transform("_steps", lambda x: x["gap"] + x["n"]), F.lit(0), lambda a, x: a + x))
    span = lambda at, x: F.struct(F.lit(kind).alias("kind"), (at + x["gap"]).alias("s"), (at + x["gap"] + x["n"]).alias("e"), x["v"].alias("v"))
    return df.withColumn(column, F.zip_with("_before", "_steps", span)).drop("_found", "_steps", "_before")


def _of(pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(F.col("_text"), F.lit(pattern), F.lit(group))


def base_spans(df: DataFrame) -> DataFrame:
    """Add ``_assign``, ``_access`` and ``_hex``, arrays of (kind, s, e, v), to rows with ``_text``."""
    # Runs that fail their length hold no shorter match, so the length can stand in the pattern;
    # not so for assignments, where a failing match uses up the text of a later keyword.
    for kind, pattern in (("access", r"AKIA[A-Z0-9]{12,}"), ("hex", r"[0-9a-f]{32,}"), ("assign", ASSIGN)):
        df = _located(df, f"_{kind}", pattern, kind)
    df = df.withColumn("_values", _of(ASSIGN, 2))
    with_value = F.zip_with("_assign", "_values", lambda a, v: F.struct(a["kind"].alias("kind"), a["s"].alias("s"), a["e"].alias("e"), v.alias("v")))
    df = df.withColumn("_assign", F.filter(with_value, lambda x: F.length(x["v"]) >= LEAST["assign"]))
    return df.drop("_values")


def _tail(array: Column) -> Column:
    return F.slice(array, F.lit(2), F.greatest(F.size(array) - 1, F.lit(0)))


def _pairs(token: Column) -> Column:
    characters = F.split(token, "")
    return F.zip_with(characters, _tail(characters), lambda a, b: F.concat(a, b))


KINDS = ("hex", "mixed", "ordinary")
_DIGITS, _LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
Counts = dict[str, float]


def _identifiers(parts: Counts) -> Counts:
    """Pair counts of identifiers made of words whose pairs, with ``^`` before and ``$`` after a word, are given.

    Words are joined by an underscore, by a hyphen, by a slash, or by a capital letter, which
    comes in three times as often as each joiner; fewer stand in capitals throughout, as each
    of these has many capitals after capitals. Now and then digits end a word.
    """
    out: dict[str, float] = defaultdict(float)
    first = {a: parts.get("^" + a, 0.0) for a in _LETTERS}
    last = {a: parts.get(a + "$", 0.0) for a in _LETTERS}
    follows = {a: sum(parts.get(a + b, 0.0) for b in _LETTERS) for a in _LETTERS}
    words = sum(first.values())
    if not words:
        return out
    for a in _LETTERS:
        for b in _LETTERS:
            n = parts.get(a + b, 0.0)
            out[a + b] += 4 * n
            out[(a + b).upper()] += CAPITALS * n
            out[a + b.upper()] += CAMEL * last[a] * first[b] / words
            out[a.upper() + b] += CAMEL * first[a] * n / max(follows[a], 1.0)
        for joiner in "_-/":
            out[a + joiner] += last[a]
            out[joiner + a] += first[a]
        out[a.upper() + "_"] += CAPITALS * last[a]
        out["_" + a.upper()] += CAPITALS * first[a]
        for d in _DIGITS:
            for letter in (a, a.upper()):
                out[letter + d] += last[a] * DIGITS / 10
    for d in _DIGITS:
        for joiner in "_-/":
            out[d + joiner] += words * DIGITS / 10
            out[joiner + d] += words * DIGITS / 10
    return out


def _drawn(kind: str) -> Counts:
    """Pair counts of strings whose characters are drawn evenly."""
    of = _DIGITS + ("abcdef" if kind == "hex" else _LETTERS + _LETTERS.upper())
    out = {a + b: EVEN for a in of for b in of}
    if kind == "hex":
        out |= {pair: EVEN * len(of) * HYPHENS for a in of for pair in (a + "-", "-" + a)}
    return out


def train(docs: DataFrame, text_col: str = "text", prior: float = PRIOR) -> list[list[float]]:
    """Log ratios of the transition probabilities, against ordinary and less ``MARGIN``, for each pair of characters.

    One list for hexadecimal and one for other random strings, in the order of the
    alphabet. One pass over all documents; only pair counts, bounded by the
    alphabet, reach the driver.
    """
    df = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    values = F.flatten(F.array(_of(ASSIGN, 2), _of(r"AKIA[A-Z0-9]{12,}"), _of(r"[0-9a-f]{32,}")))
    rest = F.regexp_replace("_text", f"{ASSIGN}|AKIA[A-Z0-9]{{12,}}|[0-9a-f]{{32,}}", " ")
    ordinary = F.regexp_extract_all(rest, F.lit(r"[A-Za-z_-]{8,}(?:[0-9]+(?![A-Za-z0-9+/=]))?"), F.lit(0))
    kind_of = lambda v: F.when(v.rlike("^[0-9a-f]+$"), "hex").otherwise("mixed")
    label = lambda tokens, kind: F.transform(tokens, lambda t: F.struct(kind(t).alias("kind"), t.alias("t")))
    random = label(F.filter(values, lambda v: F.length(v) >= 8), kind_of)
    tokens = df.select(F.explode_outer(F.concat(random, label(ordinary, lambda _: F.lit("ordinary")))).alias("x")).select("x.*")
    # Equal tokens are counted first: ordinary words recur, and each is then cut into pairs once.
    counted = tokens.groupBy("kind", "t").agg(F.count(F.lit(1)).alias("n"))
    # The words in a token, marked at both ends, beside its own pairs. Random strings that no pattern
    # finds are in the text as well; their capitals lie inside, so they are not taken for words.
    words = F.regexp_extract_all(F.col("t"), F.lit("(?<![A-Za-z])[A-Z]?[a-z]{2,}(?![A-Za-z])"), F.lit(0))
    words = F.transform(words, F.lower)
    parts = F.flatten(F.transform(words, lambda w: _pairs(F.concat(F.lit("^"), w, F.lit("$")))))
    of = lambda kind, cells: F.transform(cells, lambda c: F.struct(kind.alias("kind"), c.alias("pair")))
    cells = F.concat(of(F.col("kind"), _pairs(F.col("t"))), F.when(F.col("kind") == "ordinary", of(F.lit("part"), parts)).otherwise(F.slice(of(F.lit("part"), parts), 1, 0)))
    pairs = counted.select("n", F.explode_outer(cells).alias("c")).where(F.length("c.pair") == 2)
    counts: dict[tuple[str, str], float] = defaultdict(float)
    for r in pairs.groupBy("c.kind", "c.pair").agg(F.sum("n").alias("n")).collect():
        counts[r.kind, r.pair] = r.n
    made = {"ordinary": _identifiers({pair: n for (kind, pair), n in counts.items() if kind == "part"})} | {kind: _drawn(kind) for kind in KINDS[:2]}
    counts = defaultdict(float, {key: n for key, n in counts.items() if key[0] != "part"})
    for kind, more in made.items():
        for pair, n in more.items():
            counts[kind, pair] += n
    follows: dict[tuple[str, str], float] = {}
    seen: dict[tuple[str, str], float] = {}
    for (kind, pair), n in counts.items():
        follows[kind, pair[0]] = follows.get((kind, pair[0]), 0) + n
        seen[kind, pair[1]] = seen.get((kind, pair[1]), 0) + n
    all_seen = {kind: sum(seen.get((kind, c), 0) for c in ALPHABET) for kind in KINDS}

    def log(kind: str, a: str, b: str) -> float:
        alone = (seen.get((kind, b), 0) + prior) / (all_seen[kind] + prior * len(ALPHABET))
        return math.log((counts.get((kind, a + b), 0) + BACK_OFF * alone) / (follows.get((kind, a), 0) + BACK_OFF))

    return [[log(kind, a, b) - log("ordinary", a, b) - MARGIN for a in ALPHABET for b in ALPHABET] for kind in KINDS[:2]]


def _score(token: Column, ratios: list[list[float]]) -> Column:
    """Mean log-likelihood ratio of a token's character pairs, for the random chain that fits better."""
    k = len(ALPHABET)
    codes = F.array(*[F.lit(ALPHABET.find(chr(c))) for c in range(128)])
    places = F.transform(F.split(token, ""), lambda c: F.element_at(codes, F.ascii(c) + 1))
    cells = F.filter(F.zip_with(places, _tail(places), lambda a, b: a * k + b + 1), lambda x: x.isNotNull())

    def total(chain: list[float]) -> Column:
        lookup = F.array(*[F.lit(round(x, 6)) for x in chain])
        return F.aggregate(cells, F.lit(0.0), lambda acc, x: acc + F.element_at(lookup, x))

    return F.greatest(*map(total, ratios)) / (F.length(token) - 1)


def find_secrets(docs: DataFrame, ratios: list[list[float]] | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, base, added): arrays of (kind, s, e, v) for each document.

    ``base`` has the pattern spans, ``added`` those of the models that touch no base span.
    """
    ratios = train(docs, text_col) if ratios is None else ratios
    df = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    df = base_spans(df).withColumn("base", F.array_sort(F.concat("_assign", "_access", "_hex"), _by_start)).drop("_assign", "_access", "_hex")
    df = _located(df, "_tokens", TOKEN, "markov")
    # In the order of base starts and token ends, what base spans reach before a token's end.
    none = F.lit(None).cast("int")
    starts = F.transform("base", lambda b: F.struct(b["s"].alias("at"), F.lit(1).alias("base"), b["e"].alias("e"), none.alias("s"), F.lit("").alias("v")))
    ends = F.transform("_tokens", lambda t: F.struct(t["e"].alias("at"), F.lit(0).alias("base"), t["e"].alias("e"), t["s"].alias("s"), t["v"].alias("v")))
    df = df.withColumn("_order", F.sort_array(F.concat(starts, ends)))
    df = df.withColumn("_reach", _running(F.transform("_order", lambda x: F.when(x["base"] == 1, x["e"]).otherwise(0)), F.lit(0), F.greatest))
    df = df.withColumn("_free", F.zip_with("_order", "_reach", lambda x, r: F.when((x["base"] == 0) & (r <= x["s"]), x)))
    df = df.withColumn("_free", F.filter("_free", lambda x: x.isNotNull()))
    added = F.filter("_free", lambda x: _score(x["v"], ratios) >= threshold)
    span = lambda x: F.struct(F.lit("markov").alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"))
    return df.select(id_col, "base", F.transform(added, span).alias("added"))


def _by_start(a: Column, b: Column) -> Column:
    order = lambda x: x["s"].cast("long") * 4 + F.when(x["kind"] == "assign", 0).when(x["kind"] == "access", 1).when(x["kind"] == "hex", 2).otherwise(3)
    return F.signum(order(a) - order(b)).cast("int")


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = F.array_sort(F.concat("base", "added"), _by_start)
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"), _text_of(spans).alias("spans"))


QUERIES = {"op9_secrets": op9_secrets}
SQL: dict[str, str] = {}
