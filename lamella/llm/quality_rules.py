"""Quality rules: a threshold table compiled into one Spark projection.

Each row of the table names a measured ratio and its allowed range. The measures
are built-in column expressions, so scan, measures and verdict run in one stage
without a shuffle and without user functions.

Defined results: a null text counts as empty; an empty text has zero words and
fails the base rule on length; repeated rows are judged one by one; extra columns
are passed through by ``filter_documents`` and ignored by ``measure``, even where
their names clash with a measure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.llm.common import SPACES, table

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for as was with be by on are this at from or an "
    "der die das und ist nicht ein eine zu den von mit sich auf für dem des als im "
    "le la les de des et un une est que qui dans pour par sur pas au du avec ce "
    "el los las y en del se no por su para lo con una al como más"
).split()

#: As written inside and at the start of a sentence; comparing forms spares lower-casing each word.
_STOP_FORMS = [form for w in dict.fromkeys(STOP_WORDS) for form in (w, w.capitalize())]

#: Fixed value: the symbols of the base contract.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Keep a document only while ``low <= measure <= high``; None leaves a side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The threshold table.
RULES = (
    Rule("length", "n_words", low=20),
    Rule("repetition", "repeat_ratio", high=0.30),
    Rule("symbols", "symbol_ratio", high=0.20),
    Rule("word_length", "mean_word_chars", low=1.5, high=14.0),
    Rule("stop_words", "stop_ratio", low=0.002),
    Rule("shouting", "upper_ratio", high=0.60),
    Rule("exclaiming", "exclaim_ratio", high=0.40),
    Rule("repeated_lines", "dup_line_ratio", high=0.60),
)

#: Words in a window of the base repetition measure.
WINDOW = 8


def _windows(words: Column) -> list[tuple[str, Column]]:
    """Steps that hash every 8-word window: pairs, then fours, then eights.

    Each step combines an array with itself moved along, so that the cost is linear
    in the words and no lambda reads an array from outside.
    """
    joined = lambda step, arr: F.zip_with(
        arr,
        F.slice(arr, F.lit(step + 1), F.greatest(F.size(arr) - step, F.lit(0))),
        lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)),
    )
    return [
        ("_h1", F.transform(words, lambda w: F.xxhash64(w))),
        ("_h2", joined(1, F.col("_h1"))),
        ("_h4", joined(2, F.col("_h2"))),
        ("_h8", joined(4, F.col("_h4"))),
    ]


def _covered(width: int) -> list[tuple[str, Column]]:
    """Steps from window hashes to the number of words that repeated windows cover."""
    tail = lambda arr: F.slice(arr, F.lit(2), F.greatest(F.size(arr) - 1, F.lit(0)))
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    s, r = F.col("_sorted"), F.col("_places")
    return [
        ("_sorted", F.sort_array(F.filter(F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))), lambda x: x["h"].isNotNull()))),
        # A window counts if its hash equals that of the one before or after it in hash order.
        ("_after", F.zip_with(s, tail(s), lambda a, b: same(a, b))),
        ("_before", F.concat(F.array(F.lit(False)), F.col("_after"))),
        ("_marked", F.zip_with(s, F.zip_with("_after", "_before", lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False))), lambda x, hit: F.when(hit, x["i"]))),
        ("_places", F.sort_array(F.filter("_marked", lambda i: i.isNotNull()))),
        ("n_repeat_words", F.aggregate(F.zip_with(r, tail(r), lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width))), F.lit(0).cast("long"), lambda acc, x: acc + x)),
    ]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """All measures of the table for each document; ``keep`` names further columns to carry."""
    df = docs.select(F.col(id_col), *keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    text, words = F.col("_text"), F.col("_words")
    df = df.withColumn("_words", F.filter(F.split(text, SPACES), lambda w: w != ""))
    for name, column in [*_windows(words), *_covered(WINDOW)]:
        df = df.withColumn(name, column)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    without = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    df = df.select(
        id_col,
        *keep,
        F.size(words).cast("long").alias("n_words"),
        without(SPACES).cast("long").alias("word_chars"),
        (F.length(text) - without(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        "n_repeat_words",
        F.transform(lines, lambda line: F.xxhash64(line)).alias("_lines"),
        F.size(F.filter(words, lambda w: w.isin(_STOP_FORMS))).alias("_stops"),
        (F.length(text) - without(r"\p{Lu}")).alias("_upper"),
        (F.length(text) - without("!")).alias("_exclaims"),
    )
    n = F.greatest(F.col("n_words"), F.lit(1))
    return df.select(
        id_col,
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        (F.col("n_repeat_words") / n).alias("repeat_ratio"),
        (F.col("n_symbols") / n).alias("symbol_ratio"),
        (F.col("word_chars") / n).alias("mean_word_chars"),
        (F.col("_stops") / n).alias("stop_ratio"),
        (F.col("_upper") / F.greatest(F.col("word_chars"), F.lit(1))).alias("upper_ratio"),
        (F.col("_exclaims") / n).alias("exclaim_ratio"),
        ((F.size("_lines") - F.size(F.array_distinct("_lines"))) / F.greatest(F.size("_lines"), F.lit(1))).alias("dup_line_ratio"),
    )


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one boolean expression over the measures."""
    verdict = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            verdict = verdict & (F.col(rule.measure) >= F.lit(rule.low))
        if rule.high is not None:
            verdict = verdict & (F.col(rule.measure) <= F.lit(rule.high))
    return verdict


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Measures, the base verdict, and ``kept``: false for base failures, else the table's verdict."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measure(docs, id_col, text_col, keep).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def filter_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns and no shuffle."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    judged = judge(docs.select(whole, F.col(text_col).alias("_input")), rules, "_whole", "_input")
    # A filter on a number that isn't deterministic can't be pushed below it, and so stays above the
    # measures: pushed below, it would hold a copy of every step inside every later one.
    return judged.withColumn("_judged", F.monotonically_increasing_id()).where("kept and _judged >= 0").select("_whole.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *cols)


def _sql() -> str:
    stops = ", ".join(f"'{w}'" for w in _STOP_FORMS)
    strip = "regexp_replace({}, '[\\x20\\x09-\\x0D]+', '', 'g')"
    tests = " and ".join([f"{r.measure} >= cast({r.low} as double)" for r in RULES if r.low is not None] + [f"{r.measure} <= cast({r.high} as double)" for r in RULES if r.high is not None])
    return rf"""
with base as (
  select row_number() over () rid, doc_id, coalesce(text, '') t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w
  from documents),
win as (
  select rid, i, array_to_string(list_slice(w, i, i + 7), ' ') s
  from (select rid, w, unnest(range(1, len(w) - 6)) i from base where len(w) >= 8)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, s) c from win) where c > 1),
cov as (select rid, count(distinct i + k) n_repeat_words from rep, (select unnest(range(0, 8)) k) group by rid),
lin as (
  select rid, count(*) n, count(*) - count(distinct l) d
  from (select rid, unnest(string_split(t, chr(10))) l from base) where {strip.format('l')} <> '' group by rid),
m as (
  select doc_id, cast(len(w) as bigint) n_words, cast(length({strip.format('t')}) as bigint) word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) n_symbols,
    cast(coalesce(d, 0) as bigint) n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) n_repeat_words,
    coalesce(n, 0) n_lines, len(list_filter(w, lambda x: x in ({stops}))) stops,
    length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) upper,
    length(t) - length(replace(t, '!', '')) exclaims
  from base left join cov using (rid) left join lin using (rid)),
r as (
  select *, greatest(n_words, 1) k, n_repeat_words / k repeat_ratio, n_symbols / k symbol_ratio,
    word_chars / k mean_word_chars, stops / k stop_ratio, upper / greatest(word_chars, 1) upper_ratio,
    exclaims / k exclaim_ratio, n_dup_lines / greatest(n_lines, 1) dup_line_ratio,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed
  from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {tests} as kept
from r"""


QUERIES = {"op10_quality_rules": op10_quality_rules}
SQL = {"op10_quality_rules": _sql()}
