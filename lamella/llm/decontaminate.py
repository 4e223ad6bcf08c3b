"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by their number of distinct word shingles, in powers of
two. Each partition has its own bottom-k MinHash sketch size and its own number of
sketch values that a document must hold: containment is asymmetric, so the sketch is
taken of the short item only and looked up in the whole document, whose length then
doesn't matter. The needed number lies ``SLACK`` standard deviations below what an
item at the threshold holds on average, and items no larger than the sketch are
searched exactly, so hardly a match is missed. Candidates are verified by exact
containment of the item's shingles in the document.

Words are runs of letters and digits of the lower-cased text, so punctuation put
between words doesn't hide an item. Built-in column expressions only.

Defined results: a null or wordless document holds no item; an item without words is
found nowhere; an item with fewer words than a shingle is searched as its whole word
sequence; repeated rows of documents are judged one by one, equal rows of items give
equal rows of matches; extra columns are ignored by ``find_items`` and carried by
``remove_contaminated``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.llm.common import BROADCAST_KEYS, Scratch, free_name, row_keyed, table, without_rows

SHINGLE_WORDS, THRESHOLD = 5, 0.8
#: Sketch size of the partition of items with up to 2**c shingles: the square root of the size, this at least.
LEAST_SKETCH = 32
#: Standard deviations below the mean number of sketch values found at the threshold.
SLACK = 4.5
#: Sketches are broadcast up to so many rows of 40 bytes; beyond, Spark joins by shuffle.
BROADCAST_ROWS = 400_000

Combine = Callable[..., Column]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingle_steps(prefix: str, first: Column, combine: Combine) -> list[tuple[str, Column]]:
    """Columns ``{prefix}1`` to ``{prefix}5``, shingles of one to five words, each from shorter ones.

    An array is combined with one moved along, in time linear in the words.
    """

    def joined(a: int, b: int) -> Column:
        left, right = F.col(f"{prefix}{a}"), F.col(f"{prefix}{b}")
        moved = F.slice(right, F.lit(a + 1), F.greatest(F.size(right) - a, F.lit(0)))
        kept = F.slice(left, F.lit(1), F.greatest(F.size(right) - a, F.lit(0)))
        return F.zip_with(kept, moved, lambda x, y: combine(x, y))

    steps = [(f"{prefix}1", first)]
    return steps + [(f"{prefix}{n}", joined(*how)) for n, how in ((2, (1, 1)), (3, (2, 1)), (4, (2, 2)), (5, (4, 1)))]


def _with_shingles(df: DataFrame, widths: list[int], hashed: bool) -> DataFrame:
    """Add ``s{w}`` for the widths, from ``_words``: 64-bit hashes, or the word sequences themselves."""
    first = F.transform("_words", lambda w: F.xxhash64(w)) if hashed else F.col("_words")
    combine = F.xxhash64 if hashed else (lambda x, y: F.concat_ws(" ", x, y))
    needs = {1: {1}, 2: {1, 2}, 3: {1, 2, 3}, 4: {1, 2, 4}, 5: {1, 2, 4, 5}}
    wanted = set().union(*[needs[w] for w in widths])
    for name, column in _shingle_steps("s", first, combine):
        if int(name[1:]) in wanted:
            df = df.withColumn(name, column)
    return df.drop("_words", *[f"s{w}" for w in wanted - set(widths)])


def sketch_size(size_class: Column) -> Column:
    return F.greatest(F.lit(LEAST_SKETCH), F.ceil(F.pow(F.lit(2.0), size_class / 2))).cast("int")


def _sketches(items: DataFrame, threshold: float, widths: list[int]) -> DataFrame:
    """(item, need, width, h): the bottom-k sketch of each item and the number of values to be found."""
    df = _with_shingles(items, widths, True)
    own = F.coalesce(*[F.when(F.col("width") == w, F.array_distinct(f"s{w}")) for w in widths])
    df = df.select("item", "width", F.sort_array(own).alias("all")).withColumn("n", F.size("all"))
    k = F.least(F.col("n"), sketch_size(F.ceil(F.log2("n"))))
    mean, spread = k * threshold, F.sqrt(k * threshold * (1 - threshold))
    need = F.when(k == F.col("n"), F.ceil(F.round(mean, 6))).otherwise(F.floor(mean - SLACK * spread))
    return df.select("item", "width", F.greatest(need, F.lit(1)).cast("int").alias("need"), F.explode(F.slice("all", F.lit(1), k)).alias("h"))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item, n_shingles, n_found, containment) for each item that a document holds at the threshold."""
    keyed = row_keyed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    out = _matches(keyed, items, threshold, item_col, item_text_col)
    names = {"id": id_col, "item": item_col}
    return out.select(*[F.col(c).alias(names.get(c, c)) for c in ("id", "item", "n_shingles", "n_found", "containment")])


def _matches(keyed: DataFrame, items: DataFrame, threshold: float, item_col: str, item_text_col: str) -> DataFrame:
    """Matches of (_row, id, text) rows, with ``_row``."""
    scratch = Scratch(keyed.sparkSession, "decontaminate")
    tests = items.select(F.col(item_col).alias("item"), _words(F.col(item_text_col)).alias("_words"))
    tests = tests.where(F.size("_words") > 0).withColumn("width", F.least(F.size("_words"), F.lit(SHINGLE_WORDS)))
    tests = scratch.keep(row_keyed(tests, "_item"), "tests")
    widths = sorted(r.width for r in tests.select("width").distinct().collect()) or [SHINGLE_WORDS]  # five values at most
    sketches = scratch.keep(_sketches(tests.select(F.col("_item").alias("item"), "width", "_words"), threshold, widths), "sketches")
    if sketches.count() <= BROADCAST_ROWS:
        sketches = F.broadcast(sketches)

    words = keyed.select("_row", _words(F.col("text")).alias("_words"))
    pairs = _with_shingles(words, widths, True)
    labelled = lambda w: F.transform(f"s{w}", lambda h: F.struct(F.lit(w).alias("width"), h.alias("h")))
    each = F.concat(*map(labelled, widths))
    # The outer form: for the inner one Spark infers a filter on the array's size, whose copy of
    # the array's expression repeats every step inside every later one.
    values = pairs.select("_row", F.explode_outer(each if len(widths) > 1 else F.col(f"s{widths[0]}")).alias("x"))
    values = values.select("_row", "x.*") if len(widths) > 1 else values.select("_row", F.lit(widths[0]).alias("width"), F.col("x").alias("h"))
    hits = values.join(sketches, ["width", "h"]).groupBy("_row", "item", "need").agg(F.countDistinct("h").alias("hits"))
    candidates = scratch.keep(hits.where("hits >= need").select("_row", F.col("item").alias("_item")), "candidates")

    own = F.coalesce(*[F.when(F.col("width") == w, F.col(f"s{w}")) for w in widths])
    exact_items = _with_shingles(tests, widths, False).select("_item", "item", "width", F.array_distinct(own).alias("wanted"))
    # Only texts with a candidate are wanted; few rows of keys are broadcast, so that the others are not shuffled.
    rows = scratch.keep(candidates.select("_row").distinct(), "rows")
    rows = F.broadcast(rows) if rows.count() <= BROADCAST_KEYS else rows
    held = keyed.join(rows, "_row", "left_semi").select("_row", "id", _words(F.col("text")).alias("_words"))
    held = _with_shingles(held, widths, False).withColumnsRenamed({f"s{w}": f"d{w}" for w in widths})
    both = candidates.join(exact_items, "_item").join(held, "_row")
    there = F.coalesce(*[F.when(F.col("width") == w, F.col(f"d{w}")) for w in widths])
    counted = both.select("_row", "id", "item", F.size("wanted").cast("long").alias("n_shingles"), F.size(F.array_intersect("wanted", there)).cast("long").alias("n_found"))
    return counted.withColumn("containment", F.col("n_found") / F.col("n_shingles")).where(F.col("containment") >= threshold)


def remove_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that hold no item at the threshold, with all their columns."""
    row = free_name(docs, "_row")
    keyed = row_keyed(docs, row)
    found = _matches(keyed.select(F.col(row).alias("_row"), F.lit(None).cast("string").alias("id"), F.col(text_col).alias("text")), items, threshold, item_col, item_text_col)
    found = Scratch(docs.sparkSession, "contaminated").keep(found.select("_row").distinct(), "found")
    return without_rows(keyed, found, row).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL = rf"""
with d as (
  select row_number() over () rid, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') w from documents),
b as (
  select row_number() over () iid, item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') w from benchmark),
bi as (select iid, item_id, w, least(len(w), {SHINGLE_WORDS}) k from b where len(w) > 0),
bs as (
  select distinct iid, item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') s
  from (select *, unnest(range(1, len(w) - k + 2)) i from bi)),
ds as (
  select distinct rid, doc_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') s
  from (select rid, doc_id, w, k, unnest(range(1, len(w) - k + 2)) i from d, (select distinct k from bi) where len(w) >= k)),
n as (select iid, count(*) n_shingles from bs group by iid)
select doc_id, item_id, n_shingles, count(*) as n_found, count(*) / n_shingles as containment
from ds join bs using (k, s) join n using (iid)
group by rid, doc_id, iid, item_id, n_shingles
having count(*) / n_shingles >= cast({THRESHOLD} as double)
"""

QUERIES = {"op5_decontaminate": op5_decontaminate}
SQL = {"op5_decontaminate": _SQL}
