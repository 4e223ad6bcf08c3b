"""Repeated passages: paragraph MinHash banding, exact Jaccard, clusters by components.

A passage can stand anywhere in a document, so paragraphs are cut where any copy of
the passage is cut as well: at line breaks and at ends of sentences. Paragraphs are
compared as sets of five-word shingles of their lower-cased words. Equal ones are one
piece; others are linked at a Jaccard similarity of 0.8. A paragraph counts as
repeated if its class occurs in two rows or more, and a run of such paragraphs is
reported once it has ``LEAST_WORDS`` words, so common short lines alone report nothing.

Of each class the first paragraph stays, by the row's file and number in it and the
paragraph's place; the others are marked as removed.

Defined results: null, empty and wordless texts have no paragraphs; a paragraph of up
to five words is one shingle, similar to its equals only; repeated rows are different
rows, so their passages are repeated; repeats inside one row alone are not reported;
rows with a null id are reported with a null id; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.llm.banding import Picks, bucket_rows, classes
from lamella.llm.common import Scratch, row_keyed, table

#: Words in a shingle, similarity, and banding: at 0.8 a pair is met with probability 0.983, at 0.9 with 0.9987.
SHINGLE_WORDS, THRESHOLD, BANDS, ROWS = 5, 0.8, 4, 2
#: Words of a run of repeated paragraphs from which it is reported.
LEAST_WORDS = 24

#: From a character to the first end of a sentence or line; runs are taken whole, so the search is linear.
_PARAGRAPH = re.compile(r"\S[^\n.!?]*+(?:[.!?]++(?![\x20\t\n\r]|\Z)[^\n.!?]*+)*+[.!?]*+")
#: Characters of paragraphs that a task works on at once, and words whose hashes it remembers.
BLOCK_CHARS, REMEMBERED = 1 << 20, 200_000


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode())
        return h


_KNOWN = _Hashes()


def paragraphs(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, normal form) of the paragraphs; offsets in code points."""
    low = text.lower()
    moved = len(low) != len(text)  # a letter whose small form is longer
    for m in _PARAGRAPH.finditer(text if moved else low):
        raw = m[0]
        words = (raw.lower() if moved else raw).split()
        yield m.start(), m.start() + len(raw.rstrip()), " ".join(words)


def shingles(paragraph: str) -> frozenset:
    w = paragraph.split(" ")
    if len(w) <= SHINGLE_WORDS:
        return frozenset((tuple(w),))
    return frozenset(zip(*[w[k:] for k in range(SHINGLE_WORDS)], strict=False))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.array(list(map(_KNOWN.__getitem__, " ".join(texts).split(" "))), np.uint64)
    return hashes, np.array([t.count(" ") + 1 for t in texts])


def _uids(texts: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t.encode()) for t in texts], np.uint64).view(np.int64)


def _blocks(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, int, int, str]]]:
    """(row of the batch, place, start, end, normal form) of its paragraphs, so many characters at once."""
    found, size = [], 0
    for i, text in enumerate(batch.column("text")):
        for pos, (s, e, normal) in enumerate(paragraphs(text.as_py() or "")):
            found.append((i, pos, s, e, normal))
            size += e - s
            if size >= BLOCK_CHARS:
                yield found
                found, size = [], 0
    if found:
        yield found


def _scan(keyed: DataFrame) -> DataFrame:
    """One pass over (_row, text): rows of paragraphs, and rows (uid, bucket) of their bands."""
    ints = [T.StructField(n, T.IntegerType()) for n in ("pos", "s", "e", "n_words")]
    schema = T.StructType([T.StructField("uid", T.LongType()), T.StructField("_row", keyed.schema["_row"].dataType), *ints, T.StructField("bucket", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_row")
            for found in _blocks(batch):
                rows, pos, s, e, texts = zip(*found, strict=True)
                uids, (hashes, counts) = _uids(texts), words(texts)
                yield pa.RecordBatch.from_arrays([pa.array(uids), keys.take(pa.array(rows)), *[pa.array(c, pa.int32()) for c in (pos, s, e, counts)], pa.nulls(len(rows), pa.int64())], schema.names)
                for ids, buckets in bucket_rows(uids, hashes, counts, SHINGLE_WORDS, BANDS, ROWS):
                    n = len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(n, keys.type), *[pa.nulls(n, pa.int32())] * 4, pa.array(buckets)], schema.names)

    return keyed.select("_row", "text").mapInArrow(run, schema)


def _pieces(keyed: DataFrame, picks: Picks) -> DataFrame:
    """(uid, text) of the picked paragraphs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in _blocks(batch):
                uids = _uids([f[4] for f in found])
                texts = {int(uids[i]): found[i][4] for i in np.flatnonzero(picks(uids))}
                yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.int64()), pa.array(list(texts.values()), pa.string())], ["uid", "text"])

    return keyed.select("text").mapInArrow(run, "uid long, text string")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(id, paragraph, start, end, n_words, run_words, component_id, removed) of the repeated paragraphs."""
    scratch = Scratch(docs.sparkSession, "passages")
    keyed = row_keyed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    scanned = scratch.keep(_scan(keyed), "scanned")
    found = scanned.where("bucket is null").drop("bucket")
    keys = scanned.where("bucket is not null").select("bucket", "uid")
    roots = classes(scratch, keys, partial(_pieces, keyed), words, SHINGLE_WORDS, THRESHOLD)
    counted = found.groupBy("uid").agg(F.min(F.struct("_row", "pos")).alias("first"), F.max("_row").alias("last"))
    alone = counted.where("first._row < last")
    # A piece of one row only counts where its class reaches into another row.
    classed = scratch.keep(counted.join(roots, counted["uid"] == roots["node"]).select("uid", "first", "last", "root"), "classed")
    spans = classed.groupBy("root").agg(F.min("first").alias("stays"), F.max("last").alias("end")).where("stays._row < end")
    reaching = classed.join(spans, "root").select("uid", F.col("root").alias("component_id"), "stays")
    equal = alone.join(roots, alone["uid"] == roots["node"], "left_anti").select("uid", F.col("uid").alias("component_id"), F.col("first").alias("stays"))
    repeated = scratch.keep(reaching.union(equal), "repeated")
    scratch.drop(classed)

    marked = found.join(repeated, "uid")
    by_row = Window.partitionBy("_row")
    marked = marked.withColumn("run", F.col("pos") - F.row_number().over(by_row.orderBy("pos")))
    marked = marked.withColumn("run_words", F.sum("n_words").over(Window.partitionBy("_row", "run"))).where(F.col("run_words") >= least_words)
    ids = keyed.select("_row", "id")
    removed = (F.col("_row") != F.col("stays._row")) | (F.col("pos") != F.col("stays.pos"))
    return marked.join(ids, "_row").select(
        F.col("id").alias(id_col),
        F.col("pos").alias("paragraph"),
        F.col("s").alias("start"),
        F.col("e").alias("end"),
        F.col("n_words").cast("long").alias("n_words"),
        "run_words",
        "component_id",
        removed.alias("removed"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


QUERIES = {"op3_substring_dedup": op3_substring_dedup}
SQL: dict[str, str] = {}
