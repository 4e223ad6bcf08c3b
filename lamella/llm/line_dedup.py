"""Fuzzy line dedup: MinHash over character shingles, exact verification, union-find.

A line is compared in lower case with its white space run together. Equal lines are
one piece from the start; different lines are linked at a Jaccard similarity of 0.8
of their character shingles. Of each class the first line stays, by the row's file and
number in it and the line's place; the others are taken out of their documents.

Defined results: a null text stays null and counts no lines; lines without a visible
character are never compared and stay where they are; a text whose lines all go
becomes empty; a line shorter than a shingle is similar to its equals only; repeated
rows are separate documents, so the lines of the later one go; ids are carried, null
or not, and decide nothing; extra columns are carried by ``dedup_lines``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.llm.banding import Picks, bucket_rows, classes
from lamella.llm.common import Scratch, row_keyed, table

#: Characters in a shingle, similarity, and banding: at 0.8 a pair is met with probability 0.997.
SHINGLE_CHARS, THRESHOLD, BANDS, ROWS = 8, 0.8, 8, 3
#: Characters of lines that a task works on at once.
BLOCK_CHARS = 1 << 20

#: White space other than blanks and line ends; few texts hold any.
_ODD_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
#: Made once, as nearly all lines are short enough for them.
_RUNS = [slice(i, i + SHINGLE_CHARS) for i in range(2000)]


def shingles(line: str) -> frozenset:
    n = len(line) - SHINGLE_CHARS + 1
    if n <= 1:
        return frozenset((line,))
    if n > len(_RUNS):
        return frozenset(line[i : i + SHINGLE_CHARS] for i in range(n))
    return frozenset(map(line.__getitem__, _RUNS[:n]))


def characters(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(lines).encode("utf-32-le"), "<u4"), np.array([len(t) for t in lines])


def lines_of(text: str | None) -> Iterator[tuple[int, str]]:
    """(place, normal form) of the comparable lines of a text."""
    text = (text or "").lower()
    plain = "  " not in text and not any(c in text for c in _ODD_SPACES)
    for pos, line in enumerate(text.split("\n")):
        if normal := line.strip(" ") if plain else " ".join(line.split()):
            yield pos, normal


def _uids(lines: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t.encode()) for t in lines], np.uint64).view(np.int64)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """(rows of the batch, places, normal forms) of its lines, so many characters at once."""
    rows, places, lines, size = [], [], [], 0
    for i, text in enumerate(batch.column("text")):
        for pos, normal in lines_of(text.as_py()):
            rows.append(i)
            places.append(pos)
            lines.append(normal)
            size += len(normal)
            if size >= BLOCK_CHARS:
                yield rows, places, lines
                rows, places, lines, size = [], [], [], 0
    if lines:
        yield rows, places, lines


def _scan(keyed: DataFrame) -> DataFrame:
    """One pass over (_row, text): rows (uid, _row, pos) of lines and rows (uid, bucket) of bands."""
    key = keyed.schema["_row"].dataType
    schema = T.StructType([T.StructField("uid", T.LongType()), T.StructField("_row", key), T.StructField("pos", T.IntegerType()), T.StructField("bucket", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_row")
            for rows, places, lines in _blocks(batch):
                uids = _uids(lines)
                yield pa.RecordBatch.from_arrays([pa.array(uids), keys.take(pa.array(rows)), pa.array(places, pa.int32()), pa.nulls(len(rows), pa.int64())], schema.names)
                for ids, buckets in bucket_rows(uids, *characters(lines), SHINGLE_CHARS, BANDS, ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(len(ids), keys.type), pa.nulls(len(ids), pa.int32()), pa.array(buckets)], schema.names)

    return keyed.select("_row", "text").mapInArrow(run, schema)


def _pieces(keyed: DataFrame, picks: Picks) -> DataFrame:
    """(uid, text) of the picked lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, lines in _blocks(batch):
                uids = _uids(lines)
                found = {int(uids[i]): lines[i] for i in np.flatnonzero(picks(uids))}
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.string())], ["uid", "text"])

    return keyed.select("text").mapInArrow(run, "uid long, text string")


def removed_lines(keyed: DataFrame, scratch: Scratch) -> DataFrame:
    """(_row, gone): the places of the lines to take out of (_row, text), in order; a written table."""
    scanned = scratch.keep(_scan(keyed), "scanned")
    lines = scanned.where("bucket is null").select("uid", "_row", "pos")
    keys = scanned.where("bucket is not null").select("bucket", "uid")
    roots = classes(scratch, keys, partial(_pieces, keyed), characters, SHINGLE_CHARS, THRESHOLD)
    counted = lines.groupBy("uid").agg(F.min(F.struct("_row", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
    counted = counted.join(roots, counted["uid"] == roots["node"], "left").where("n > 1 or root is not null")
    counted = scratch.keep(counted.select("uid", "first", F.coalesce("root", "uid").alias("component")), "repeated")
    first = counted.groupBy("component").agg(F.min("first").alias("stays"))
    kept = scratch.keep(counted.join(first, "component").select("uid", "stays"), "stays")
    gone = lines.join(kept, "uid").where(F.struct("_row", "pos") != F.col("stays"))
    gone = scratch.keep(gone.groupBy("_row").agg(F.array_sort(F.collect_list("pos")).alias("gone")), "gone")
    scratch.drop(scanned, counted, kept)
    return gone


def dedup_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text_col``, all rows and columns kept."""
    marked = _marked(docs, text_col)
    out = [F.col("_new").alias(c) if c == text_col else F.col(f"_whole.`{c}`").alias(c) for c in docs.columns]
    return marked.select(*out)


def _marked(docs: DataFrame, text_col: str) -> DataFrame:
    """(_whole, _new, _n_lines, _n_removed) for each row."""
    scratch = Scratch(docs.sparkSession, "lines")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    keyed = row_keyed(docs.select(whole))
    text = F.col(f"_whole.`{text_col}`").alias("text")
    places = removed_lines(keyed.select("_row", text), scratch)
    # Few bytes a document meet whole texts: in a hash join only the places are held, and no text is sorted.
    joined = keyed.join(places.hint("shuffle_hash"), "_row", "left").select("_whole", text, "gone")
    split = joined.withColumn("_lines", F.split("text", "\n"))
    # A map from the removed places would be searched for each line; a merge by place is linear.
    flags = F.transform(F.array_repeat(F.lit(True), F.size("_lines")), lambda _, i: i)
    split = split.withColumn("_stay", F.when(F.size("gone") > 0, F.array_except(flags, "gone")).otherwise(flags))
    new = F.array_join(F.transform("_stay", lambda i: F.element_at(F.col("_lines"), i + 1)), "\n")
    new = F.when(F.col("gone").isNull(), F.col("text")).otherwise(new)
    return split.select("_whole", new.alias("_new"), F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).alias("_n_lines"), F.greatest(F.size("gone"), F.lit(0)).alias("_n_removed"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = _marked(table(spark, sf_dir, "documents"), "text")
    return marked.select("_whole.doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_removed").cast("long").alias("n_removed"), F.col("_new").alias("text"))


QUERIES = {"op4_line_dedup": op4_line_dedup}
SQL: dict[str, str] = {}
