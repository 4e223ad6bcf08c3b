"""Exact top-k search by inner product with the threshold algorithm over sorted lists.

The vectors are dealt into blocks by a hash of their place, and each block keeps one list
for each dimension, sorted by that component. A query walks all lists of a block at once,
from the top where its own component is positive and from the bottom where it is negative.
Each vector met for the first time is looked up whole and scored. After each step the
threshold is the score of a vector that would stand at the reached place of every list: no
vector still unmet can score more. The walk ends when the k-th best score is above it (a tie
could still bring a smaller id). The k-th best of a query is carried from block to block
within a task, so later blocks start with a bound that ends them sooner.

The queries are packed into blocks as well and meet every block of vectors by number, so a
task holds one block of each. Query blocks are broadcast while they are small by count, else
shuffled. Each task gives at most k rows for a query, and a window takes the first k of them.

Defined results: vectors that are null or hold null or non-finite components take no part; of
two vectors of different lengths the shorter one counts as filled up with zeros; an empty
vector scores zero; repeated rows are candidates each, also of one another; a null id is never
a query and comes after all ids among ties; ties of id as well go by the rows' places; an empty
table or one without queries gives no rows; extra columns are ignored; a component beyond
8,388,607, or scores past a long, raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamella.llm.common import Scratch, row_keyed, table
from lamella.llm.vectors import packed, unpack, whole

#: Results for each query, and which ids are queries, as the contract has them.
K, EVERY = 5, 50
#: Vectors and queries in a block; both bound the memory of a task.
BLOCK, QUERY_BLOCK = 8192, 1024
#: Bytes of packed queries up to which they are broadcast.
BROADCAST_BYTES = 32 << 20
LIMIT = (1 << 31) - 1
#: Places of each list that the first step takes; each later step takes twice as many.
STEP = 16

_BLOCK_SCHEMA = "block long, ids array<long>, files array<long>, rows array<long>, dims int, data binary"


def _blocks(df: DataFrame, n: int) -> DataFrame:
    """One row for each of ``n`` blocks: ids, places and the matrix of the packed vectors."""

    def run(group: pa.Table) -> pa.Table:
        vectors = unpack(group.column("v").combine_chunks())
        dims = max(map(len, vectors), default=0)
        data = np.zeros((len(vectors), dims), "<i4")
        for i, v in enumerate(vectors):
            data[i, : len(v)] = v
        lists = [pa.array([group.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("id", "file", "row")]
        return pa.table([group.column("block")[:1].combine_chunks(), *lists, pa.array([dims], pa.int32()), pa.array([data.tobytes()], pa.binary())], ["block", "ids", "files", "rows", "dims", "data"])

    return df.withColumn("block", F.pmod(F.xxhash64("file", "row"), F.lit(n))).groupBy("block").applyInArrow(run, _BLOCK_SCHEMA)


def _matrix(data: bytes, dims: int, rows: int, width: int) -> np.ndarray:
    out = np.zeros((rows, width), np.float64)
    out[:, :dims] = np.frombuffer(data, "<i4").reshape(rows, dims)
    return out


class Best:
    """The best ``k`` candidates of one query so far, best first."""

    def __init__(self, k: int):
        self.k, self.found = k, []

    def bound(self) -> float:
        return -self.found[-1][0] if len(self.found) == self.k else -np.inf

    def add(self, scores: np.ndarray, at: np.ndarray, name: list) -> None:
        bound = self.bound()
        good = np.flatnonzero(scores >= bound)
        if len(good) > self.k:  # only those not below the k-th of them can stay
            good = good[scores[good] >= np.partition(scores[good], len(good) - self.k)[len(good) - self.k]]
        if len(good):
            self.found = sorted(self.found + [(-scores[g].item(), *name[at[g]]) for g in good])[: self.k]


class Lists:
    """Sorted lists of one block of vectors, and the walk of a query over them."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, self.order, axis=0)
        self.met = 0

    def walk(self, q: np.ndarray, best: Best, name: list, own: int | None) -> None:
        n = len(self.x)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        seen = np.zeros(n, bool)
        if own is not None:
            seen[own] = True
        depth, step = 0, STEP
        if not len(up) and not len(down):  # every vector scores zero and stands in no list
            depth, fresh = n, np.flatnonzero(~seen)
            best.add(np.zeros(len(fresh), self.x.dtype), fresh, name)
        while depth < n:
            # The threshold of the places about to be read bounds all that is unmet.
            ahead = self.sorted[n - 1 - depth, up] @ q[up] + self.sorted[depth, down] @ q[down]
            if best.bound() > ahead:
                break
            end = min(n, depth + step)
            here = np.zeros(n, bool)
            here[self.order[n - end : n - depth][:, up].ravel()] = True
            here[self.order[depth:end][:, down].ravel()] = True
            fresh = np.flatnonzero(here & ~seen)
            if len(fresh):
                seen |= here
                self.met += len(fresh)
                best.add(self.x[fresh] @ q, fresh, name)
            depth, step = end, step * 2


def _exact(x: np.ndarray, q: np.ndarray) -> type:
    """The number type in which all scores are whole and exact."""
    largest = int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, x.shape[1])
    if largest >= 1 << 63:
        raise OverflowError("scores don't fit a long")
    return np.float64 if largest < 1 << 53 else np.int64


def _search(k: int):
    def emit(found: dict) -> pa.RecordBatch:
        rows = [(q, i, -s, *c) for (q, i), best in found.items() for s, *c in best.found]
        q, query_id, score, none, vec_id, file, row = zip(*rows, strict=True) if rows else ([],) * 7
        ids = [None if n else v for n, v in zip(none, vec_id, strict=True)]
        columns = [[a for a, _ in q], [b for _, b in q], query_id, ids, [int(s) for s in score], file, row]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["q_file", "q_row", "query_id", "vec_id", "score", "file", "row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_block, found = None, {}
        for batch in batches:
            for r in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if r["qb"] != query_block:
                    yield emit(found)
                    query_block, found = r["qb"], {}
                width = max(r["dims"], r["q_dims"])
                x = _matrix(r["data"], r["dims"], len(r["ids"]), width)
                queries = _matrix(r["q_data"], r["q_dims"], len(r["q_ids"]), width)
                kind = _exact(x, queries)
                lists, queries = Lists(x.astype(kind)), queries.astype(kind)
                places = list(zip(r["files"], r["rows"], strict=True))
                name = [(i is None, i or 0, *p) for i, p in zip(r["ids"], places, strict=True)]
                own = {p: i for i, p in enumerate(places)}
                for i, q in enumerate(queries):
                    place = (r["q_files"][i], r["q_rows"][i])
                    best = found.setdefault((place, r["q_ids"][i]), Best(k))
                    lists.walk(q, best, name, own.get(place))
        yield emit(found)

    return run


def top_k(vectors: DataFrame, is_query: F.Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows for each row where ``is_query`` holds."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    vec = F.col(vec_col)
    taken = vectors.where(whole(vec)).select(F.col(id_col).cast("long").alias("id"), vec.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    keyed = row_keyed(taken, "at").select("id", "v", "asks", "at.file", "at.row")
    rows = scratch.keep(packed(keyed, "v", LIMIT), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q"), F.coalesce(F.sum(F.when(F.col("asks"), F.length("v"))), F.lit(0)).alias("bytes")).first()
    n_query_blocks = max(1, -(-size["q"] // query_block))
    blocks = scratch.keep(_blocks(rows.drop("asks"), max(1, -(-size["n"] // block))), "blocks")
    asking = _blocks(rows.where("asks").drop("asks"), n_query_blocks).withColumnRenamed("block", "qb").withColumnsRenamed({c: f"q_{c}" for c in ("ids", "files", "rows", "dims", "data")})
    asking = scratch.keep(asking, "queries")
    pairs = blocks.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_query_blocks - 1).cast("long"))))
    pairs = pairs.join(F.broadcast(asking) if size["bytes"] <= BROADCAST_BYTES else asking, "qb")
    # Two or three tasks for each core share the pairs; those of one query block come one after another in a task.
    tasks = min(size["n"] // block + 1, 3 * spark.sparkContext.defaultParallelism) * n_query_blocks
    pairs = pairs.repartition(max(1, min(tasks, 4096)), "qb", F.pmod("block", F.lit(3 * spark.sparkContext.defaultParallelism))).sortWithinPartitions("qb", "block")
    found = scratch.keep(pairs.mapInArrow(_search(k), "q_file long, q_row long, query_id long, vec_id long, score long, file long, row long"), "found")
    scratch.drop(blocks, asking, rows)
    first = Window.partitionBy("q_file", "q_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "file", "row")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


_SQL = f"""
with v as materialized (
  select row_number() over (order by vec_id) r, vec_id, embedding e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (select r, unnest(range(1, len(e) + 1)) d, cast(floor(256 * cast(unnest(e) as double)) as bigint) x from v),
q as (select p.* from p join v using (r) where vec_id % {EVERY} = 0),
s as (select q.r a, p.r b, cast(sum(q.x * p.x) as bigint) score from q join p on q.d = p.d and q.r <> p.r group by q.r, p.r),
n as (select a, b, score, v.vec_id, row_number() over (partition by a order by score desc, v.vec_id) k from s join v on v.r = b)
select v.vec_id as query_id, cast(k as int) as rank, n.vec_id as vec_id, score from n join v on v.r = a where k <= {K}
"""

QUERIES = {"op12_top_k": op12_top_k}
SQL = {"op12_top_k": _SQL}
