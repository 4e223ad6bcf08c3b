"""Centroid clustering with an equal-average equal-variance nearest-centroid search.

For a vector x and a centroid c of D components, with S the sum and V the deviation of
the components (V^2 = D * sum x^2 - S^2),

    D * |x - c|^2  >=  (S_x - S_c)^2 + (V_x - V_c)^2.

Centroids are sorted by their component mean. A vector starts at its own mean and scans
outward, the nearer side first: once the first square alone is past the best distance no
further centroid can win, and a centroid for which both squares together are past it is
passed over. All others get the exact distance. Everything is integer arithmetic (V
enters as its whole part, with one taken off the difference), so no rounding decides.

A round is one pass over the written vectors: each task adds up its own vectors for each
centroid, so only centroids x tasks rows are shuffled and a cluster that holds most of the
vectors is as cheap as any. The driver holds the centroids, ``k`` x ``dims`` numbers.

Defined results: vectors that are null, of another length or hold null or non-finite
components are left out; repeated rows each get a row and count each; ties in the hash
that picks the first centroids go by components; a null id hashes as "<seed>:" and comes
after equal hashes; fewer vectors than ``k`` give as many centroids; an empty table gives
no rows; extra columns are ignored; a component beyond 65,536 raises, as sums of squares
would leave the range of a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.llm.common import Scratch, table
from lamella.llm.vectors import packed, whole

#: Centroids, rounds, components and the salt of the first choice, as the contract has them.
K, ROUNDS, DIMS, SALT = 40, 5, 64, "2"
#: Largest component in size: D * D * LIMIT^2 has to stay within a long.
LIMIT = 1 << 24
#: Vectors searched at once.
ROWS = 4096


def _deviation(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Whole part of the square root of D * sum x^2 - S^2."""
    square = x.shape[1] * np.einsum("ij,ij->i", x, x) - sums * sums
    root = np.sqrt(square.astype(np.float64)).astype(np.int64)
    root -= root * root > square
    return root + ((root + 1) * (root + 1) <= square)


class Scan:
    """Exact nearest centroid of whole blocks of vectors."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        sums = self.centroids.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]
        self.deviations = _deviation(self.centroids, sums)[self.order]
        self.measured = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) for each row of ``x``; ties go to the smaller number."""
        x = x.astype(np.int64)
        dims, k = x.shape[1], len(self.order)
        sums = x.sum(axis=1)
        deviations = _deviation(x, sums)
        best = np.full(len(x), np.iinfo(np.int64).max // dims, np.int64)
        number = np.full(len(x), -1, np.int64)
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        far = np.int64(1) << 32  # past any difference of sums
        rows = np.arange(len(x))
        while len(rows):
            lo, hi = low[rows], high[rows]
            left = np.where(lo >= 0, sums[rows] - self.sums[np.maximum(lo, 0)], far)
            right = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - sums[rows], far)
            gap = np.minimum(left, right)
            go = (gap < far) & (gap * gap <= dims * best[rows])
            rows, down, gap = rows[go], (left <= right)[go], gap[go]
            place = np.where(down, low[rows], high[rows])
            low[rows] -= down
            high[rows] += ~down
            spread = np.maximum(np.abs(deviations[rows] - self.deviations[place]) - 1, 0)
            near = gap * gap + spread * spread <= dims * best[rows]
            tried, c = rows[near], self.order[place[near]]
            apart = x[tried] - self.centroids[c]
            distance = np.einsum("ij,ij->i", apart, apart)
            self.measured += len(tried)
            better = (distance < best[tried]) | ((distance == best[tried]) & (c < number[tried]))
            best[tried[better]], number[tried[better]] = distance[better], c[better]
        return number, best


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        yield part, np.frombuffer(b"".join(v.as_py() for v in part.column("v")), "<i4").reshape(-1, dims)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sum of components of every centroid that is nearest to any."""
    k, dims = centroids.shape
    schema = "cluster int, n long, sums array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, count, total = Scan(centroids), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, x in _blocks(batch, dims):
                number, _ = scan.nearest(x)
                count += np.bincount(number, minlength=k)
                np.add.at(total, number, x)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(count[held]), pa.array(total[held].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    partial = vectors.select("v").mapInArrow(run, schema)
    each = partial.select("cluster", "n", F.posexplode("sums").alias("d", "s"))
    added = each.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()  # k x dims rows at most
    out: dict[int, tuple[int, list[int]]] = {}
    for r in added:
        out.setdefault(r["cluster"], (r["n"], [0] * dims))[1][r["d"]] = r["s"]
    return out


def first_centroids(vectors: DataFrame, k: int, dims: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of their id, in that order."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    chosen = vectors.select("v", key.alias("hash"), F.col("id").isNull().alias("none")).orderBy("hash", "none", "v").limit(k).collect()
    return np.frombuffer(b"".join(bytes(r["v"]) for r in chosen), "<i4").reshape(-1, dims).astype(np.int64)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS, salt: str = SALT) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) for every vector that takes part, the centroids)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "centroids")
    vec = F.col(vec_col)
    taken = vectors.where(whole(vec) & (F.size(vec) == dims)).select(F.col(id_col).alias("id"), vec.alias("v"))
    kept = scratch.keep(packed(taken, "v", LIMIT), "vectors")
    centroids = first_centroids(kept, k, dims, salt)
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.copy()
        for c, (n, sums) in _sums(kept, centroids).items():
            moved[c] = [s // n for s in sums]
        centroids = moved

    schema = T.StructType([kept.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(centroids)
        for batch in batches:
            for part, x in _blocks(batch, dims):
                number, distance = scan.nearest(x)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(number, pa.int32()), pa.array(distance)], schema.names)

    assigned = scratch.keep(kept.mapInArrow(run, schema), "assigned")
    scratch.drop(kept)
    return assigned.withColumnRenamed("id", id_col), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Distances summed over each cluster and over all, and the hash of each centroid's components."""
    spark = assigned.sparkSession
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(exact.alias("s")).collect()}  # one row for each centroid
    total = sum(inertia.values())
    rows = [(c, s, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in inertia.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster(table(spark, sf_dir, "embeddings"))
    return with_inertia(assigned, centroids).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """One pair of steps for each round: assign every vector, then move the centroids."""
    steps = [
        f"""v as materialized (select row_number() over (order by vec_id) r, vec_id, embedding e from embeddings
  where embedding is not null and len(embedding) = {DIMS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        "p as materialized (select r, unnest(range(1, 65)) d, cast(floor(256 * cast(unnest(e) as double)) as bigint) x from v)",
        f"s as materialized (select r, row_number() over (order by sha256('{SALT}:' || vec_id), r) - 1 c from v order by sha256('{SALT}:' || vec_id), r limit {K})",
        "c0 as materialized (select c, d, x y from s join p using (r))",
    ]
    for i in range(ROUNDS + 1):
        steps += [
            f"d{i} as materialized (select r, c, cast(sum((x - y) * (x - y)) as bigint) z from p join c{i} using (d) group by r, c)",
            f"a{i} as materialized (select r, c, z from (select *, row_number() over (partition by r order by z, c) n from d{i}) where n = 1)",
        ]
        if i < ROUNDS:
            steps += [
                f"m{i} as materialized (select c, d, cast(sum(x) as bigint) t, count(*) n from a{i} join p using (r) group by c, d)",
                f"c{i + 1} as materialized (select c, d, coalesce((t - ((t % n) + n) % n) // n, y) y from c{i} left join m{i} using (c, d))",
            ]
    last = ROUNDS
    return (
        "with "
        + ",\n".join(steps)
        + f""",
h as (select c, sha256(string_agg(cast(y as varchar), ',' order by d)) g from c{last} group by c)
select vec_id, cast(c as int) as cluster, z as distance, cast(sum(z) over (partition by c) as bigint) as cluster_inertia,
       cast(sum(z) over () as bigint) as inertia, g as centroid_sha256
from a{last} join v using (r) join h using (c)"""
    )


QUERIES = {"op13_centroid_clustering": op13_centroid_clustering}
SQL = {"op13_centroid_clustering": _sql()}
