"""Exact top-k by inner product with pivot-table elimination.

Vectors become integers, floor(scale * x). Distances of every vector to ``pivots`` reference vectors are computed once. For a
query q and a candidate c the triangle inequality gives, over all pivots p, |q - c| >= max |d(q,p) - d(c,p)|, and with
q.c = (|q|^2 + |c|^2 - |q - c|^2) / 2 an upper bound on the score. Candidates are evaluated in order of that bound, in runs,
until the k-th best score is above every bound that is left; equal bounds are still evaluated, as ties go to the smaller id.

Queries are a stated set. They are cut into blocks of ``QUERY_BLOCK``; each block is broadcast (its size is fixed by that
number, not by the data) and meets all candidates where these lie, so candidates are read once a block and never shuffled. A task
keeps k rows a query; the last step takes the k best of those. Pivots come from a bounded sample of rows; any pivots give the same result.

Nulls, ties: vectors that are null or hold a null or non-finite component take no part, nor do rows with a null id. Vectors of different length count as
padded with zeros; an empty one scores 0. Rows that share an id are separate candidates; a query leaves out all rows of its own
id, and repeated query rows give one answer (the first by value). Scores beyond 2**53 are computed with integers and must fit 64 bits. No rows, no queries: no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize

K = 5
SCALE = 256
PIVOTS = 24
#: Rows that the pivots are chosen from.
PIVOT_SAMPLE = 1000
#: Queries that are broadcast at once (64 components: 8 MB), and blocks that one job works off.
QUERY_BLOCK = 16_384
BLOCKS_A_JOB = 8
#: Candidates evaluated at once, and looked at together.
RUN = 256
CANDIDATES = 4096


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _matrix(col: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column as doubles, padded with zeros."""
    size = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = max(int(size.max()) if len(size) else 0, width or 0)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * x @ pivots.T, 0))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice, starting from the vector of largest norm."""
    if not len(sample):
        return sample
    picked = [int((sample * sample).sum(1).argmax())]
    near = ((sample - sample[picked[0]]) ** 2).sum(1)
    while len(picked) < min(n, len(sample)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[picked[-1]]) ** 2).sum(1))
    return sample[picked]


def _pad(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x


def top_of(queries: np.ndarray, query_ids: np.ndarray, query_dist: np.ndarray, x: np.ndarray, ids: np.ndarray, dist: np.ndarray, k: int, best: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
    """Bring ``best``, the ids and scores of each query's k best rows so far, up to date with the rows of x, exactly."""
    width = max(queries.shape[1], x.shape[1])
    queries, x = _pad(queries, width), _pad(x, width)
    qq, xx = (queries * queries).sum(1), (x * x).sum(1)
    # sums of integers are exact in doubles below 2**53
    exact = not len(x) or np.abs(x).max(initial=0) * np.abs(queries).max(initial=0) * max(width, 1) < 2.0**53
    whole, wholes = (x, queries) if exact else (x.astype(np.int64), queries.astype(np.int64))
    for i in range(len(queries)):
        low = np.abs(dist - query_dist[i]).max(axis=1) if dist.shape[1] else np.zeros(len(x))
        # rounding of the distances is far below this slack
        bound = (qq[i] + xx - np.maximum(low - 1e-6 * (1 + low), 0) ** 2) / 2 * (1 + 1e-9) + 1e-3 + 1e-9 * (qq[i] + xx)
        bound[ids == query_ids[i]] = -np.inf
        order = np.argsort(-bound)
        top_id, top = best.get(i, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        for at in range(0, len(order), RUN):
            run = order[at : at + RUN]
            if len(top) == k and top[-1] > bound[run[0]]:
                break
            run = run[bound[run] > -np.inf]
            top_id, top = np.append(top_id, ids[run]), np.append(top, (whole[run] @ wholes[i]).astype(np.int64))
            keep = np.lexsort((top_id, -top))[:k]
            top_id, top = top_id[keep], top[keep]
        best[i] = top_id, top


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: float = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, id, score): the k highest scores of each query row against all rows of another id."""
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), is_query.alias("q")).where(F.col("id").isNotNull() & usable(F.col("v")))
    rows = rows.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"), "q")
    some = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("v").toArrow().column("v").combine_chunks()
    table = choose_pivots(_matrix(some), pivots)
    table = table if len(table) else np.zeros((0, 0))
    asked = rows.where(F.coalesce("q", F.lit(False))).groupBy("id").agg(F.min("v").alias("v"))
    asked = materialize(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(1 << 20))), "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    done, found, sent = [], [], []
    for block in range(blocks):
        # a run of hash values that holds about QUERY_BLOCK queries
        low, high = block * (1 << 20) // blocks, (block + 1) * (1 << 20) // blocks
        part = asked.where((F.col("block") >= low) & (F.col("block") < high)).orderBy("id").select("id", "v").toArrow()
        query_ids = part.column("id").to_numpy()
        queries = _matrix(part.column("v").combine_chunks())
        held = spark.sparkContext.broadcast((query_ids, queries, table))
        sent.append(held)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            query_ids, queries, table = held.value
            width = max(queries.shape[1], table.shape[1])
            far = _distances(_pad(queries, width), _pad(table, width))
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for whole in batches:
                for at in range(0, len(whole), CANDIDATES):
                    b = whole.slice(at, CANDIDATES)
                    x = _matrix(b.column("v"))
                    w = max(x.shape[1], table.shape[1])
                    top_of(queries, query_ids, far, x, b.column("id").to_numpy(), _distances(_pad(x, w), _pad(table, w)), k, best)
            if best:
                asked = np.concatenate([np.full(len(ids), query_ids[q]) for q, (ids, _) in best.items()])
                yield pa.RecordBatch.from_arrays([pa.array(asked), *[pa.array(np.concatenate([t[j] for t in best.values()])) for j in (0, 1)]], ["query_id", "id", "score"])

        found.append(rows.select("id", "v").mapInArrow(run, "query_id long, id long, score long"))
        if len(found) == BLOCKS_A_JOB and block + 1 < blocks:
            done.append(materialize(reduce(DataFrame.unionByName, found), "top"))
            for b in sent:
                b.destroy()
            found, sent = [], []
    # k rows a query and task
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return reduce(DataFrame.unionByName, done + found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op7_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """The five best rows for every vector whose id is divisible by 50."""
    found = top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(list_filter(embedding, lambda x: x IS NOT NULL), lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""
