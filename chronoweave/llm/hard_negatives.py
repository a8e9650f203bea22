"""Hard negatives by distributed radix selection over integer scores.

Vectors become integers, floor(scale * x); a score is an inner product. Anchors are a stated set of rows, cut into broadcast blocks of
``ANCHOR_BLOCK``; each block meets all candidates where these lie. Candidates are never shuffled.

``_Search.best`` finds, for each window of scores [lo, hi] of an anchor, the k best rows in it. Round by round, tasks count the scores of
each window by a digit of ``DIGIT_BITS`` bits, from the window's top down; Spark adds the counts of all tasks, the bucket that holds the
kth row becomes the next, narrower window, and so on until it is one score. Then a last pass gathers only rows at or above that score,
of equal ones the smallest ids. A task leaves out its buckets, or rows, below those that hold its own k best: the kth of
all cannot lie there. So at most k rows a window and task are shuffled, however many rows tie.

An anchor's positives are the best of one window over all scores, among rows of its label; each positive's score makes a window for
rows of other labels.

Nulls, ties: rows with a null id or label, and vectors that are null or hold a null or non-finite component, take no part. Vectors of different
length count as padded with zeros. Equal scores go by the smaller id. Rows that share an id are separate rows, but no positives of an anchor of that id;
of several anchor rows with one id the first by vector and label asks. Labels compare by value, as longs where they are integers, else by a
64-bit hash. Scores beyond 2**53 are computed with integers and must fit 62 bits. No rows, no anchors: no result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import materialize, release, written
from .topk import _matrix, _pad, usable

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Percent of the positive's score that a negative's has at least and at most.
LOW, HIGH = 50, 95
#: Anchors that are broadcast at once (64 components: 8 MB).
ANCHOR_BLOCK = 16_384
#: Bits of a score that a round settles.
DIGIT_BITS = 12
#: Anchors and candidates of one matrix product.
ANCHORS, CANDIDATES = 512, 4096
#: Above every score.
NEVER = 1 << 62


def products(queries: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact."""
    width = max(queries.shape[1], x.shape[1])
    queries, x = _pad(queries, width), _pad(x, width)
    if np.abs(x).max(initial=0) * np.abs(queries).max(initial=0) * max(width, 1) < 2.0**53:
        return queries @ x.T
    return queries.astype(np.int64) @ x.astype(np.int64).T


def leading(window: np.ndarray, keys: list[np.ndarray], count: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Which rows to keep, in order of window and keys: those that begin before their window has need[window] counted."""
    order = np.lexsort((*reversed(keys), window))
    w, c = window[order], count[order]
    before = np.cumsum(c) - c
    first = np.ones(len(w), bool)
    first[1:] = w[1:] != w[:-1]
    before -= before[first][np.cumsum(first) - 1]
    return order[before < need[w]]


class _Search:
    """One block of anchors against all candidates. windows: (anchor, slot) -> scores [lo, hi]; an empty one has lo > hi."""

    def __init__(self, rows: DataFrame, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        self.rows, self.spark = rows, rows.sparkSession
        self.held = self.spark.sparkContext.broadcast((ids, labels, x))

    def _pass(self, lo: np.ndarray, hi: np.ndarray, need: np.ndarray, same: bool, shift: np.ndarray | None):
        """(function for mapInArrow, its broadcast): counts by digit where ``shift`` is given, else the best rows themselves."""
        held, asked = self.held, self.spark.sparkContext.broadcast((lo, hi, need, shift))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (ids, labels, queries), (lo, hi, need, shift) = held.value, asked.value
            slots = lo.shape[1]
            # below its floor a window needs no more rows; an empty window needs none
            floor = np.where((lo <= hi) & (need > 0), lo, NEVER)
            flat_hi, flat_need = hi.ravel(), need.ravel()
            flat_shift = None if shift is None else shift.ravel()
            z = np.zeros(0, np.int64)
            window, key, count, owner = z, z, z, z
            for whole in batches:
                for at in range(0, len(whole), CANDIDATES):
                    b = whole.slice(at, CANDIDATES)
                    x, own, label = _matrix(b.column("v")), b.column("id").to_numpy(), b.column("label").to_numpy()
                    news = []
                    for a in range(0, len(ids), ANCHORS):
                        least = floor[a : a + ANCHORS].min(axis=1)
                        live = np.flatnonzero(least < NEVER)
                        if not len(live):
                            continue
                        score = products(queries[a + live], x)
                        near = score >= least[live, None]
                        near &= (label == labels[a + live, None]) == same
                        if same:
                            near &= own != ids[a + live, None]
                        i, j = np.nonzero(near)
                        s, i = score[i, j].astype(np.int64), a + live[i]
                        for p in range(slots):
                            k = np.flatnonzero((s >= floor[i, p]) & (s <= hi[i, p]))
                            news.append((i[k] * slots + p, s[k], own[j[k]]))
                    if not news or not sum(len(w) for w, _, _ in news):
                        continue
                    w, s, o = (np.concatenate(c) for c in zip(*news))
                    if flat_shift is None:
                        window, key, owner = np.append(window, w), np.append(key, -s), np.append(owner, o)
                        kept = leading(window, [key, owner], np.ones(len(window), np.int64), flat_need)
                        window, key, owner = window[kept], key[kept], owner[kept]
                        full, worst = np.bincount(window, minlength=len(flat_need)), window
                        last = np.append(window[1:] != window[:-1], True)
                        done = last & (full[window] >= flat_need[window])
                        floor.ravel()[worst[done]] = np.maximum(floor.ravel()[worst[done]], -key[done])
                    else:
                        d = (flat_hi[w] - s) >> flat_shift[w]
                        window, key, count = np.append(window, w), np.append(key, d), np.append(count, np.ones(len(w), np.int64))
                        code, inverse = np.unique((window << DIGIT_BITS) | key, return_inverse=True)
                        window, key, count = code >> DIGIT_BITS, code & ((1 << DIGIT_BITS) - 1), np.bincount(inverse, weights=count).astype(np.int64)
                        kept = leading(window, [key], count, flat_need)
                        window, key, count = window[kept], key[kept], count[kept]
                        total = np.bincount(window, weights=count, minlength=len(flat_need))
                        done = np.append(window[1:] != window[:-1], True) & (total[window] >= flat_need[window])
                        lowest = flat_hi[window[done]] - ((key[done] + 1) << flat_shift[window[done]]) + 1
                        floor.ravel()[window[done]] = np.maximum(floor.ravel()[window[done]], lowest)
            if len(window):
                out = (window, key, count) if flat_shift is not None else (window, -key, owner)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["w", "key", "n"])

        return run, asked

    def best(self, lo: np.ndarray, hi: np.ndarray, k: int, same: bool) -> DataFrame:
        """(w, key, n, rank): window number, score, id and place of the k best rows of each window, written. same: of the anchor's label, or of others."""
        need, top = np.where(lo <= hi, k, 0), hi.copy()
        least = lo.copy()  # rows of a window at or above it are gathered
        lo, hi = lo.copy(), hi.copy()
        while (need > 0).any():
            width = np.where(need > 0, hi - lo, 0)
            shift = np.maximum(np.frompyfunc(lambda v: int(v).bit_length(), 1, 1)(width).astype(np.int64) - DIGIT_BITS, 0)
            run, asked = self._pass(lo, hi, need, same, shift)
            counts = self.rows.mapInArrow(run, "w long, key long, n long").groupBy("w", "key").agg(F.sum("n").alias("n"))
            # of each window the bucket with the kth row, and how many rows come before it
            along = Window.partitionBy("w").orderBy("key")
            upto = counts.withColumn("upto", F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
            wanted = self.spark.createDataFrame(pa.table({"w": pa.array(np.arange(need.size)), "need": pa.array(need.ravel())}), "w long, need long").where("need > 0")
            # one row a window of this block
            found = upto.join(wanted, "w").where("upto >= need and upto - n < need").select("w", "key", (F.col("upto") - F.col("n")).alias("before")).toArrow()
            asked.destroy()
            w, key, before = (found.column(c).to_numpy() for c in ("w", "key", "before"))
            flat_lo, flat_hi, flat_need, flat_shift, flat_least = (a.ravel() for a in (lo, hi, need, shift, least))
            left = flat_need[w] - before
            ends = flat_hi[w] - (key << flat_shift[w])
            flat_need[:] = 0  # a window with fewer rows than it needs is gathered whole
            flat_hi[w], flat_lo[w] = ends, np.maximum(flat_lo[w], ends - (np.int64(1) << flat_shift[w]) + 1)
            flat_least[w] = flat_lo[w]
            flat_need[w] = np.where(flat_lo[w] < flat_hi[w], left, 0)
        run, asked = self._pass(least, top, np.where(least <= top, k, 0), same, None)
        rows = self.rows.mapInArrow(run, "w long, key long, n long")
        got = rows.withColumn("rank", F.row_number().over(Window.partitionBy("w").orderBy(F.desc("key"), "n"))).where(F.col("rank") <= k)
        got = materialize(got, "best")
        asked.destroy()
        return got

    def close(self) -> None:
        self.held.destroy()


def _share(score: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """percent % of whole numbers, rounded up or down, without leaving 64 bits."""
    whole, rest = score // 100, score % 100
    return whole * percent + (-(-(rest * percent) // 100) if up else rest * percent // 100)


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: float = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its best rows of the same label,
    the best rows of other labels that score from ``low`` to ``high`` percent of what the positive does."""
    spark = vectors.sparkSession
    label = F.col(label_col)
    whole = isinstance(vectors.schema[label_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(label.isNotNull(), label.cast("long") if whole else F.xxhash64(label)).alias("label"), F.col(vector_col).cast("array<double>").alias("v"), is_anchor.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    # every pass over all candidates reads this table
    table = materialize(rows.select("id", "label", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"), F.coalesce("q", F.lit(False)).alias("q")), "vectors")
    asked = table.where("q").groupBy("id").agg(F.min(F.struct("v", "label")).alias("m"))
    asked, n = written(asked.select("id", "m.v", "m.label", F.pmod(F.xxhash64("id"), F.lit(1 << 20)).alias("block")), "anchors")
    largest = table.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()[0]
    done = []
    blocks = -(-n // ANCHOR_BLOCK)
    for block in range(blocks):
        part = asked.where((F.col("block") >= block * (1 << 20) // blocks) & (F.col("block") < (block + 1) * (1 << 20) // blocks)).orderBy("id").toArrow()
        ids, x = part.column("id").to_numpy(), _matrix(part.column("v").combine_chunks())
        search = _Search(table.select("id", "label", "v"), ids, part.column("label").to_numpy(), x)
        # no inner product is larger than the product of both lengths
        bound = np.ceil(np.sqrt((x * x).sum(axis=1)) * largest * 1.000001).astype(np.int64)[:, None] + 1
        near = search.best(-bound, bound, positives, True)
        best = near.orderBy("w", "rank").toArrow()  # at most ``positives`` rows for each anchor of this block
        anchor, slot = best.column("w").to_numpy(), best.column("rank").to_numpy() - 1
        lo, hi = np.ones((len(ids), positives), np.int64), np.zeros((len(ids), positives), np.int64)
        score = best.column("key").to_numpy()
        lo[anchor, slot], hi[anchor, slot] = _share(score, low, True), _share(score, high, False)
        far = search.best(lo, hi, negatives, False)
        pairs = pa.table({"w": pa.array(anchor * positives + slot), "anchor_id": pa.array(ids[anchor]), "positive_id": best.column("n"), "positive_score": best.column("key")})
        pairs = spark.createDataFrame(pairs, "w long, anchor_id long, positive_id long, positive_score long")
        done.append(far.join(pairs, "w").select("anchor_id", "positive_id", "rank", F.col("n").alias("negative_id"), "positive_score", F.col("key").alias("negative_score")))
        if blocks > 1:
            done[-1] = materialize(done[-1], "mined")
            release(far)
        release(near)
        search.close()
    release(table, asked)
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def op11_hard_negative_mining(spark, sf_dir: str) -> DataFrame:
    """Hard negatives for the five positives of every vector whose id is divisible by 50; every seventh label is moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
