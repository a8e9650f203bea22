"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

1. Equal vectors of a label form a class, named by its smallest id; only classes go on, with their number of rows.
2. ``TREES`` trees are fitted in one task on a bounded sample (``FIT_ROWS`` rows): a node projects its rows on a random direction
   and splits them at the median; rows within ``SPILL`` of it go to both sides, until no label has more than ``LEAF`` rows in a
   node. Every row is then sent down every tree. A branch is the highest node in which no label has more than ``BRANCH`` rows; where that is the
   root, all trees have the same branch. A vector moves once for each of its branches, not once for each leaf.
3. Rows of one label that share a branch meet in one task, which compares those that share a leaf, strip by strip: products in single
   precision, and again in double precision where they come close to the threshold. A branch that overlap or copies keep from
   shrinking is cut into blocks; each pair of blocks is a task. A pair is counted in the first leaf that it shares only, which each task
   tells from the leaves of both rows, so counts need no list of pairs. Tasks emit, for each row, its number of links, and a
   spanning forest of the links: output grows with rows, not with pairs (and with blocks, where a dense cluster has several).
4. Links are summed, forests united into components, and both go back to all rows.

Recall is measured against brute force in the tests. Every link was verified; a link is missed only if no tree brings its ends
into one leaf. A sample of ``fit_rows`` can tell some fit_rows / 8 leaves apart: with more rows than that times ``leaf`` (a million) leaves
grow with the input unless it is raised.

Nulls, ties: vectors that are null, zero, or hold a null or non-finite component, rows without label, and rows with a null id link with nothing and are their own
component. Rows that repeat one id are different copies to the others, but one vertex: a repeated id's rows all carry the same component. Vectors of different length count as padded with
zeros. No rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import by_size, fitted, materialize, release, unit, written
from ._graph import components
from .topk import _matrix, _pad, usable

THRESHOLD = 0.98
TREES = 6
#: Half the width of the overlap, in units of the spread that a just similar pair has along a direction.
SPILL = 0.8
#: Bounded sample that the trees are fitted on.
FIT_ROWS = 200_000
#: Rows of one label that a leaf and a branch are meant to hold; a branch of more than two blocks is cut into blocks of so many rows.
LEAF = 60
BRANCH = BLOCK = 6000
#: Rows compared with all of a leaf at once.
STRIP = 1000
#: Large branches that a broadcast may list.
BROADCAST_LEAVES = 500_000
#: A cut is made if both sides are smaller than this share of a node; a dense cluster stays whole.
SHRINK = 0.75
#: Directions that a node tries before it stays a leaf.
TRIES = 3


@dataclass
class Tree:
    """Directions, which the nodes of a level share. Node i: its direction, threshold, children; a child below 0 is leaf -1 - child.

    branch: the branch of each leaf, numbered from 1 on; 0 is the root's.
    """

    direction: np.ndarray
    level: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    branch: np.ndarray

    def leaves_of(self, x: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all rows; a row in an overlap has several leaves."""
        if not len(self.cut):
            return np.arange(len(x)), np.zeros(len(x), np.int64)
        at = x @ self.direction.T
        rows, nodes = np.arange(len(x)), np.zeros(len(x), np.int64)
        out_row, out_leaf = [], []
        while len(rows):
            p = at[rows, self.level[nodes]] - self.cut[nodes]
            lo, hi = p < spill, p >= -spill
            rows, nodes = np.concatenate([rows[lo], rows[hi]]), np.concatenate([self.left[nodes[lo]], self.right[nodes[hi]]])
            end = nodes < 0
            out_row.append(rows[end])
            out_leaf.append(-1 - nodes[end])
            rows, nodes = rows[~end], nodes[~end]
        return np.concatenate(out_row), np.concatenate(out_leaf)


def fit_tree(x: np.ndarray, label: np.ndarray, leaf: int, branch: int, spill: float, rng: np.random.Generator) -> Tree:
    """Random directions, median cuts, until no label has more than ``leaf`` rows in a node or the overlap no longer lets it shrink."""
    direction: list[np.ndarray] = []
    level, cut, left, right, owner, branches = [], [], [], [], [], 0
    todo = [(np.arange(len(x)), 0, None, 0, None)]
    while todo:
        rows, depth, parent, side, inside = todo.pop()
        most, at = int(np.bincount(label[rows]).max(initial=0)), None
        if inside is None and most <= branch:
            branches += parent is not None
            inside = branches if parent is not None else 0
        if most > leaf:
            for k in range(depth, depth + TRIES):
                if k == len(direction):
                    d = rng.standard_normal(x.shape[1])
                    direction.append(d / np.linalg.norm(d))
                p = x[rows] @ direction[k]
                c = float(np.median(p))
                lo, hi = rows[p < c + spill], rows[p >= c - spill]
                if max(len(lo), len(hi)) < SHRINK * len(rows):
                    at = len(cut)
                    level.append(k)
                    cut.append(c)
                    left.append(0)
                    right.append(0)
                    todo += [(lo, k + 1, at, 0, inside), (hi, k + 1, at, 1, inside)]
                    break
        if at is None:
            if inside is None:  # a leaf too large for a branch is one
                branches += parent is not None
                inside = branches if parent is not None else 0
            owner.append(inside)
            at = -len(owner)
        if parent is not None:
            (right if side else left)[parent] = at
    ints = [np.array(a, np.int64) for a in (level, left, right, owner)]
    return Tree(np.array(direction).reshape(len(direction), x.shape[1]), ints[0], np.array(cut), ints[1], ints[2], ints[3])


@dataclass
class Forest:
    """Trees, the first number of each one's leaves, the branch of each leaf over all trees, the vectors' width and half the overlap."""

    trees: list[Tree]
    first: np.ndarray
    branch: np.ndarray
    width: int
    spill: float

    def leaves_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) in order, leaves numbered over all trees."""
        x = _pad(x, self.width)[:, : self.width]
        got = [t.leaves_of(x, self.spill) for t in self.trees]
        row = np.concatenate([r for r, _ in got])
        leaf = np.concatenate([k + f for (_, k), f in zip(got, self.first)])
        order = np.lexsort((leaf, row))
        return row[order], leaf[order]


def fit_forest(x: np.ndarray, label: np.ndarray, trees: int, leaf: int, threshold: float, seed: int, branch: int = BRANCH) -> Forest:
    width = x.shape[1]
    spill = SPILL * np.sqrt(2 * (1 - threshold)) / np.sqrt(max(width, 1))
    rng = np.random.default_rng(seed)
    forest = [fit_tree(x, label, leaf, branch, spill, rng) for _ in range(trees)]
    if not any(len(t.cut) for t in forest):
        forest = forest[:1]  # all have one and the same leaf
    past = np.cumsum([0, *[int(t.branch.max(initial=0)) for t in forest]])
    numbered = [np.where(t.branch > 0, t.branch + p, 0) for t, p in zip(forest, past)]
    return Forest(forest, np.cumsum([0, *[len(t.branch) for t in forest]]), np.concatenate(numbered), width, spill)


def compare(ids: np.ndarray, weight: np.ndarray, x: np.ndarray, side: np.ndarray, early: Callable[[], tuple[np.ndarray, np.ndarray]], threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Number of links of each row (a link to a row counts its weight) and spanning links among rows of one leaf, or of two blocks of it.

    early: gives (row, leaf) for each leaf before this one; pairs that share such a leaf are counted there.
    """
    n = len(ids)
    two = bool(side.any())
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if two else (np.arange(n), np.arange(n))
    single = x.astype(np.float32)
    doubt = 4 * (x.shape[1] + 8) * 2.0**-24  # more than what single precision may be off by
    known: list = []

    def before(rows: np.ndarray) -> np.ndarray:
        if not known:
            owner, leaf = early()
            names, column = np.unique(leaf, return_inverse=True)
            order = np.argsort(owner, kind="stable")
            known.extend((names, column[order], np.searchsorted(owner[order], np.arange(n + 1))))
        names, column, ends = known
        size = ends[rows + 1] - ends[rows]
        own = np.zeros((len(rows), len(names)), np.float32)
        own[np.repeat(np.arange(len(rows)), size), column[np.repeat(ends[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())]] = 1
        return own

    count, part, edges = np.zeros(n, np.int64), np.arange(n), []
    for at in range(0, len(left), STRIP):
        rows = left[at : at + STRIP]
        product = single[rows] @ single[right].T
        near = product >= threshold - doubt
        if not two:
            near[np.arange(len(rows)), rows] = False
        i, j = np.nonzero(near & (product < threshold + doubt))
        near[i, j] = np.einsum("ij,ij->i", x[rows[i]], x[right[j]]) >= threshold
        has, met = near.any(axis=1), near.any(axis=0)
        if not has.any():
            continue
        a, b, near = rows[has], right[met], near[np.ix_(has, met)]
        near &= before(a) @ before(b).T == 0
        count[a] += near @ weight[b]
        if two:
            count[b] += weight[a] @ near
        for k in np.flatnonzero(near.any(axis=1)):
            mine = part[a[k]]
            others = b[near[k]]
            others = others[part[others] != mine]
            if len(others):
                parts, first = np.unique(part[others], return_index=True)
                edges += [(int(ids[a[k]]), int(ids[o])) for o in others[first]]
                part[np.isin(part, parts)] = mine
    return count, edges


def leaf_by_leaf(ids: np.ndarray, weight: np.ndarray, x: np.ndarray, side: np.ndarray, ends: np.ndarray, leaves: np.ndarray, here: np.ndarray, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """``compare`` for each leaf of a branch. Row i has leaves[ends[i] : ends[i + 1]]; ``here`` marks those of this branch."""
    owner = np.repeat(np.arange(len(ids)), np.diff(ends))
    order = np.lexsort((owner[here], leaves[here]))
    row, leaf = owner[here][order], leaves[here][order]
    cuts = np.append(np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1])), len(leaf))
    count, edges, two = np.zeros(len(ids), np.int64), [], bool(side.any())
    for a, b in zip(cuts, cuts[1:]):
        rows = row[a:b]
        if b - a < 2 or two and len(np.unique(side[rows])) < 2:
            continue

        def early(rows=rows, mine=leaf[a]):
            size = ends[rows + 1] - ends[rows]
            at = np.repeat(ends[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
            old = leaves[at] < mine
            return np.repeat(np.arange(len(rows)), size)[old], leaves[at][old]

        n, found = compare(ids[rows], weight[rows], x[rows], side[rows], early, threshold)
        count[rows] += n
        edges += found
    return count, edges


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, branch: int = BRANCH, fit_rows: int = FIT_ROWS, seed: int = 7) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    # floats move as floats, half the bytes, and become doubles in the tasks, which changes no value
    given = vectors.schema[vector_col].dataType
    number = "float" if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else "double"
    v = F.col(vector_col).cast(f"array<{number}>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.col(label_col).alias("label"))
    fit_for = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")) & F.exists("v", lambda x: x != 0)
    # -0.0 and 0.0 are one value; two hashes name a vector
    rows = rows.withColumn("ok", F.coalesce(fit_for, F.lit(False))).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0).cast(number)))
    hashed = rows.select("id", "v", "label", "ok", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    names = ["label", "h1", "h2"]
    classes, n = written(hashed.where("ok").groupBy(*names).agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.min_by("v", "id").alias("v")), "classes")
    share = min(1.0, fit_rows / max(n, 1))
    some = classes.where(unit(F.xxhash64("h1", "h2")) <= share).select("v", *names)

    def learn(found: pa.Table) -> Forest:
        found = found.sort_by([("h1", "ascending"), ("h2", "ascending")]).combine_chunks()
        code = found.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        return fit_forest(_unit(_matrix(found.column("v").chunk(0))), code, trees, max(8, int(leaf * share)), threshold, seed, max(8, int(branch * share)))

    forest = fitted(some, learn) or fit_forest(np.zeros((0, 1)), np.zeros(0, np.int64), 1, leaf, threshold, seed)
    held = vectors.sparkSession.sparkContext.broadcast(forest)  # bounded by the sample

    def index(batches):
        for whole in batches:
            for at in range(0, len(whole), 2000):
                b = whole.slice(at, 2000)
                row, leaf = held.value.leaves_of(_unit(_matrix(b.column("v"))))
                own = np.unique(row * (int(held.value.branch.max()) + 1) + held.value.branch[leaf])
                lists = []
                for of, values in ((row, leaf), np.divmod(own, int(held.value.branch.max()) + 1)):
                    ends = np.append(0, np.cumsum(np.bincount(of, minlength=len(b)))).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32))))
                yield pa.RecordBatch.from_arrays([*b.columns, *lists], ["id", "label", "copies", "v", "leaves", "branches"])

    kind = classes.schema["label"].dataType.simpleString()
    indexed = materialize(classes.select("id", "label", "copies", "v").mapInArrow(index, f"id long, label {kind}, copies long, v array<{number}>, leaves array<int>, branches array<int>"), "leaves")
    size = indexed.select("label", F.explode("branches").alias("branch")).groupBy("label", "branch").count()
    large, n_large = written(size.where(F.col("count") > 2 * BLOCK).select("label", "branch", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large")
    member = indexed.select("id", "label", "copies", "v", "leaves", F.explode("branches").alias("branch"))
    if n_large:
        member = member.join(by_size(large, n_large, BROADCAST_LEAVES), ["label", "branch"], "left").withColumn("own", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int"))
        member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    else:
        member = member.withColumns({"own": F.lit(0), "other": F.lit(0)})
    tasks = member.select("id", "copies", "v", "leaves", "label", "branch", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"))

    def run(group: pa.Table) -> pa.Table:
        if len(group) < 2:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        group = group.combine_chunks()
        lists = group.column("leaves").chunk(0)
        leaves, ids = lists.flatten().to_numpy(), group.column("id").to_numpy()
        here = held.value.branch[leaves] == group.column("branch")[0].as_py()
        count, edges = leaf_by_leaf(ids, group.column("copies").to_numpy(), _unit(_matrix(group.column("v").chunk(0))), group.column("side").to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py(), leaves, here, threshold)
        linked = count > 0
        a = np.concatenate([ids[linked], np.array([e[0] for e in edges], np.int64)])
        b = pa.array([None] * int(linked.sum()) + [e[1] for e in edges], pa.int64())
        return pa.table({"a": pa.array(a), "b": b, "links": pa.array(np.concatenate([count[linked], np.zeros(len(edges), np.int64)]))})

    found = materialize(tasks.groupBy("label", "branch", "a", "b").applyInArrow(run, "a long, b long, links long"), "links")
    release(indexed, large)
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    united = components(found.where("b is not null"), "a", "b")[0].withColumnRenamed("id", "u")
    named = classes.select(*names, "id", "copies").join(links, F.col("id") == F.col("a"), "left").join(united, F.col("id") == F.col("u"), "left")
    # only classes with copies or links say more than the row itself
    named = named.where("copies > 1 or links is not null").select(*names, "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component"))
    named, n_named = written(named, "named")
    release(classes, found)
    out = hashed.select("id", *names, "ok").join(by_size(named, n_named, BROADCAST_LEAVES), names, "left")
    component = F.when(F.col("ok"), F.coalesce("component", "id")).otherwise(F.col("id"))
    return out.select(
        "id",
        F.when(F.col("ok"), F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled first, as squares of large components overflow
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 1e-300)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def op5_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


#: All pairs of a label, and the smallest id spread along the links until nothing changes.
ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(list_filter(embedding, lambda x: x IS NOT NULL), lambda x: CAST(x AS DOUBLE)) AS e,
    vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings
), u AS (
  SELECT r, vec_id, label, list_transform(e, lambda x: x / norm) AS e FROM (SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v WHERE ok)
), link AS (
  SELECT a.r, a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.r <> b.r WHERE list_inner_product(a.e, b.e) >= 0.98
), edge AS (SELECT DISTINCT a, b FROM link WHERE a <> b
), reach(id, least) USING KEY (id) AS (
  SELECT vec_id, vec_id FROM (SELECT DISTINCT vec_id FROM u)
  UNION
  SELECT e.b, min(r.least) FROM reach r JOIN edge e ON e.a = r.id JOIN recurring.reach o ON o.id = e.b GROUP BY e.b HAVING min(r.least) < min(o.least)
), n AS (SELECT r, count(*) AS n FROM link GROUP BY r)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, CASE WHEN ok THEN least ELSE vec_id END AS component_id,
  coalesce(vec_id = CASE WHEN ok THEN least ELSE vec_id END, TRUE) AS kept
FROM v LEFT JOIN n USING (r) LEFT JOIN reach ON reach.id = vec_id
"""
