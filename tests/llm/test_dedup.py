import random
from collections import Counter

import numpy as np
import pytest

from chronoweave.llm import _graph, _words, embedding_dedup, minhash, topk

from .conftest import prose


def roots(n, edges):
    up = {i: i for i in n}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {i: top(i) for i in n}


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(900, i) for i in range(500, 600)] + [(7, 7)]
    want = roots({x for e in edges if e[0] != e[1] for x in e}, edges)
    got = {x.id: x.component for x in _graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b")[0].collect()}
    assert got == want
    none, n = _graph.components(spark.createDataFrame([], "a long, b long"), "a", "b")
    assert none.count() == n == 0


def bag(text):
    w = text.lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    both = sum((a & b).values())
    return both / max(1, sum((a | b).values())) if both else 0.0


def test_word_and_shingle_hashes_tell_texts_apart():
    texts = ["A b  c", "a b c", "ab c", "a bc", "a b c d e f", "a b c d e", "b c d e f", ""]
    import pyarrow as pa

    from chronoweave.llm._common import utf8

    data, offs = utf8(pa.array(texts))
    doc, s, e = _words.words(data, offs)
    assert np.bincount(doc, minlength=8).tolist() == [3, 3, 2, 2, 6, 5, 5, 0]
    h = _words.hash_runs(data, s, e)
    d, v = _words.shingles(doc, h, 5)
    own = {i: set(v[d == i].tolist()) for i in range(8)}
    assert own[0] == own[1] and len(own[4]) == 2 and own[5] < own[4] and own[6] < own[4] and not own[7]
    assert not own[2] & own[3] and not own[1] & own[4]


@pytest.mark.parametrize("top", [1, 9, 700])
def test_signatures_are_unbiased(top):
    rng = np.random.default_rng(top)
    a = rng.integers(1, top + 1, 200)
    b = np.maximum(0, a + rng.integers(-top // 3 - 1, top // 3 + 2, 200))
    b[:20] = 0
    v = rng.integers(0, 2**53, 200).astype(np.uint64)
    doc = np.repeat([0, 1], [200, (b > 0).sum()])
    sig = minhash.signatures(doc, np.append(v, v[b > 0]), np.append(a, b[b > 0]), 2, 6000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / 6000) + 1e-9


def test_bands_miss_few_pairs_at_the_threshold():
    n, missed = 2_000, 0
    bands, rows = minhash.BANDS, minhash.ROWS
    for lot in range(15):
        # 8 shared shingles of 10: a similarity of 0.8
        value = np.random.default_rng(lot).integers(0, 2**53, (n, 10)).astype(np.uint64)
        both = np.concatenate([value[:, :9], value[:, 1:]])
        sig = minhash.signatures(np.repeat(np.arange(2 * n), 9), both.ravel(), np.ones(18 * n, np.int64), 2 * n, bands * rows).reshape(2, n, bands, rows)
        missed += int((~(sig[0] == sig[1]).all(axis=2).any(axis=1)).sum())
    assert missed <= 5  # of 30,000; 25 bands of 5 miss 1.5 on average, 20 miss 11


def variants():
    """Groups of edits at many distances, with repeated passages, so that multiset counts matter."""
    r, rows = random.Random(5), []
    for g in range(12):
        base = prose(100 + g, 120).split()
        if g % 3 == 0:
            base += base[:40]
        for k in range(7):
            w = list(base)
            for _ in range(k % 5):
                w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
            if k == 5:
                w += base[:30]
            rows.append(" ".join(w))
    hot = prose(999, 200).split()
    for k in range(60):
        w = list(hot)
        for _ in range(1 + k % 4):
            w[r.randrange(len(w))] = f"hot{r.randrange(10**6)}"
        rows.append(" ".join(w))
    return [(i, t) for i, t in enumerate(rows + rows[:5] + ["one two", "One  two", "three"])]


def test_near_duplicates_equal_brute_force(spark):
    docs = variants()
    got = {r.id: r for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    bags = {i: bag(t) for i, t in docs}
    links = [(i, j) for i in bags for j in bags if i < j and jaccard(bags[i], bags[j]) >= 0.8]
    want = roots(list(bags), links)
    assert {i: r.component_id for i, r in got.items()} == want
    for i, t in docs:
        assert got[i].class_id == min(j for j, u in docs if u.lower().split() == t.lower().split())
        assert got[i].kept == (want[i] == i)
    # blocks alone find the same components
    small = minhash.SMALL_BUCKET, minhash.BLOCK
    try:
        minhash.SMALL_BUCKET, minhash.BLOCK = 1, 8
        again = {r.id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    finally:
        minhash.SMALL_BUCKET, minhash.BLOCK = small
    assert again == want


def test_minhash_odd_rows(spark, odd_docs, no_docs):
    got = sorted(((r.id, r.class_id, r.component_id, r.kept) for r in minhash.near_duplicates(odd_docs).collect()), key=str)
    assert len(got) == 14
    assert [g for g in got if g[0] == 1] == [(1, 1, 1, True)] * 2
    assert sorted(g for g in got if g[0] == 2) == [(2, 1, 1, False), (2, 2, 2, True)]
    assert [g for g in got if g[0] is None] == [(None, None, None, True)] * 2
    assert all(g[3] for g in got if g[0] in (3, 4, 5, 9))
    kept = minhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and ids[None] == 2 and ids[3] == 1
    assert minhash.near_duplicates(no_docs).count() == 0 and minhash.drop_near_duplicates(no_docs).count() == 0


def test_drop_keeps_a_defined_row(spark):
    rows = [(1, "b", prose(1)), (1, "a", prose(1)), (2, "c", prose(2)), (2, "c", prose(3)), (5, "d", prose(1)), (6, "e", "Few words")]
    docs = spark.createDataFrame(rows, "id long, copies string, text string").repartition(3)
    got = sorted((r.id, r.copies, r.text) for r in minhash.drop_near_duplicates(docs, id_col="id").collect())
    assert got == sorted([(1, "a", prose(1)), (2, "c", prose(2)), (2, "c", prose(3)), (6, "e", "Few words")])


def cosine_links(rows):
    x = np.array([v for _, v, _ in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([l for _, _, l in rows])
    return (x @ x.T >= 0.98) & (label[:, None] == label[None, :]) & ~np.eye(len(rows), dtype=bool)


def test_embedding_recall_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows, base = [], rng.standard_normal((40, 32))
    for i in range(1500):
        v = base[i % 40] + rng.standard_normal(32) * (0.08 if i % 3 else 1.0)
        rows.append((i, v.astype(np.float32).tolist(), i % 40 % 3))
    rows += [(2000 + i, rows[1][1], rows[1][2]) for i in range(30)]
    want = cosine_links(rows)
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4), leaf=60, fit_rows=800).collect()
    links = {r.id: r.n_links for r in got}
    found = sum(links.values())
    assert found <= want.sum() and found >= 0.97 * want.sum()
    true = roots([r[0] for r in rows], [(rows[i][0], rows[j][0]) for i, j in zip(*np.nonzero(np.triu(want)))])
    same = sum(r.component_id == true[r.id] for r in got)
    assert same >= 0.99 * len(rows)
    # blocks within leaves, and strips of them, change nothing
    size = embedding_dedup.BLOCK, embedding_dedup.STRIP
    try:
        embedding_dedup.BLOCK, embedding_dedup.STRIP = 17, 5
        again = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), leaf=60, fit_rows=800).collect()
    finally:
        embedding_dedup.BLOCK, embedding_dedup.STRIP = size
    assert {r.id: (r.n_links, r.component_id) for r in again} == {r.id: (r.n_links, r.component_id) for r in got}


def test_the_querys_own_trees_cut_and_miss_nothing(spark):
    """With the query's parameters: trees cut the tables at hand, and leaves of copies, chains and noise hold every link."""
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas()
    x = embedding_dedup._unit(np.stack(table.embedding.to_numpy()).astype(np.float64))
    forest = embedding_dedup.fit_forest(x, table.label.to_numpy(), embedding_dedup.TREES, embedding_dedup.LEAF, embedding_dedup.THRESHOLD, 7)
    assert len(forest.trees) == embedding_dedup.TREES and all(len(t.cut) >= 5 for t in forest.trees)
    rng = np.random.default_rng(6)
    base = rng.standard_normal((700, 64))
    near = base[rng.integers(0, 700, 1500)] + 0.19 * rng.standard_normal((1500, 64)) * rng.random((1500, 1))
    chain = base[0] + np.cumsum(0.12 * rng.standard_normal((60, 64)), axis=0)
    rows = [(i, v.astype(np.float32).tolist(), i % 2) for i, v in enumerate(np.concatenate([base, near, chain, np.repeat(base[5:6], 400, axis=0) + 0.01 * rng.standard_normal((400, 64))]))]
    want = cosine_links(rows)
    assert 1500 < want.sum() < want.size / 4
    for branch in (embedding_dedup.BRANCH, 300):  # one branch a label, or several a tree
        got = {r.id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4), branch=branch).collect()}
        found = sum(r.n_links for r in got.values())
        assert 0.998 * want.sum() <= found <= want.sum()
        assert all(got[i].n_links <= n for i, n in enumerate(want.sum(axis=1)))


def test_compare_is_exact_and_spans():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 8))
    x[100:200] = x[:100] + 0.14 * rng.standard_normal((100, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, weight = np.arange(1000, 1300), rng.integers(1, 4, 300)
    shared = rng.random(300) < 0.3  # these share an earlier leaf
    for side in (np.zeros(300, np.int64), rng.integers(0, 2, 300)):
        linked = x @ x.T >= 0.95
        np.fill_diagonal(linked, False)
        linked &= ~(shared[:, None] & shared[None, :])
        if side.any():
            linked &= side[:, None] != side[None, :]
        count, edges = embedding_dedup.compare(ids, weight, x, side, lambda: (np.flatnonzero(shared), np.full(shared.sum(), 7)), 0.95)
        assert count.tolist() == (linked @ weight).tolist() and count.any()
        assert all(linked[a - 1000, b - 1000] for a, b in edges)
        n = list(range(300))
        assert roots(n, [(a - 1000, b - 1000) for a, b in edges]) == roots(n, list(zip(*np.nonzero(linked))))
        assert len(edges) == 300 - len(set(roots(n, list(zip(*np.nonzero(linked)))).values()))


def test_vectors_odd_rows(spark, odd_vectors):
    got = {(r.id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(odd_vectors).collect()}
    assert (50, 3, 1, False) in got and (2, 3, 1, False) in got and (1, 3, 1, True) in got
    assert {(3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (10, 0, 10, True), (None, 0, None, True)} <= got
    assert (9, 1, 9, True) in got or (9, 0, 9, True) in got
    assert embedding_dedup.near_duplicates(odd_vectors.limit(0)).count() == 0


def test_top_k_equals_brute_force(spark, odd_vectors):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    x = np.round(rng.standard_normal((400, 16)), 1).astype(np.float32)
    x[100:140] = x[7]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)
    old = topk.QUERY_BLOCK, topk.RUN
    try:
        topk.QUERY_BLOCK, topk.RUN = 2, 7
        got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, pivots=6).collect())
    finally:
        topk.QUERY_BLOCK, topk.RUN = old
    y = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    want = []
    for q in range(0, 400, 20):
        s = y @ y[q]
        order = [i for i in np.lexsort((np.arange(400), -s)) if i != q][:5]
        want += [(q, n + 1, int(i), int(s[i])) for n, i in enumerate(order)]
    assert got == sorted(want)
    odd = sorted(tuple(r) for r in topk.top_k(odd_vectors, F.col("vec_id") % 50 == 0).collect())
    assert [r for r in odd if r[0] == 50] == [(50, 1, 2, 131072), (50, 2, 1, 65536), (50, 3, 1, 65536), (50, 4, 3, 65536), (50, 5, 5, 0)]
    assert topk.top_k(odd_vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0
