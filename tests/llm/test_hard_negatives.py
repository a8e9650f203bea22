import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.llm import hard_negatives, whitening

SF = "/root/testdata/sf0.001"


def brute(rows, is_anchor, k=5, m=3, low=50, high=95):
    """Every anchor against every row, in Python's whole numbers."""
    rows = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, lab, v in sorted((r for r in rows if is_anchor(r[0])), key=lambda r: (r[0], r[2], r[1])):
        anchors.setdefault(i, (lab, v))
    out = []
    for a, (lab, v) in anchors.items():
        score = lambda w: sum(x * y for x, y in zip(v, w))
        best = sorted((-score(w), i) for i, lb, w in rows if lb == lab and i != a)[:k]
        for s, p in best:
            far = sorted((-score(w), i) for i, lb, w in rows if lb != lab and -low * s <= 100 * score(w) <= -high * s)[:m]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(far)]
    return sorted(out)


def mined(df, is_anchor, **more):
    got = hard_negatives.hard_negatives(df, is_anchor, **more)
    return sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_query_equals_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = db.execute(hard_negatives.ORACLE_SQL)
    columns = [d[0] for d in want.description]
    got = hard_negatives.op11_hard_negative_mining(spark, SF).select(*columns).collect()
    assert got and sorted(map(tuple, got)) == sorted(want.fetchall())


@pytest.mark.parametrize("block", [3, hard_negatives.ANCHOR_BLOCK])
def test_ties_hot_vectors_and_blocks(spark, monkeypatch, block):
    """A third of the rows are one vector, small whole numbers tie everywhere, and digits are narrow, so several rounds are needed."""
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", block)
    r = random.Random(5)
    rows = [(i, [r.randrange(-2, 6) / 4 for _ in range(4)] if i % 3 else [1.0, 0.5, 0.25, 0.0], r.randrange(3)) for i in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    assert mined(df, F.col("vec_id") % 20 == 0) == brute(rows, lambda i: i % 20 == 0)


def test_large_numbers_and_few_rows(spark):
    rows = [(i, [2.0**21 + i, -(2.0**20), float(i % 5)], i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    assert mined(df, F.col("vec_id") % 10 == 0, high=100) == brute(rows, lambda i: i % 10 == 0, high=100) != []
    rows = [(i, [2.0**21 * (1 + i % 7 / 8), float(i % 5)], i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    assert mined(df, F.col("vec_id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)
    alone = spark.createDataFrame(rows[:1], df.schema)
    assert mined(alone, F.col("vec_id") == 0) == []


def test_odd_rows(spark, odd_vectors):
    rows = [(r.vec_id, r.embedding, r.label) for r in odd_vectors.select("vec_id", "embedding", "label").collect()]
    pad = lambda v: v and v + [0.0] * (3 - len(v)) if v else [0.0] * 3 if v == [] else None
    got = mined(odd_vectors, F.col("vec_id") % 50 == 0, low=0, high=100)
    assert got and got == brute([(i, pad(v), lab) for i, v, lab in rows], lambda i: i % 50 == 0, low=0, high=100)
    assert mined(odd_vectors.where("false"), F.lit(True)) == []
    words = odd_vectors.withColumn("label", F.col("label").cast("string"))
    assert mined(words, F.col("vec_id") % 50 == 0, low=0, high=100) == got


def test_digits_settle_a_window(spark, monkeypatch):
    """Rounds of two bits find the same rows as one of twelve."""
    monkeypatch.setattr(hard_negatives, "DIGIT_BITS", 2)
    r = np.random.default_rng(3)
    rows = [(i, r.standard_normal(8).tolist(), i % 4) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    assert mined(df, F.col("vec_id") % 30 == 0) == brute(rows, lambda i: i % 30 == 0)


# whitening


def plain(vectors):
    x = np.array([[math.floor(256 * c) for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (fit * n - s) / n
    e, a = np.linalg.eigh(c.T @ c / n)
    e, a = e[::-1], a[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), ((n * x - s) / n) @ a[:, :4] / np.sqrt(e[:4]), e[:4] / e.sum()


def test_whitening_query(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").toPandas()
    n, deviation, w, explained = plain(given.embedding)
    got = whitening.op13_embedding_whitening(spark, SF).orderBy("vec_id", "component").toPandas()
    assert got.vec_id.tolist() == np.repeat(given.vec_id, 4).tolist() and got.component.tolist() == [1, 2, 3, 4] * len(given)
    assert (got.n == n).all() and got.deviation.tolist() == np.repeat(deviation, 4).tolist()
    mine = got.whitened.to_numpy().reshape(-1, 4)
    assert np.allclose(mine * np.sign((mine * w).sum(axis=0)), w, atol=1e-6)
    assert np.allclose(got.explained.to_numpy().reshape(-1, 4), explained, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_repeated_vectors_count_once_in_the_fit(spark):
    r = np.random.default_rng(1)
    some = r.standard_normal((50, 3)).tolist()
    rows = [(i, v) for i, v in enumerate(some + [some[0]] * 70)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    model = whitening.fit(df)
    assert model.n == 50 and len(model.values) == 3 and model.identity_error < 1e-9
    got = whitening.whiten(df, model).orderBy("id").toPandas()
    n, deviation, _, _ = plain(np.array([v for _, v in rows], np.float32).astype(float))
    assert n == 50 and got.deviation.tolist() == deviation.tolist()
    whole = np.stack(got.whitened)[:50]
    assert np.allclose(whole.T @ whole / 50, np.eye(3), atol=1e-9)


def test_whitening_of_large_numbers_is_exact(spark):
    rows = [(i, [2.0**41 + i, -(2.0**40), 3.0 * (i % 3)]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(df)
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    want = [sum((6 * a - b) ** 2 for a, b in zip(v, s)) for v in x]
    got = whitening.whiten(df, model).orderBy("id").collect()
    assert [g.deviation for g in got] == want
    assert len(model.values) == 2  # the second entry never varies


def test_whitening_of_odd_rows(spark, odd_vectors):
    model = whitening.fit(odd_vectors)
    got = whitening.whiten(odd_vectors, model).collect()
    usable = [r for r in odd_vectors.collect() if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)]
    assert len(got) == len(usable) and None in {g.id for g in got}
    assert model.n == len({tuple((r.embedding + [0.0] * 3)[:3]) for r in usable})
    assert whitening.fit(odd_vectors.where("false")) is None
    assert whitening.fit(odd_vectors.where("vec_id = 1")) is None  # one distinct vector has no variance
    assert whitening.fit(odd_vectors.where("vec_id = 10")) is None
