import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from chronoweave.llm import substring_dedup

from .conftest import prose

SF = "/root/testdata/sf0.001"


def brute(docs, width=20):
    """(id, n_words, removed words, what is left) of documents in order, window by window."""
    seen, out = set(), []
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for at in range(len(w) - width + 1):
            window = tuple(w[at : at + width])
            if window in seen:
                gone |= set(range(at, at + width))
            seen.add(window)
        out.append((i, len(w), sorted(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def cut(df, **more):
    rows = substring_dedup.remove_repeats(df, **more).collect()
    return sorted(((r.id, r.n_words, [k for run in r.removed for k in range(run.begin, run.end)], r.text) for r in rows), key=str), rows


def test_query_equals_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = db.execute(substring_dedup.ORACLE_SQL)
    columns = [d[0] for d in want.description]
    got = substring_dedup.op12_substring_dedup(spark, SF).select(*columns).collect()
    assert sum(r.n_removed for r in got) and sorted(map(tuple, got)) == sorted(want.fetchall())


@pytest.mark.parametrize("block_bytes", [2_000, 16_000_000])
def test_passages_copies_and_odd_white_space(spark, block_bytes):
    """Passages that texts share, copies by the dozen, repeats inside a text; in one block or many."""
    r = random.Random(2)
    passages = [prose(100 + i, 30) for i in range(4)]
    texts = []
    for i in range(90):
        parts = [prose(i, r.randrange(0, 60)), r.choice(passages), prose(500 + i, 5), r.choice(passages) if i % 3 else "é" * 30]
        texts.append(r.choice(["  ", "\n", " \t"]).join(parts))
    texts += [texts[7]] * 25 + ["one two " * 40, "a" * 5000, "x " * 19, "x " * 20, "x " * 21, "  　" * 30, "wörd ß 😀 " * 10]
    r.shuffle(texts)
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got, rows = cut(df, block_bytes=block_bytes)
    assert got == sorted(brute(docs), key=str)
    assert all(a.end < b.begin for x in rows for a, b in zip(x.removed, x.removed[1:]))  # maximal: runs neither overlap nor touch


def test_odd_rows(spark, odd_docs, no_docs):
    got, _ = cut(odd_docs)
    by_id = {}
    for i, n, gone, text in got:
        by_id.setdefault(i, []).append((n, len(gone), text))
    assert len(got) == odd_docs.count()
    # of equal rows one stays, as does the first of the ids that share a text; a null id comes last
    assert sorted(g for _, g, _ in by_id[1]) == [0, 60] and 60 in [g for _, g, _ in by_id[2]]
    assert sorted(by_id[None]) == [(0, 0, ""), (60, 0, prose(3))]
    assert by_id[3] == by_id[4] == by_id[5] == by_id[9] == [(0, 0, "")]
    assert by_id[6] == [(1, 0, "x" * 300_000)] and by_id[7] == [(40_000, 39_999, "wörd")]
    assert cut(no_docs)[0] == []


def test_a_null_id_comes_after_all_others(spark):
    df = spark.createDataFrame([(None, prose(1)), (5, prose(1)), (7, "short")], "doc_id long, text string").repartition(3)
    for block_bytes in (100, 16_000_000):
        got = {i: len(gone) for i, _, gone, _ in cut(df, block_bytes=block_bytes)[0]}
        assert got == {None: 60, 5: 0, 7: 0}


def test_texts_are_shuffled_once(spark):
    rows = substring_dedup.remove_repeats(spark.read.parquet(f"{SF}/documents.parquet"))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_digest_is_of_the_kept_words(spark):
    row = substring_dedup.op12_substring_dedup(spark, SF).where(F.col("n_removed") == 0).first()
    text = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id") == row.doc_id).first().text
    assert row.kept_sha256 == hashlib.sha256(" ".join(re.findall(r"[^\x20\x09-\x0D]+", text or "")).encode()).hexdigest()
