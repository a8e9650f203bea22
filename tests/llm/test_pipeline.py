import zlib

import numpy as np

import pyarrow as pa

import corpus_pipeline
from chronoweave.llm import langid, packing, pii, quality
from chronoweave.llm._common import utf8

from .test_dedup import bag, jaccard, roots
from .test_tokens import PATH, check_packing

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "personal_data":
            assert set(after) == set(before)
            for k, text in after.items():
                assert not pii.find(text) and (text == before[k]) == (not pii.find(before[k]))
        else:
            assert all(before[k] == t for k, t in after.items())
        if name == "language":
            assert len(after) >= 0.97 * len(before)
        if name == "quality":
            known = [k for k in before if k in labels]
            assert np.mean([(k in after) == (labels[k] == 1) for k in known]) > 0.95
        counts.append(len(after))
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], packing.LENGTH, 0.1)
    assert PATH and zlib and counts == sorted(counts, reverse=True)


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    # with columns named as the stages' own ones
    clashing = odd_docs.withColumns({c: odd_docs.n_chars for c in ("quality_score", "lang_pred", "rejected", "masked_text", "was_masked", "near_duplicate_id", "component", "h1")})
    for docs, n in ((clashing, None), (no_docs, 0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            assert n is None or len(rows) == n
            if name != "packing":
                assert out.columns == docs.columns
    ids = [r.doc_id for r in corpus_pipeline.STAGES[2][1](spark, clashing, SF).collect()]
    assert ids.count(1) == 1 and ids.count(None) == 2 and {3, 4, 5, 9} <= set(ids)
    assert sorted(map(str, corpus_pipeline.STAGES[3][1](spark, clashing, SF).collect())) == sorted(map(str, clashing.collect()))
    known = clashing.withColumn("lang", clashing.source)
    assert {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, known, SF).collect()}.isdisjoint({3, 4, 5, 9})


def test_run_equals_a_plain_version(spark):
    """The whole result against stages done one document, or one pair, at a time; only the two fitted models are the library's."""
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    given = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in given.collect()}
    model = langid.train(given.where(langid.train_on()))
    kept = [k for k, t in texts.items() if not model.judge([t])[2][0]]
    some = given.where(given.doc_id.isin(kept))
    model = quality.train(some, spark.read.parquet(f"{SF}/labels.parquet"))
    score = lambda t: model.score(*utf8(pa.array([t])))[0]
    good = sorted(k for k in kept if score(texts[k]) >= quality.CUT)
    bags = {k: bag(texts[k]) for k in good}
    near = [(a, b) for i, a in enumerate(good) for b in good[i + 1 :] if jaccard(bags[a], bags[b]) >= 0.8]
    first = roots(good, near)
    left = [(k, pii.mask(texts[k], pii.find(texts[k]))) for k in good if first[k] == k]
    assert len(given.columns) and len(texts) > len(good) > len(left) > 0
    got = rows.collect()
    assert {r.doc_id for r in got} == {k for k, _ in left}
    check_packing(got, left, packing.LENGTH, 0.1)
