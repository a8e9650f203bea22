import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.llm import langid, quality, sharding, urlfilter

SF = "/root/testdata/sf0.01"


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_kneser_ney_probabilities_sum_to_one():
    texts = [langid.encode(t) for t in ("the cat sat on the mat and the dog sat too", "a cat and a dog ran to the mat")]
    symbols = [*np.unique(np.concatenate(texts)), 9999]  # the last was never seen
    model = langid.fit({"x": ["the cat sat on the mat and the dog sat too", "a cat and a dog ran to the mat"]}, order=3)
    for context in ([116, 104], [122, 122], [97]):
        total = 0.0
        for s in symbols:
            sym = np.array([*context, s], np.uint32)
            doc = np.zeros(len(sym), np.int64)
            grams = langid._grams(sym, doc, 3)
            before = []
            for n in range(2):
                b = np.empty_like(grams[n])
                b[1:] = grams[n][:-1]
                b[0] = langid._edge(n)
                before.append(b)
            total += float(np.exp(model.log_probabilities(grams, before)[-1, 0]))
        assert total == pytest.approx(1.0, abs=1e-4)


def plain_kneser_ney(texts, order):
    """Probability of a symbol after a context, straight from the definition, with tuples and dictionaries."""
    counts = [Counter() for _ in range(order)]
    for t in texts:
        padded = (0,) * (order - 1) + tuple(t)
        for i in range(order - 1, len(padded)):
            for n in range(order):
                counts[n][padded[i - n : i + 1]] += 1
    for n in range(order - 1):  # lower orders: by how many symbols an n-gram is preceded
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discount, total, follow = [], [], []
    for c in counts:
        n1, n2 = (sum(v == k for v in c.values()) for k in (1, 2))
        discount.append(min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5)
        total.append(Counter())
        follow.append(Counter())
        for g, v in c.items():
            total[-1][g[:-1]] += v
            follow[-1][g[:-1]] += 1

    def probability(context, symbol):
        n = len(context)
        if n == 0:
            spare = discount[0] * len(counts[0]) / total[0][()]
            return max(counts[0][(symbol,)] - discount[0], 0) / total[0][()] + spare / (len(counts[0]) + 1)
        low = probability(context[1:], symbol)
        if not total[n][context]:
            return low
        return max(counts[n][(*context, symbol)] - discount[n], 0) / total[n][context] + discount[n] * follow[n][context] / total[n][context] * low

    return probability


def test_kneser_ney_equals_a_plain_one():
    samples = {"a": ["the cat sat on the mat and the dog sat too", "a cat and a dog ran to the mat", "Then, the end."], "b": ["el gato y el perro", "la casa de la abuela está aquí"]}
    model = langid.fit(samples)
    probes = [langid.encode(t) for t in ("the cat is here", "el perro de aquí", "zzz q")]
    got = model.totals(probes)[0]
    for j, name in enumerate(model.languages):
        plain = plain_kneser_ney([tuple(langid.encode(t).tolist()) for t in samples[name]], langid.ORDER)
        for i, t in enumerate(probes):
            padded = (0,) * (langid.ORDER - 1) + tuple(t.tolist())
            want = sum(np.log(plain(padded[k - langid.ORDER + 1 : k], padded[k])) for k in range(langid.ORDER - 1, len(padded)))
            assert got[i, j] == pytest.approx(want, abs=1e-3)


def test_sample_is_bounded_and_counts_texts_once(spark):
    hot = spark.range(200_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one hot text that fills a third of all rows").alias("text"), F.lit("en").alias("lang"), F.lit(1).alias("quality"))
    rest = spark.createDataFrame([(100 + i, f"plain text number {i} of a language", "en" if i % 2 else "xx") for i in range(3000)] + [(9000, "long words here " * 40_000, "yy")], "doc_id long, text string, lang string")
    docs = hot.select("doc_id", "text", "lang").unionByName(rest)
    got = Counter(r.lang for r in langid.sample(docs).collect())
    assert got["en"] == got["xx"] == langid.PER_LANGUAGE and got["yy"] == 1  # a language of long texts only is learned
    assert langid.train(docs).languages == ["en", "xx", "yy"]
    with pytest.raises(ValueError, match="labels"):
        langid.sample(docs, languages=2)
    labels = rest.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).unionByName(spark.createDataFrame([(7, 1)], "doc_id long, quality int"))
    assert quality.train(docs, labels, per_class=50).weights is not None


def test_language_accuracy_and_rejection(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = langid.op6_language_id(spark, SF).collect()
    test = [r for r in got if r.held_out]
    assert all(r.held_out == held(r.doc_id) for r in got) and len(got) == len(docs)
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in test]) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and np.mean([r.rejected for r in got]) < 0.01
    model = langid.train(spark.read.parquet(f"{SF}/documents.parquet"))
    langs, _, rejected = model.judge(["Съешь же ещё этих мягких французских булок да выпей чаю " * 5, "zq xv kk jw qx vz " * 40, docs[0].text])
    assert rejected.tolist() == [True, True, False]


def test_pieces_of_a_long_text_add_up(monkeypatch):
    model = langid.fit({"a": ["abc abd abe " * 20] * 12, "b": ["xyz xyw " * 30] * 12})
    texts = [langid.encode("abc xyz abd " * 50), langid.encode("q"), langid.encode("abe " * 7)]
    whole = model.totals(texts)[0]
    monkeypatch.setattr(langid, "PIECE", 13)
    assert np.allclose(model.totals(texts)[0], whole, atol=1e-3)


def test_language_odd_rows(spark, odd_docs, no_docs):
    model = langid.fit({"en": [f"plain words of text number {w}" for w in "abcdefghijkl"]})
    got = langid.predict(odd_docs, model).collect()
    assert all((r.lang_pred, r["score_"]) == ("und", 0.0) for r in got if not r.text or not any(c.isalpha() for c in r.text))
    assert all(r.lang_pred == "en" for r in got if r.text and any(c.isalpha() for c in r.text))
    assert langid.keep_identified(odd_docs).columns == odd_docs.columns  # no labels at all: everything is rejected
    assert langid.keep_identified(no_docs).count() == 0


def forward_backward_by_enumeration(node, link):
    from itertools import product

    z, marg = 0.0, np.zeros(len(node))
    for y in product((0, 1), repeat=len(node)):
        w = np.exp(sum(n * k for n, k in zip(node, y)) + sum(link[a, b] for a, b in zip(y, y[1:])))
        z += w
        marg += w * np.array(y)
    return marg / z


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    doc = np.array([0, 0, 0, 1, 2, 2, 2, 2, 2])
    node, link = rng.standard_normal(9), rng.standard_normal((2, 2))
    got, inner, both = quality.forward_backward(node, link, doc, pairs=True)
    for d in range(3):
        assert np.allclose(got[doc == d], forward_backward_by_enumeration(node[doc == d], link))
    assert np.allclose(both[:, :, 1].sum(1), got[inner]) and np.allclose(both[:, 1].sum(1), got[inner - 1])


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = [r for r in quality.op9_quality(spark, SF).collect()]
    test = [r for r in got if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == labels[r.doc_id] for r in test]) > 0.95


def test_scores_equal_marginals_by_enumeration():
    """A document's score: lines' marginals by enumeration, weighted by length, through the curve."""
    good = "Every line of this text is a sentence.\nSo is the next one, with a few more words.\nAnd it ends here."
    bad = "BUY NOW !!! $$$ ###\nclick click click click\n%%% $$ !!!"
    model = quality.fit([good, bad, good + "\n" + good, bad + "\n" + bad] * 6, [1, 0, 1, 0] * 6, 0.6)
    texts = [good, bad, good + "\n" + bad, "One line only.", ""]
    import pyarrow as pa

    from chronoweave.llm._common import utf8

    got = model.score(*utf8(pa.array(texts)))
    for text, score in zip(texts, got):
        if not text:
            assert score == 0.6
            continue
        doc, size, x = quality.line_features(*utf8(pa.array([text])))
        marg = forward_backward_by_enumeration(model.node(doc, x), model.link)
        p = np.clip((marg * size).sum() / size.sum(), 1e-4, 1 - 1e-4)
        assert score == pytest.approx(1 / (1 + np.exp(-(model.curve[0] * np.log(p / (1 - p)) + model.curve[1]))), abs=1e-6)
    assert got[0] > 0.7 > 0.3 > got[1]


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.quality_score for r in quality.predict(odd_docs, quality.train(odd_docs, labels)).collect()} == {0.5}
    assert quality.keep_good(odd_docs, labels).columns == odd_docs.columns
    model = quality.fit(["Good line here.\nAnother fine line of words.", "### $$$ !!\n%% &&"] * 8, [1, 0] * 8, 0.7)
    scored = {r.doc_id: r.quality_score for r in quality.predict(odd_docs, model).collect()}
    assert scored[3] == scored[4] == scored[5] == 0.7
    assert quality.predict(no_docs, model).count() == 0


def test_shards(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = sorted(sharding.shard_by_bytes(docs.repartition(7)).collect(), key=lambda r: r.id)
    texts = {r.doc_id: r.text for r in docs.collect()}
    at, total, slots = 0, sum(len(t.encode()) + 1 for t in texts.values()), {}
    for r in got:
        raw = texts[r.id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert r.shard == min(15, (2 * at + r.size) * 16 // (2 * total)) and r.slot == slots.get(r.shard, 0)
        slots[r.shard] = r.slot + 1
        at += r.size
    again = sorted(sharding.shard_by_bytes(docs.coalesce(1)).collect(), key=lambda r: r.id)
    assert again == got
    odd = sharding.shard_by_bytes(odd_docs).collect()
    assert len(odd) == 14 and sorted((r.shard, r.slot) for r in odd) == [(s, i) for s in sorted({r.shard for r in odd}) for i in range(sum(r.shard == s for r in odd))]
    assert sharding.shard_by_bytes(no_docs).count() == 0


URLS = [None, "", "no scheme", "http://Foo.ORG", "http://foo.org/", "https://a.EXAMPLE.org/es/x", "https://example.org/ES/x", "http://example.org/en/12?q", "http://x.example.org/en/2#f", "http://shop.com/fr/a", "http://shop.com/de/", "http://com/de", "ftp://h?x/y", "a://b://c/d", "http://h.net/é/日本", "http://" + "a" * 50_000 + "/" + "b" * 50_000]


def expected(url):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([i for c in "?#" if (i := tail.find(c)) >= 0], default=len(tail))]
    fits = [(len(h + p), h + p, k) for k, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


def test_url_filter(spark):
    rows = urlfilter.labelled_rows()
    held_out = [r for r in rows if zlib.crc32(r[0].encode()) % 5 == 0]
    weights, bias = urlfilter.fit(urlfilter.labelled(spark, [r for r in rows if zlib.crc32(r[0].encode()) % 5]))
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, score string")
    got = {r.page_id: r for r in urlfilter.judge(pages, weights, bias).collect()}
    for i, u in enumerate(URLS):
        host, path, (rule, verdict) = expected(u)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    assert urlfilter.judge(pages.limit(0), weights, bias).count() == 0
    # URLs that the fit has not seen, in hosts and in paths
    test = spark.createDataFrame([(i, r[0]) for i, r in enumerate(held_out)], "page_id long, url string")
    score = {r.page_id: r.score for r in urlfilter.judge(test, weights, bias, rules=()).collect()}
    right = [(score[i] >= 0.5) == bool(r[1]) for i, r in enumerate(held_out)]
    assert np.mean(right) > 0.95
    assert np.mean([ok for ok, r in zip(right, held_out) if r[1] and not r[0].split("/")[2].count(r[2])]) > 0.8  # the word is in the path
    assert urlfilter.fit(urlfilter.labelled(spark).where("bad = 1"))[1] < 0
    assert urlfilter.fit(urlfilter.labelled(spark).limit(0))[1] < 0


def test_url_filter_by_word(spark):
    """Words that the fit has not seen at all: few of the bad ones are found, and hardly a good one is blocked (figures in the README)."""
    rows = urlfilter.labelled_rows()
    out = lambda word: zlib.crc32(word.encode()) % 5 == 0
    weights, bias = urlfilter.fit(urlfilter.labelled(spark, [r for r in rows if not out(r[2])]))
    unseen = [r for r in rows if out(r[2])]
    pages = spark.createDataFrame([(i, r[0]) for i, r in enumerate(unseen)], "page_id long, url string")
    blocked = {r.page_id: r.score >= 0.5 for r in urlfilter.judge(pages, weights, bias, rules=()).collect()}
    bad, good = ([blocked[i] for i, r in enumerate(unseen) if r[1] == kind] for kind in (1, 0))
    print(f"unseen words: {np.mean(bad):.3f} of {len(bad)} bad ones found, {np.mean(good):.3f} of {len(good)} good ones blocked")
    assert np.mean(good) < 0.03 and np.mean(bad) > np.mean(good)


def test_fit_equals_a_plain_one(spark, monkeypatch):
    """The same steps in NumPy, on buckets taken from the DataFrame."""
    monkeypatch.setattr(urlfilter, "ROUNDS", 3)
    table = urlfilter.labelled(spark, urlfilter.labelled_rows()[::37])
    weights, bias = urlfilter.fit(table)
    host, path = urlfilter.host_and_path(F.col("url"))
    rows = urlfilter.with_buckets(table.select(host.alias("host"), path.alias("path"), "bad")).collect()
    n, size = len(rows), urlfilter.BUCKETS
    x, y = np.zeros((n, size + 1)), np.array([r.bad for r in rows])
    x[:, size] = 1
    for i, r in enumerate(rows):
        for b in (r.host_b, r.path_b):
            for k in b:
                x[i, k] += 1 / np.sqrt(len(b))
    seen = np.zeros((2, size))
    for i, r in enumerate(rows):
        for k in [*r.host_b, *r.path_b]:
            seen[y[i], k] += 1 / (y == y[i]).sum()
    w = np.append(np.where(seen.sum(0) > 0, np.log((seen[1] + urlfilter.SMOOTHING) / (seen[0] + urlfilter.SMOOTHING)), 0), np.log(urlfilter.PRIOR / (1 - urlfilter.PRIOR)))
    share = np.where(y == 1, urlfilter.PRIOR / y.sum(), (1 - urlfilter.PRIOR) / (1 - y).sum())
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, 4):
        g = x.T @ ((y - 1 / (1 + np.exp(-x @ w))) * share) - urlfilter.RIDGE * np.append(w[:-1], 0)
        m, v = 0.8 * m + 0.2 * g, 0.95 * v + 0.05 * g * g
        w = w + urlfilter.STEP * (m / (1 - 0.8**step)) / (np.sqrt(v / (1 - 0.95**step)) + 1e-6)
    assert np.abs(np.append(weights, bias) - w).max() < 0.02


def test_url_scores_equal_a_plain_sum(spark):
    weights = [((i * 7919) % 201 - 100) / 100 for i in range(urlfilter.BUCKETS)]
    pages = spark.createDataFrame([(0, "http://ab.cd/ef/2024?q=1")], "page_id long, url string")
    got = urlfilter.judge(pages, weights, 0.25).first().score
    want = 0.25
    for side, t in {"host": "^ab.cd$", "path": "^/ef/0$"}.items():
        grams = {t[i : i + n] for n in urlfilter.SIZES for i in range(len(t) - n + 1)}
        buckets = {spark.range(1).select(F.pmod(F.xxhash64(F.lit(side), *[F.lit(c) for c in g]), F.lit(urlfilter.BUCKETS))).first()[0] for g in grams}
        want += sum(weights[b] for b in buckets) / np.sqrt(len(buckets))
    assert got == pytest.approx(1 / (1 + np.exp(-want)), abs=1e-5)


def test_main_path_is_native(spark):
    plan = urlfilter.judge(spark.read.parquet(f"{SF}/pages.parquet"), [0.0] * urlfilter.BUCKETS, 0.0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", ["op3_sharding", "op5_embedding_near_dedup", "op7_exact_top_k", "op8_minhash_near_dedup", "pii_base_counts", "url_hosts_and_rules"])
def test_query_equals_sql(spark, name):
    from chronoweave.llm import oracle_sql, queries

    c = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries()[name](spark, SF)
    want = c.execute(oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(str(tuple(r)) for r in df.select(cols).collect()) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", ["op5_embedding_near_dedup", "op8_minhash_near_dedup"])
def test_sql_on_links_and_odd_rows(spark, tmp_path, name, odd_docs, odd_vectors):
    """The SQL itself, on tables that hold what the small tables lack: links of vectors, nulls, repeated ids."""
    from chronoweave.llm import embedding_dedup, minhash, oracle_sql

    rng = np.random.default_rng(5)
    near = [(200 + i, (np.ones(4) + 0.1 * rng.standard_normal(4)).tolist(), 10 + i % 3) for i in range(60)]
    vectors = odd_vectors.select("vec_id", "embedding", "label").where("vec_id is null or vec_id not in (1, 10)").unionByName(spark.createDataFrame(near, "vec_id long, embedding array<float>, label int"))
    vectors.where("size(embedding) in (2, 4) or embedding is null").write.parquet(str(tmp_path / "embeddings.parquet"))
    odd_docs.where("doc_id is null or doc_id not in (1, 2)").select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    for table in ("documents", "embeddings"):
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    query = {"op5_embedding_near_dedup": embedding_dedup.op5_embedding_near_dedup, "op8_minhash_near_dedup": minhash.op8_minhash_near_dedup}[name]
    df = query(spark, str(tmp_path))
    got = sorted(str(tuple(r)) for r in df.collect())
    want = c.execute(oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert cols == df.columns and got == sorted(map(str, want.fetchall()))
