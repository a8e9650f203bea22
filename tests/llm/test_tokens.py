import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chronoweave.llm import packing, sentencepiece

PATH = packing.vocabulary_path()
TEXTS = ["", " ", "a  b", "a\n\n\nb", " a\n b \n", "x\ty  z", "é ü  b", "it's 's <|endoftext|>", "\n\na", "a \n\n b", "a\x1c b", "日本 語\u3000x", "\U0001f600 ok", "don't\n'll 12,5%"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def model():
    return sentencepiece.pieces(sentencepiece.model_path())


def test_bpe_ids_equal_the_library(spark, reference):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in TEXTS + docs:
        assert packing.token_ids(text, PATH).tolist() == reference.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab '\n\t1.é語\u3000", max_size=40))
def test_bpe_ids_on_any_white_space(reference, text):
    assert packing.token_ids(text, PATH).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_packed_ids_are_those_of_the_default_setting(spark):
    default = Tokenizer.from_file(PATH)
    mark = "<|endoftext|>"
    texts = [*TEXTS, mark, mark * 3, f"this is {mark} x", f"a  {mark}  b\n{mark}\n", f"{mark[:-1]} {mark}>", f"l{mark}'s \u3000{mark}é"]
    want = {i: default.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    rows = {r.doc_id: r for r in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        own = np.array([*want[i], packing.END_ID], "<u4")
        assert (rows[i].ids_crc32, rows[i].length, rows[i].doc_tokens) == (zlib.crc32(own), len(own), len(own)), t
        assert packing.token_ids(t, PATH, added=True).tolist() == want[i]


def brute(model, text):
    """Best score over all segmentations, by trying every piece at every place."""
    table = {model.names[i]: model.automaton.get(model.names[i])[2] for i in np.flatnonzero(model.plain)}
    best = [0.0] + [-1e300] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - 16), j):
            if (s := table.get(text[i:j])) is not None and best[i] + s > best[j]:
                best[j] = best[i] + s
        if best[j] == -1e300:
            best[j] = best[j - 1] + model.lowest - sentencepiece.UNKNOWN_PENALTY
    return best[-1]


def score(model, ids):
    total, at = 0.0, 0
    while at < len(ids):
        if model.plain[ids[at]]:
            total += model.automaton.get(model.names[ids[at]])[2]
            at += 1
        else:  # the bytes of one character
            lead = model.bytes.index(ids[at])
            at += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            total += model.lowest - sentencepiece.UNKNOWN_PENALTY
    return total


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abthe ionre\n.,é語\t😀", max_size=40))
def test_viterbi_is_best_and_round_trips(model, text):
    ids = np.frombuffer(model.encode(text), np.uint32)
    assert model.decode(ids) == text
    if text:
        assert score(model, ids.tolist()) == pytest.approx(brute(model, (" " + text).replace(" ", sentencepiece.MARK)))


def test_pieces_are_nearly_those_of_the_merges(spark, model):
    """The model was trained as BPE: the most probable pieces are often, not always, those that its merges give."""
    import sentencepiece as library

    merges = library.SentencePieceProcessor(model_file=sentencepiece.model_path())
    texts = [r.text[:3000] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text]
    words = {w for t in texts for w in t.split()}
    own = {w: model.segment(sentencepiece.MARK + w) for w in words}
    assert np.mean([own[w] == merges.encode(w) for t in texts for w in t.split()]) > 0.75
    assert abs(sum(len(model.encode(t)) // 4 for t in texts) / sum(map(len, merges.encode(texts))) - 1) < 0.02


def test_op2_equals_the_model_on_every_document(spark, model):
    """The query's ids, counts and checksums against a plain loop with brute-force scores on short texts."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in sentencepiece.op2_sentencepiece(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for k, text in docs.items():
        assert got[k].n_ids == len(got[k].ids) and got[k].decoded_crc32 == zlib.crc32(text.encode())
        if len(text) < 400:
            assert score(model, got[k].ids) == pytest.approx(brute(model, (" " + text).replace(" ", sentencepiece.MARK)))


def test_sentencepiece_rows(spark, odd_docs, no_docs):
    back = sentencepiece.decode(sentencepiece.encode(odd_docs).withColumnRenamed("ids", "ids"))
    want = sorted(str(r.text) for r in odd_docs.collect())
    assert sorted(str(r.text) for r in back.collect()) == want
    assert back.where("text is null and ids is null").count() == 2
    clash = sentencepiece.decode(sentencepiece.encode(odd_docs).withColumn("text", sentencepiece.F.lit("x")))
    assert clash.columns == ["doc_id", "ids", "text", "text_"] and clash.select("text", "text_").where("text_ is null").count() == 2
    assert sentencepiece.decode(sentencepiece.encode(no_docs)).count() == 0


def check_packing(rows, docs, length, padding):
    """Every id once, sequences gapless and within their length; checksums and counts as given by the library as it is."""
    library, ids = Tokenizer.from_file(PATH), {}
    for doc_id, text in docs:
        own = np.append(np.array(library.encode(text or "", add_special_tokens=False).ids, np.uint32), np.uint32(packing.END_ID)).astype("<u4")
        ids.setdefault(doc_id, []).append(own)
    seq = {}
    for r in rows:
        seq.setdefault(r.sequence_id, []).append(r)
        assert any(zlib.crc32(own[r.start : r.start + r.length]) == r.ids_crc32 and len(own) == r.doc_tokens for own in ids[r.doc_id])
    total = 0
    for own in seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
        total += at
    assert total == sum(len(o) for v in ids.values() for o in v)
    starts = {}
    for r in rows:
        starts.setdefault(r.doc_id, []).append((r.start, r.length))
    for k, own in ids.items():
        if len(own) == 1:
            at = 0
            for s, n in sorted(starts[k]):
                assert s == at
                at += n
            assert at == len(own[0])
    assert 1 - total / (len(seq) * length) <= padding


def test_packing(spark, odd_docs, no_docs):
    rows = packing.pack(odd_docs).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], 2048, 0.02)
    assert packing.pack(no_docs).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(5)
    rows = packing.pack(docs, length=512, windows=4).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 512, 0.05)


def test_packer_is_bounded_and_best_fit():
    r = random.Random(3)
    p, fill, open_now = packing.Packer(100, 3), {}, set()
    for _ in range(2000):
        size = r.randrange(1, 100)
        room = {w: 100 - fill[w] for w in open_now}
        fitting = {w: v for w, v in room.items() if v >= size}
        window, offset = p.place(size)
        if fitting:
            assert room[window] == min(fitting.values())
        elif len(open_now) == 3:
            gone = min(room.values())
            assert {room[w] for w in open_now - {w for _, w in p.room}} == {gone}
        assert offset == fill.get(window, 0)
        fill[window] = offset + size
        open_now = {w for _, w in p.room}
        assert len(open_now) <= 3 and fill[window] <= 100
