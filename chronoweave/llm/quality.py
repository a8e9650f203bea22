"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line's potential is linear in its own features (length, shares of character classes,
word lengths, repetition within line and text) and in those of the lines before and after it; the chain adds potentials for
pairs of neighbouring labels. Forward-backward gives each line's probability of being good; their mean, weighted by line
length, is mapped to a probability by a two-parameter logistic curve.

Lines are not labelled: in fitting, all lines of a document bear its label. The fit uses a bounded sample (at most ``PER_CLASS``
different texts of each class; of longer ones the ``MAX_TRAIN_CHARS`` characters in the middle); the curve is weighted back to the
true shares.

Nulls, ties: a null, empty or blank text has no lines and gets the share of good documents. With labels of one class only, or
none, every text gets that share (0.5 for none). Null ids and repeated rows are judged by their text; extra columns are
ignored. A label row with a null is ignored; of several labels for one id the lowest counts. Memory of a task follows its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _words
from ._common import fitted, fresh, middle, over_texts, slices, unit, utf8
from .langid import train_on

PER_CLASS = 600
MAX_TRAIN_CHARS = 20_000
ROUNDS = 100
RIDGE = 1e-3
CUT = 0.3

_CLASS = np.full(256, 5, np.uint8)  # other symbols
_CLASS[97:123] = _CLASS[128:] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 4
_CLASS[ord("!")] = 6
_FINAL = np.zeros(256, bool)
_FINAL[[ord(c) for c in ".?!\"')"]] = True


def _repeated(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether each value occurs again in its group."""
    if not len(value):
        return np.zeros(0, bool)
    key = _words.mix(value + _words.mix(group.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    out = np.empty(len(k), bool)
    out[order] = same[1:] | same[:-1]
    return out


def line_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, bytes, features) of every line that is not blank, in order."""
    doc, ws, we = _words.words(data, offs)
    if not len(doc):
        return doc, doc, np.zeros((0, 18))
    breaks = np.flatnonzero(data == 10)
    # a word's line: number of breaks before it, told apart by text
    at = np.searchsorted(breaks, ws) + doc
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    line = np.cumsum(new) - 1
    n_words = np.diff(np.append(first, len(at)))
    starts, ends, of = ws[first], we[np.append(first[1:], len(at)) - 1], doc[first]
    size = (ends - starts).astype(np.float64)
    kind = _CLASS[data]
    share = []
    for c in range(7):
        run = np.zeros(len(data) + 1, np.int32)
        np.cumsum(kind == c, out=run[1:])
        share.append((run[ends] - run[starts]) / size)
    lower, upper, digit, space, point, symbol, shout = share
    h = _words.hash_runs(data, ws, we)
    word_again = _repeated(line, h)
    next_same = np.zeros(len(h))
    next_same[1:] = (h[1:] == h[:-1]) & ~new[1:]
    trio = np.zeros(len(h), np.uint64)
    trio[2:] = h[2:] + h[1:-1] * np.uint64(3) + h[:-2] * np.uint64(5)
    whole = np.zeros(len(h), bool)
    whole[2:] = doc[2:] == doc[:-2]
    trio_again = np.zeros(len(h))
    trio_again[whole] = _repeated(doc[whole], trio[whole])
    add = lambda x: np.add.reduceat(x.astype(np.float64), first)
    line_again = _repeated(of, _words.hash_runs(data, starts, ends))
    letters = np.maximum(lower + upper, 1e-9)
    x = np.column_stack([
        np.log1p(size) / 5, np.log1p(n_words) / 4, upper / letters, digit, space, point, symbol, shout,
        add(we - ws) / n_words / 10, add(word_again) / n_words, add(next_same) / n_words, line_again, add(trio_again) / n_words,
        _FINAL[data[ends - 1]], symbol > 0.08, upper / letters > 0.5, shout > 0.05, n_words < 4,
    ])
    return of, ends - starts, x


def with_neighbours(doc: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zeros beyond a text's ends), and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    same = doc[1:] == doc[:-1]
    before[1:][same] = x[:-1][same]
    after[:-1][same] = x[1:][same]
    return np.column_stack([x, before, after, np.ones(len(x))])


def _layout(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line and number of lines of each chain, longest first; texts stand in order of doc."""
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(doc)))
    order = np.argsort(-count, kind="stable")
    return first[order], count[order], np.searchsorted(-count[order], -np.arange(count.max() if len(count) else 0), side="left")


def forward_backward(node: np.ndarray, link: np.ndarray, doc: np.ndarray, pairs: bool = False):
    """Marginals of label 1 from log-odds ``node`` and pair potentials ``link`` (2, 2); with ``pairs`` also the expected pairs, by chain and label pair."""
    first, count, active = _layout(doc)
    odds = np.exp(np.clip(node, -30, 30))
    t = np.exp(link)
    a, b = np.empty(len(node)), np.ones(len(node))  # forward: P(1); backward: message for 1 over the sum of both
    b *= 0.5
    for k in range(len(active)):
        at = first[: active[k]] + k
        if k == 0:
            p0, p1 = np.ones(len(at)), odds[at]
        else:
            prev = a[at - 1]
            p0 = (1 - prev) * t[0, 0] + prev * t[1, 0]
            p1 = ((1 - prev) * t[0, 1] + prev * t[1, 1]) * odds[at]
        a[at] = p1 / (p0 + p1)
    for k in range(len(active) - 1, 0, -1):
        at = first[: active[k]] + k
        m0, m1 = 1 - b[at], b[at] * odds[at]
        q0, q1 = t[0, 0] * m0 + t[0, 1] * m1, t[1, 0] * m0 + t[1, 1] * m1
        b[at - 1] = q1 / (q0 + q1)
    good = a * b / (a * b + (1 - a) * (1 - b))
    if not pairs:
        return good
    inner = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    p = np.stack([1 - a[inner - 1], a[inner - 1]], 1)
    q = np.stack([1 - b[inner], b[inner] * odds[inner]], 1)
    both = p[:, :, None] * t[None] * q[:, None, :]
    both /= both.sum(axis=(1, 2), keepdims=True)
    return good, inner, both


@dataclass
class Model:
    """Weights of the line potentials and of label pairs, feature scaling, curve, and the share of good documents."""

    weights: np.ndarray | None = None
    link: np.ndarray | None = None
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    curve: tuple[float, float] = (1.0, 0.0)
    share: float = 0.5

    def node(self, doc: np.ndarray, x: np.ndarray) -> np.ndarray:
        return with_neighbours(doc, (x - self.centre) / self.scale) @ self.weights

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        out = np.full(len(offs) - 1, self.share)
        if self.weights is None:
            return out
        doc, size, x = line_features(data, offs)
        if len(doc):
            has, mean = _weighted(doc, size, forward_backward(self.node(doc, x), self.link, doc))
            z = self.curve[0] * _logit(mean) + self.curve[1]
            out[has] = 1 / (1 + np.exp(-z))
        return out


def _weighted(doc: np.ndarray, size: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    has, at = np.unique(doc, return_inverse=True)
    return has, np.bincount(at, weights=good * size) / np.bincount(at, weights=size)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(texts: list[str], labels: list[int], share: float) -> Model:
    """Maximum likelihood by Adam, each document with the same weight, then the curve on the same documents."""
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return Model(share=share if len(y) else 0.5)
    parts, at = [], 0
    for b in slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), 0):
        doc, size, x = line_features(*utf8(b.column(0)))
        parts.append((doc + at, size, x))
        at += len(b)
    doc, size, x = map(np.concatenate, zip(*parts))
    if not len(doc):
        return Model(share=share)
    m = Model(share=share, centre=x.mean(axis=0), scale=x.std(axis=0) + 0.05)
    full = with_neighbours(doc, (x - m.centre) / m.scale)
    lines = np.bincount(doc, minlength=len(y))
    balance = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    weight = (balance / np.maximum(lines, 1))[doc]
    label = y[doc]
    m.weights, m.link = np.zeros(full.shape[1]), np.zeros((2, 2))
    state = [np.zeros(full.shape[1] + 4), np.zeros(full.shape[1] + 4)]
    for step in range(1, ROUNDS + 1):
        good, inner, both = forward_backward(full @ m.weights, m.link, doc, pairs=True)
        seen = np.zeros((len(inner), 2, 2))
        seen[np.arange(len(inner)), label[inner].astype(int), label[inner].astype(int)] = 1
        grad = np.append(full.T @ (weight * (label - good)), ((seen - both) * weight[inner][:, None, None]).sum(axis=0))
        grad -= RIDGE * np.append(m.weights, m.link)
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-9)
        m.weights += move[:-4]
        m.link += move[-4:].reshape(2, 2)
    has, mean = _weighted(doc, size, forward_backward(full @ m.weights, m.link, doc))
    z, target = _logit(mean), y[has]
    true = np.where(target == 1, share / max(1, (target == 1).sum()), (1 - share) / max(1, (target == 0).sum()))
    a, b = 1.0, 0.0
    for _ in range(30):  # Newton
        p = 1 / (1 + np.exp(-(a * z + b)))
        r, v = true * (target - p), true * p * (1 - p)
        g = np.array([(r * z).sum() - 1e-3 * (a - 1), r.sum()])
        hess = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-6]])
        da, db = np.clip(np.linalg.solve(hess, g), -1, 1)
        a, b = a + da, b + db
    m.curve = (float(max(a, 0.0)), float(b))
    return m


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS) -> Model:
    """A model from documents that have a label and are not held out, fitted in one task on a bounded sample of different texts."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1)).groupBy("doc_id").agg(F.min(label_col).cast("int").alias("y")).where(train_on())
    count = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
    if not count:
        return Model()
    share = count.get(1, 0) / sum(count.values())
    rate = F.when(F.col("y") == 1, min(1.0, 1.2 * per_class / count.get(1, 1))).otherwise(min(1.0, 1.2 * per_class / count.get(0, 1)))
    picked = own.where(unit(F.xxhash64("doc_id")) <= rate).select(F.col("doc_id").alias("key"), "y")  # the rate bounds it
    text = F.col(text_col).cast("string")
    # cut from a longer text, the piece begins and ends with a whole line where it has several
    piece = F.when(F.length(text) <= MAX_TRAIN_CHARS, text).otherwise(F.regexp_replace(middle(text, MAX_TRAIN_CHARS), r"(?s)\A[^\n]*\n(?=.*\n)|(?<=\n)[^\n]*\z", ""))
    texts = docs.where(F.length(text) > 0).select(F.col(id_col).cast("long").alias("key"), piece.alias("text"))
    some = texts.join(F.broadcast(picked), "key").withColumn("h", F.xxhash64("text")).groupBy("y", "h").agg(F.min("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("y").orderBy("h"))

    def learn(rows: pa.Table) -> Model:
        rows = rows.sort_by([("y", "ascending"), ("h", "ascending")])
        return fit(rows.column("text").to_pylist(), rows.column("y").to_pylist(), share)

    return fitted(some.withColumn("nth", nth).where(F.col("nth") <= per_class).drop("nth"), learn) or Model(share=share)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a last column (named quality_score, made free of clashes): the score, 0 to 1."""
    names = docs.columns
    new = fresh("quality_score", names)
    schema = docs.select("*", F.lit(None).cast("double").alias(new)).schema
    at = names.index(text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, at):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(held.value.score(*utf8(b.column(at))))], [*names, new])

    return over_texts(docs, run, schema)


def op9_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return predict(docs, model).select("doc_id", (~train_on()).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``CUT``; all their columns."""
    out = predict(docs, train(docs, labels, id_col, text_col), text_col)
    return out.where(F.col(out.columns[-1]) >= CUT).select(*docs.columns)
