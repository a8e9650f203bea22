"""Language identification by interpolated Kneser-Ney character models, one per language.

A text becomes a string of symbols: lower-case letters, and one gap for every run of other characters. Each language has a
Kneser-Ney model up to ``ORDER`` symbols, fitted on a bounded sample of labelled rows (``PER_LANGUAGE`` different texts, of longer
ones the ``MAX_TRAIN_CHARS`` characters in the middle). The models live side by side in sorted arrays of n-gram hashes, one column a language, so one
binary search serves all. A text goes to the language with the lowest cross-entropy per symbol. It is rejected when that
entropy is above a limit for the language, calibrated on sample texts that the fit holds back: halfway from the upper end of
the language's own entropies to the entropies that its model gives to texts of the other languages, plus an allowance for
short texts, whose mean varies more.

Nulls, ties: a null text or one without a letter is ``und`` with score 0, and rejected. Equal entropies go to the first
language in order of name. With no labelled row, every text is ``und``. More than ``MAX_LANGUAGES`` labels are an error, none is
left out. Repeated rows are judged alike, and count once in the fit; extra columns are ignored. Texts of any length are worked off in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _words
from ._common import fitted, fresh, middle, over_texts, unit

ORDER = 4
#: Documented bounds of the fitting sample: texts a language, characters a text, texts in all, languages.
PER_LANGUAGE = 400
MAX_TRAIN_CHARS = 8_000
SAMPLE_TEXTS = 6_400
MAX_LANGUAGES = 64
OWN_QUANTILE = 0.99
FOREIGN_QUANTILE = 0.05
#: Nats added to the limit, divided by the root of the number of symbols.
SHORT_ALLOWANCE = 8.0
#: Symbols that a task scores at once.
PIECE = 100_000
UNDETERMINED = "und"

_U = np.uint64
_GAP = 0


@lru_cache(1)
def _symbols() -> np.ndarray:
    """Code point to symbol: a letter's lower-case code point, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def encode(text: str) -> np.ndarray:
    """The text's symbols, one gap for each run of other characters."""
    sym = _symbols()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if len(sym) > 1:
        keep = np.ones(len(sym), bool)
        keep[1:] = (sym[1:] != _GAP) | (sym[:-1] != _GAP)
        sym = sym[keep]
    return sym


def _grams(sym: np.ndarray, doc: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order the hash of the n symbols that end at each place; before a text's start stand gaps."""
    s = sym.astype(np.uint64) + _U(1)
    out = [_words.mix(s)]
    h = s
    for n in range(1, order):
        back = np.full(len(s), _GAP + 1, np.uint64)
        back[n:] = np.where(doc[n:] == doc[:-n], s[:-n], _U(_GAP + 1))
        h = h + back * _U(pow(0x100000001B3, n, 1 << 64) * 31 + 7 & 0xFFFFFFFFFFFFFFFF)
        out.append(_words.mix(h + _U(n)))
    return out


@dataclass
class Model:
    """keys[n], logp[n]: sorted hashes of seen (n+1)-grams and their log probabilities, a column for each language.
    contexts[n], back[n]: sorted hashes of n-gram contexts and their log backoff weights. floor: log probability of an unseen symbol."""

    languages: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    back: list[np.ndarray]
    floor: np.ndarray
    limit: np.ndarray | None = None

    def log_probabilities(self, grams: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
        """(places, languages). before[n]: hash of the n+1 symbols that end just before each place."""
        return self._at(len(self.keys) - 1, grams, before)

    def _at(self, n: int, grams: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(grams[0]), len(self.languages)), np.float32)
        i = np.searchsorted(self.keys[n], grams[n])
        i[i == len(self.keys[n])] = 0
        seen = self.keys[n][i] == grams[n] if len(self.keys[n]) else np.zeros(len(i), bool)
        out[seen] = self.logp[n][i[seen]]
        miss = np.flatnonzero(~seen)
        if len(miss):
            if n == 0:
                out[miss] = self.floor
            else:
                low = self._at(n - 1, [g[miss] for g in grams], [b[miss] for b in before])
                ctx = before[n - 1][miss]
                j = np.searchsorted(self.contexts[n], ctx)
                j[j == len(self.contexts[n])] = 0
                hit = self.contexts[n][j] == ctx
                low[hit] += self.back[n][j[hit]]
                out[miss] = low
        return out

    def totals(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(log probability by text and language, number of symbols), from encoded texts."""
        total, size = np.zeros((len(texts), len(self.languages))), np.array([len(t) for t in texts], np.int64)
        order = len(self.keys)
        piece: list[tuple[int, np.ndarray, int]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if piece:
                sym = np.concatenate([s for _, s, _ in piece])
                doc = np.repeat(np.arange(len(piece)), [len(s) for _, s, _ in piece])
                grams = _grams(sym, doc, order)
                start = np.ones(len(sym), bool)
                start[1:] = doc[1:] != doc[:-1]
                before = []
                for n in range(order - 1):
                    b = np.empty_like(grams[n])
                    b[1:] = grams[n][:-1]
                    b[start] = _edge(n)
                    before.append(b)
                lp = self.log_probabilities(grams, before)
                first = np.flatnonzero(start)
                for (t, _, skip), a in zip(piece, first):
                    lp[a : a + skip] = 0  # scored with the piece before
                np.add.at(total, [t for t, _, _ in piece], np.add.reduceat(lp, first, axis=0, dtype=np.float64))
            piece.clear()
            held = 0

        for t, s in enumerate(texts):
            for at in range(0, len(s), PIECE):
                lead = min(at, order - 1)
                part = s[at - lead : at + PIECE]
                if held + len(part) > PIECE:
                    flush()
                piece.append((t, part, lead))
                held += len(part)
        flush()
        return total, size

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) of each text."""
        coded = [encode(t) if t else np.zeros(0, np.uint32) for t in texts]
        has = np.array([bool(c.any()) for c in coded], bool)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        total, size = self.totals(coded)
        entropy = -total / np.maximum(size, 1)[:, None]
        best = entropy.argmin(axis=1)
        # posterior with the evidence of at most 50 symbols, so that long texts do not all score 1 and short ones stay open
        weight = np.minimum(size, 50)[:, None]
        z = -(entropy - entropy.min(axis=1, keepdims=True)) * weight
        score = np.where(has, 1 / np.exp(z).sum(axis=1), 0.0)
        rejected = ~has
        if self.limit is not None:
            rejected |= entropy[np.arange(len(texts)), best] > self.limit[best] + SHORT_ALLOWANCE / np.sqrt(np.maximum(size, 1))
        return [self.languages[b] if h else UNDETERMINED for b, h in zip(best, has)], score, rejected


@lru_cache(8)
def _edge(n: int) -> np.uint64:
    """Hash of n+1 gaps, what stands before a text."""
    return _grams(np.zeros(n + 1, np.uint32), np.zeros(n + 1, np.int64), n + 1)[n][-1]


def _counts(texts: list[np.ndarray], order: int):
    """For n = 1..order: distinct n-grams as (hash, hash of the context, hash of the n-gram without its first symbol, count)."""
    sym = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    grams = _grams(sym, doc, order)
    start = np.ones(len(sym), bool)
    start[1:] = doc[1:] != doc[:-1]
    out = []
    for n in range(order):
        key, first, count = np.unique(grams[n], return_index=True, return_counts=True)
        if n:
            ctx = np.empty_like(grams[n - 1])
            ctx[1:] = grams[n - 1][:-1]
            ctx[start] = _edge(n - 1)
            ctx, tail = ctx[first], grams[n - 1][first]
        else:
            ctx = tail = np.zeros(len(key), np.uint64)
        out.append((key, ctx, tail, count))
    return out


def _kneser_ney(counts: list[tuple], order: int):
    """One language, from its n-grams: for n = 1..order (hash, probability), for n = 2..order (context, backoff weight), and the floor."""
    probs, backs = [], []
    lower: tuple[np.ndarray, np.ndarray] | None = None
    floor = 0.0
    for n in range(order):
        key, ctx, tail, c = counts[n]
        if n < order - 1:  # continuation count: by how many symbols the n-gram is preceded
            up_tail = counts[n + 1][2]
            c = np.bincount(np.searchsorted(key, up_tail), minlength=len(key)).astype(np.int64)
        keep = c > 0
        key, ctx, tail, c = key[keep], ctx[keep], tail[keep], c[keep].astype(np.float64)
        n1, n2 = (c == 1).sum(), (c == 2).sum()
        d = min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5
        if n == 0:
            total = c.sum()
            spare = d * len(c) / total
            vocabulary = len(c) + 1
            floor = spare / vocabulary
            p = np.maximum(c - d, 0) / total + floor
        else:
            u, at = np.unique(ctx, return_inverse=True)
            total = np.bincount(at, weights=c)
            back = d * np.bincount(at) / total
            p = np.maximum(c - d, 0) / total[at] + back[at] * lower[1][np.searchsorted(lower[0], tail)]
            backs.append((u, back))
        probs.append((key, p))
        lower = (key, p)
    return probs, backs, floor


def fit(samples: dict[str, list[str]], order: int = ORDER) -> Model:
    """A model from some texts of each language; every fifth text is held back to calibrate the rejection."""
    names = sorted(k for k, v in samples.items() if any(encode(t).any() for t in v if t))
    coded = {k: [c for t in samples[k] if t and len(c := encode(t)) and c.any()] for k in names}
    parts = {k: [c for i, c in enumerate(v) if i % 5 or len(v) < 10] for k, v in coded.items()}
    counts = [_counts(parts[k], order) for k in names]
    fitted = [_kneser_ney(c, order) for c in counts]
    keys, logp, contexts, back = [], [], [np.zeros(0, np.uint64)], [np.zeros((0, len(names)), np.float32)]
    floor = np.log(np.array([f[2] for f in fitted]))
    for n in range(1, order):
        u = np.unique(np.concatenate([f[1][n - 1][0] for f in fitted])) if fitted else np.zeros(0, np.uint64)
        w = np.zeros((len(u), len(names)), np.float32)  # a context that a language has not seen hands all on
        for j, f in enumerate(fitted):
            w[np.searchsorted(u, f[1][n - 1][0]), j] = np.log(f[1][n - 1][1])
        contexts.append(u)
        back.append(w)
    tails: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for n in range(order):
        # all n-grams that some language has, with context and tail to fill in the others by backing off
        found = [c[n] for c in counts]
        key, first = np.unique(np.concatenate([f[0] for f in found]), return_index=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        ctx, tail = (np.concatenate([f[i] for f in found])[first] if found else key for i in (1, 2))
        table = np.empty((len(key), len(names)), np.float32)
        for j, f in enumerate(fitted):
            k, p = f[0][n]
            if n == 0:
                table[:, j] = floor[j]
            else:
                c = np.searchsorted(contexts[n], ctx)
                c[c == len(contexts[n])] = 0
                weight = np.where(contexts[n][c] == ctx, back[n][c, j], 0)
                table[:, j] = weight + tails[n - 1][1][np.searchsorted(tails[n - 1][0], tail), j]
            table[np.searchsorted(key, k), j] = np.log(p)
        tails[n] = (key, table, key)
        keys.append(key)
        logp.append(table)
    model = Model(names, keys, logp, contexts, back, floor.astype(np.float32))
    if names:
        held = {k: [c for i, c in enumerate(v) if i % 5 == 0] or v for k, v in coded.items()}
        seen = {k: model.totals(v) for k, v in held.items()}
        limit = np.zeros(len(names))
        for j, k in enumerate(names):
            own = np.quantile(-seen[k][0][:, j] / seen[k][1], OWN_QUANTILE)
            foreign = [np.quantile(-seen[o][0][:, j] / seen[o][1], FOREIGN_QUANTILE) for o in names if o != k]
            # one language alone: as far as a text of evenly mixed symbols
            limit[j] = (own + max(own, min(foreign, default=float(np.log(len(keys[0]) + 1))))) / 2
        model.limit = limit
    return model


def sample(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, languages: int = MAX_LANGUAGES) -> DataFrame:
    """(lang, text, h): a bounded sample of different texts by language, the same however rows are ordered or repeated.

    The texts with the lowest hashes, found by a rate from an approximate count. Of a longer text than ``MAX_TRAIN_CHARS`` its
    middle is taken. ValueError with more than ``languages`` labels.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(lang_col).cast("string").alias("lang"), middle(F.col(text_col).cast("string"), MAX_TRAIN_CHARS).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    count = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(languages + 1).collect()
    if len(count) > languages:
        raise ValueError(f"more than {languages} labels in {lang_col}; a model has a column for each, raise the bound if there are so many languages")
    if not count:
        return rows.limit(0)
    most = max(1, min(per_language, SAMPLE_TEXTS // len(count)))
    rate = F.create_map(*[x for r in count for x in (F.lit(r["lang"]), F.lit(min(1.0, 1.3 * most / max(1, r["n"]))))])
    some = rows.where(unit(F.col("h")) <= F.try_element_at(rate, F.col("lang"))).groupBy("lang", "h").agg(F.min("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return some.withColumn("nth", nth).where(F.col("nth") <= most).select("lang", "text", "h")


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **bounds) -> Model:
    """A model from the labelled rows of ``docs``, fitted in one task on a bounded sample."""

    def learn(rows: pa.Table) -> Model:
        samples: dict[str, list[str]] = {}
        rows = rows.sort_by([("lang", "ascending"), ("h", "ascending")])
        for lang, text in zip(rows.column("lang").to_pylist(), rows.column("text").to_pylist()):
            samples.setdefault(lang, []).append(text)
        return fit(samples)

    return fitted(sample(docs, text_col, lang_col, **bounds), learn) or fit({})


def train_on(id_col: str = "doc_id") -> Column:
    """Rows that models may learn labels from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 != 0


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns (made free of clashes) lang_pred, score, rejected."""
    names = docs.columns
    new = [fresh(c, names) for c in ("lang_pred", "score", "rejected")]
    schema = docs.select("*", F.lit(None).cast("string").alias(new[0]), F.lit(None).cast("double").alias(new[1]), F.lit(None).cast("boolean").alias(new[2])).schema
    at = names.index(text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores, rejected = [], [], []
            for k in range(0, len(b), 500):
                x, y, z = held.value.judge(b.column(at).slice(k, 500).to_pylist())
                langs += x
                scores.append(y)
                rejected.append(z)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(np.concatenate(scores or [np.zeros(0)])), pa.array(np.concatenate(rejected or [np.zeros(0, bool)]))], [*names, *new])

    return over_texts(docs, run, schema)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(train_on()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", (~train_on()).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is found with certainty enough; all their columns."""
    model = train(docs.where(train_on(id_col)), text_col, lang_col)
    out = predict(docs, model, text_col)
    return out.where(~F.col(out.columns[-1])).select(*docs.columns)
