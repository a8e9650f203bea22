"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The pieces and their scores come from a model file; nothing is trained. Reading a text once, the automaton names every piece
that ends at each position (its state's piece and those along its output links); each relaxes the best score there. The way of
highest total score is the segmentation. A character that no way covers costs ``UNKNOWN_PENALTY`` below the lowest score and
becomes its bytes' pieces, or the unknown id in a model without these.

This is the unigram reading of a model: of all segmentations the most probable one, scores being log probabilities. A model trained
as BPE gives merge ranks instead, whose sums mean nothing; there a piece of rank r counts as one of frequency 1 / (r + ``RANK_OFFSET``),
the law by which frequencies fall with ranks. The result is not always what the merges give; decoding is the same.

Text is taken as it is but for spaces, which become the mark, and one mark put in front, as models with an identity
normaliser say. ``decode`` undoes both, so that the round trip is exact but for marks in the text, which read back as spaces.

Prose repeats its chunks, and no piece reaches over a chunk's end (checked for the model), so each chunk is segmented once for as
long as a bounded cache holds it. Nulls, ties: a null text has null ids, an empty one none; of equal scores the longer last piece
wins. Rows are independent: repeated rows, null ids and extra columns change nothing.
"""

from __future__ import annotations

import array
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._chunks import ChunkCache
from ._common import fresh, over_texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Scores are whole numbers of this fraction, whose sums are exact in any order: ties stay ties.
FIXED_POINT = 1 << 24
RANK_OFFSET = 100


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The pieces of a model file, their automaton and a chunk cache."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        scores = [sp.get_score(i) for i in range(n)]
        if all(s <= 0 and s == int(s) for s in scores):  # whole numbers are ranks
            scores = [-math.log(RANK_OFFSET - s) for s in scores]
        scores = [round(s * FIXED_POINT) for s in scores]
        self.names = [sp.id_to_piece(i) for i in range(n)]
        self.unknown = sp.unk_id()
        self.bytes = [-1] * 256
        self.automaton = ahocorasick.Automaton()
        self.lowest = 0
        self.plain = np.zeros(n, bool)
        for i, name in enumerate(self.names):
            if sp.is_byte(i):
                self.bytes[int(name[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.automaton.add_word(name, (i, len(name), scores[i]))
                self.lowest = min(self.lowest, scores[i])
                self.plain[i] = True
                if "\n" in name or MARK in name.lstrip(MARK):
                    raise ValueError(f"piece {name!r} may join words; such models need whole texts as chunks")
        self.automaton.make_automaton()
        self.whole_bytes = all(b >= 0 for b in self.bytes)
        self._line_feed = array.array("I", self._path("\n", [None, None])).tobytes()
        self.cache = ChunkCache(self._chunks, prefix=" ")
        self.as_bytes = [name.encode() if p else b"" for name, p in zip(self.names, self.plain)]
        for b, i in enumerate(self.bytes):
            if i >= 0:
                self.as_bytes[i] = bytes([b])
        self.as_bytes[self.unknown] = " ⁇ ".encode()

    def segment(self, text: str) -> list[int]:
        """The ids of the best segmentation of ``text``, whose spaces are marks."""
        return array.array("I", self._segment_all([text])[0]).tolist()

    def _segment_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each. The automaton reads them in one go, parted by line feeds, which no piece holds."""
        joined = "\n".join(texts)
        never = -1e300
        best, last = [never] * (len(joined) + 1), [None] * (len(joined) + 1)
        at = 0
        for t in texts:
            best[at] = 0
            at += len(t) + 1
        for end, piece in self.automaton.iter(joined):
            total = best[end + 1 - piece[1]] + piece[2]
            end += 1
            if total > best[end]:
                best[end] = total
                last[end] = piece
        results = []
        low = 0
        for t in texts:
            high = low + len(t)
            if never in best[low : high + 1]:
                results.append(array.array("I", self._path(t, self._with_unknown(t))).tobytes())
            else:
                out = []
                at = high
                while at > low:
                    piece = last[at]
                    out.append(piece[0])
                    at -= piece[1]
                out.reverse()
                results.append(array.array("I", out).tobytes())
            low = high + 1
        return results

    def _path(self, text: str, last: list) -> list[int]:
        out: list[int] = []
        at = len(text)
        while at:
            piece = last[at]
            if piece is not None:
                out.append(piece[0])
                at -= piece[1]
                continue
            if self.whole_bytes:
                out.extend(self.bytes[b] for b in reversed(text[at - 1].encode("utf-8", "surrogatepass")))
            else:
                out.append(self.unknown)
            at -= 1
        out.reverse()
        return out

    def _with_unknown(self, text: str) -> list:
        """Best last piece at each position, None for an unknown character: one that no way of pieces ends with."""
        n = len(text)
        best, last = [-1e300] * (n + 1), [None] * (n + 1)
        best[0] = 0
        done, penalty = 0, self.lowest - round(UNKNOWN_PENALTY * FIXED_POINT)

        def close(to: int, done: int) -> int:
            while done < to:
                done += 1
                if last[done] is None:
                    best[done] = best[done - 1] + penalty
            return done

        for end, piece in self.automaton.iter(text):
            done = close(end, done)
            total = best[end + 1 - piece[1]] + piece[2]
            if total > best[end + 1]:
                best[end + 1] = total
                last[end + 1] = piece
        close(n, done)
        return last

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        found = self._segment_all([(c[1:] if c[0] == "\n" else c).replace(" ", MARK) for c in chunks])
        return [self._line_feed + f if c[0] == "\n" else f for c, f in zip(chunks, found)]

    def encode(self, text: str) -> bytes:
        """Ids, four bytes each."""
        if MARK in text:  # a mark in the text may join with those that stand for spaces
            return array.array("I", self.segment((" " + text).replace(" ", MARK))).tobytes()
        return self.cache.ids(text)

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; bytes that are no UTF-8 become replacement characters."""
        table = self.as_bytes
        text = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for every row; ids: array of int, null for a null text."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            for at in range(0, len(whole), 1000):
                b = whole.slice(at, 1000)
                raw = [None if t is None else model.encode(t) for t in b.column(1).to_pylist()]
                ends = np.append(0, np.cumsum([len(r or b"") // 4 for r in raw])).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(r or b"" for r in raw), np.int32))
                null = pa.array([r is None for r in raw], pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), flat, mask=null)], ["id", "ids"])

    return over_texts(picked, run, f"id {picked.schema['id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode(coded: DataFrame, path: str | None = None, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """All columns of ``coded`` with the ids' text as the last one (named text, made free of clashes); null for null ids."""
    names = coded.columns
    at, text = names.index(ids_col), fresh(text_col, names)
    path = path or model_path()
    schema = coded.select("*", F.lit(None).cast("string").alias(text)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            for k in range(0, len(whole), 1000):
                b = whole.slice(k, 1000)
                col = b.column(at)
                ends, flat, valid = col.offsets.to_numpy(), col.values.to_numpy(), col.is_valid().to_pylist()
                texts = [model.decode(flat[ends[i] : ends[i + 1]]) if valid[i] else None for i in range(len(b))]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*names, text])

    return over_texts(coded, run, schema)


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """The ids of every document, their number, and the checksum of the text that they decode to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    back = decode(encode(docs))
    return back.select("doc_id", F.size("ids").alias("n_ids"), F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"), "ids")
