"""Packing documents into fixed-length token sequences: online best fit over a bounded number of open windows.

1. One pass over the documents, in each partition: a document's ids (with the end id) are cut into full windows and a rest.
   The rest goes to the open window that it fills best; if it fits none and all ``windows`` are open, the fullest is emitted.
   Pieces are written once, with the windows that were still open at a partition's end marked as leftovers.
2. Leftover windows of ``MERGE`` partitions at a time are taken apart and their pieces packed again, largest first into the
   fullest window with room. Only piece sizes move; each group is bounded by MERGE x windows x window length.

Only documents longer than a window are cut. A partition's windows cost ``windows`` x ``length`` ids of memory at most.

Nulls, ties: a null text is empty, and an empty text is its end id. Each row is packed, so repeated rows, null and repeated ids
are all kept. Of equally good windows the oldest is taken. Extra columns are ignored. No rows give no pieces. Sequence numbers
are unique but have gaps; they follow the input's partitions.
"""

from __future__ import annotations

import array
import bisect
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize, over_texts

LENGTH = 2048
WINDOWS = 64
MERGE = 16
END_ID = 1


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: What the byte-level pre-tokenizer splits at, a fixed value of the format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Bytes of ids that a worker keeps of lines it has met, in each of two generations.
CACHE_BYTES = 8_000_000

#: A line break between two characters other than white space: the pattern never joins characters across it.
_LINE = re.compile(r"(?<=\S)(?=\n\S)")


class Encoder:
    """Byte-level BPE of a tokenizers JSON file whose merges rank as its ids do, run by tiktoken's merge loop.

    ``ids`` gives the same ids as ``tokenizers`` in its default setting, where the file's added tokens stand for themselves,
    ``plain_ids`` those with ``encode_special_tokens``, several times faster. Corpora repeat lines (copies, shared passages), so
    the ids of the last lines are kept.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, added = spec["model"]["vocab"], spec.get("added_tokens") or []
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that depend on the text around them are not supported")
        self.added = {t["content"]: array.array("I", [t["id"]]).tobytes() for t in added if t["content"]}
        # where several fit, the longest counts
        self.split = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})") if self.added else None
        # the format writes bytes as printable characters: printable Latin-1 ones as themselves, the others from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(plain))}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items()}
        self.bpe = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def ids(self, text: str) -> bytes:
        """The text's ids, four bytes each: added tokens as themselves, the parts between them each on its own."""
        if not self.split or not any(t in text for t in self.added):
            return self.plain_ids(text)
        parts = self.split.split(text)
        return b"".join(self.added[p] if k % 2 else self.plain_ids(p) for k, p in enumerate(parts) if p)

    def plain_ids(self, text: str) -> bytes:
        """The text's ids, four bytes each, with added tokens coded as any other text."""
        out = []
        for line in _LINE.split(text) if "\n" in text else [text]:
            found = self.now.get(line)
            if found is None:
                found = self.old.get(line)
                if found is None:
                    found = array.array("I", self.bpe.encode_ordinary(line)).tobytes()
                if len(found) < CACHE_BYTES // 100:
                    if self.held > CACHE_BYTES:
                        self.old, self.now, self.held = self.now, {}, 0
                    self.now[line] = found
                    self.held += len(found) + len(line)
            out.append(found)
        return b"".join(out)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_ids(text: str | None, path: str, added: bool = False) -> np.ndarray:
    """The text's ids, uint32, without the end id. ``added``: as they are packed, with the file's added tokens as themselves."""
    own = encoder(path)
    return np.frombuffer((own.ids if added else own.plain_ids)(text or ""), np.uint32)


class Packer:
    """Open windows of one partition. ``place`` gives the window and offset of a piece, ``emitted`` those that are closed."""

    def __init__(self, length: int, windows: int) -> None:
        self.length, self.windows = length, windows
        self.room: list[tuple[int, int]] = []  # (room, window), sorted
        self.next = 0

    def full(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, size: int) -> tuple[int, int]:
        """(window, offset) for a piece of less than a window's length."""
        at = bisect.bisect_left(self.room, (size, -1))
        if at == len(self.room):
            if len(self.room) >= self.windows:
                self.room.pop(0)  # the fullest
            window, room = self.full(), self.length
        else:
            room, window = self.room.pop(at)
        if room > size:
            bisect.insort(self.room, (room - size, window))
        return window, self.length - room


PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, part int, win long, offset long, open boolean"


def cut_and_place(docs: DataFrame, path: str, length: int, windows: int, id_col: str, text_col: str) -> DataFrame:
    """Step 1: one row a piece."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    end_id = END_ID

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        pack, cache = Packer(length, windows), encoder(path)
        end = end_id.to_bytes(4, "little")
        waiting: dict[int, list[tuple]] = {}  # rows of windows that are still open
        kept_ids = pa.array([], pa.int64())

        def table(rows: list[tuple], ids: pa.Array, is_open: bool) -> pa.RecordBatch:
            cols = list(zip(*rows))
            n = len(rows)
            arrays = [ids.take(pa.array(cols[0], pa.int64())), *[pa.array(c, pa.int64()) for c in cols[1:5]], pa.array(np.full(n, part, np.int32)), *[pa.array(c, pa.int64()) for c in cols[5:7]], pa.array(np.full(n, is_open))]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "win", "offset", "open"])

        for b in batches:
            # ids of rows of earlier batches that still wait come first
            held = [r for w in waiting.values() for r in w]
            ids = pa.concat_arrays([kept_ids.take(pa.array([r[0] for r in held], pa.int64())), b.column(0)]) if held else b.column(0)
            at = iter(range(len(held)))
            waiting = {w: [(next(at), *r[1:]) for r in rows] for w, rows in waiting.items()}
            base, done = len(held), []
            kept_ids = ids
            for k, text in enumerate(b.column(1)):
                own = memoryview(cache.ids(text.as_py() or "") + end)
                n = len(own) // 4
                for s in range(0, n - n % length, length):
                    done.append((base + k, s, length, zlib.crc32(own[4 * s : 4 * (s + length)]), n, pack.full(), 0))
                if rest := n % length:
                    s = n - rest
                    window, offset = pack.place(rest)
                    waiting.setdefault(window, []).append((base + k, s, rest, zlib.crc32(own[4 * s :]), n, window, offset))
            still = {w for _, w in pack.room}
            for w in [w for w in waiting if w not in still]:
                done += waiting.pop(w)
            if done:
                yield table(done, ids, False)
        if rows := [r for w in waiting.values() for r in w]:
            yield table(rows, kept_ids, True)

    return over_texts(picked, run, PIECES.format(id=kind))


def best_fit_decreasing(size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each piece, largest first into the fullest window with room."""
    window, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    pack = Packer(length, len(size) + 1)
    for i in np.argsort(-size, kind="stable"):
        window[i], offset[i] = (pack.full(), 0) if size[i] == length else pack.place(int(size[i]))
    return window, offset


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, windows: int = WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = materialize(cut_and_place(docs, path or vocabulary_path(), length, windows, id_col, text_col), "pieces")
    closed = pieces.where("not open").withColumn("sequence_id", F.shiftleft(F.col("part").cast("long") * 2, 32) + F.col("win"))
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by([("part", "ascending"), ("win", "ascending"), ("offset", "ascending")])
        lot = group.column("part")[0].as_py() // MERGE
        window, offset = best_fit_decreasing(group.column("length").to_numpy(), length)
        seq = ((lot * 2 + 1) << 32) + window
        out = group.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return out.append_column("sequence_id", pa.array(seq, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    result = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    merged = pieces.where("open").withColumn("lot", F.floor(F.col("part") / MERGE)).groupBy("lot").applyInArrow(merge, result)
    return closed.select(*merged.columns).unionByName(merged)


def op10_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
