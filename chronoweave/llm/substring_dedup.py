"""Repeated passages: every window of ``WINDOW`` words that stands somewhere earlier is removed.

1. Rows are dealt into blocks of about ``BLOCK_BYTES`` of text at random, so no key, source or group of copies makes a block large.
2. A task takes a block: the Rabin-Karp hash of each window (two polynomials over the hashes of its words, 80 bits together) comes
   from running sums. Of a window that repeats within the block the first stands for all. The block's distinct hashes, sorted, go out
   in runs: one message for each range of hash values, with the document of each hash.
3. A task takes a range and counts: of a hash that several blocks sent, the earliest document has the first. Each message is
   answered with one bit a hash: whether the window stands earlier in another block.
4. A block meets its answers. Windows that begin earlier anywhere merge into maximal intervals of words, which are cut out.

The texts are shuffled once, steps 2 and 4 read the same exchange; hashes move once, some 10 bytes a window. Blocks and ranges hold a
bounded number of words each. There are at most as many messages as stretches of ``MESSAGE_BYTES`` of text: blocks grow with the
root of the input from about 2 TB on. Two different windows have the same 80 bits with probability 10**-24.

Order: ids ascending, a null id last; rows that share an id by a 16-bit hash of their text, then in no stated order (equal rows
give the same results either way). Null and empty texts have no words; texts shorter than a window stay whole. A row
comes back for each row given. Texts of any length are read whole, each in one task. No rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import slices, utf8
from ._words import PLAIN, hash_runs, mix, words

WINDOW = 20
#: Text bytes of a block, and of the windows whose hashes fall into one range.
BLOCK_BYTES = 12_000_000
#: Text bytes for each message, at least.
MESSAGE_BYTES = 150
#: Odd multipliers of the two polynomials modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: The id that a null one counts as.
LAST = np.iinfo(np.int64).max

_powers: dict[tuple[int, int], np.ndarray] = {}


def _power(base: int, sign: int, n: int) -> np.ndarray:
    """base**(sign * i) modulo 2**64 for i below n."""
    if len(_powers.get((base, sign), ())) < n:
        a = np.full(n, base if sign > 0 else pow(base, -1, 1 << 64), np.uint64)
        a[0] = 1
        _powers[base, sign] = np.multiply.accumulate(a)
    return _powers[base, sign][:n]


def rolling(values: np.ndarray, starts: np.ndarray, width: int, base: int) -> np.ndarray:
    """The hash of values[start : start + width] for each start."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, 1, len(values)), out=total[1:])
    return mix((total[starts + width] - total[starts]) * _power(base, -1, len(values) + 1)[starts])


def windows(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (text, first byte, end) of texts in one buffer, and windows (first word, 64 bits, 16 more bits), all in order."""
    doc, start, end = words(data, offsets)
    first = np.flatnonzero(doc[: max(0, len(doc) - width + 1)] == doc[width - 1 :]) if len(doc) >= width else np.zeros(0, np.int64)
    if not len(first):
        return doc, start, end, first, np.zeros(0, np.uint64), np.zeros(0, np.uint16)
    value = hash_runs(data, start, end, PLAIN)
    return doc, start, end, first, rolling(value, first, width, BASES[0]), (rolling(mix(value ^ np.uint64(BASES[1])), first, width, BASES[1]) >> np.uint64(48)).astype(np.uint16)


def in_order(block: pa.Table) -> pa.RecordBatch:
    """A block's rows (id, tie, text) in order of documents."""
    block = block.select(["id", "tie", "text"]).set_column(0, "order", block.column("id").fill_null(LAST)).append_column("id", block.column("id"))
    got = block.sort_by([("order", "ascending"), ("tie", "ascending"), ("text", "ascending")]).combine_chunks().to_batches()
    return got[0] if got else pa.RecordBatch.from_pylist([], schema=block.schema)


class Block:
    """The windows of a block's texts: ``order`` sorts them by hash, the earlier first; ``new`` marks in that order the first of each
    distinct hash; ``doc`` is each window's text."""

    def __init__(self, rows: pa.RecordBatch, width: int) -> None:
        docs, h, g, at = [], [], [], 0
        for part in slices(rows, rows.schema.get_field_index("text")):
            doc, _, _, first, a, b = windows(*utf8(part.column("text")), width)
            docs.append((doc[first] + at).astype(np.int32))
            h.append(a)
            g.append(b)
            at += len(part)
        self.doc = np.concatenate([np.zeros(0, np.int32), *docs])
        h, g = np.concatenate([np.zeros(0, np.uint64), *h]), np.concatenate([np.zeros(0, np.uint16), *g])
        order = np.argsort(g, kind="stable")
        self.order = order[np.argsort(h[order], kind="stable")]
        h, g = h[self.order], g[self.order]
        self.new = np.ones(len(h), bool)
        self.new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        self.h, self.g = h[self.new], g[self.new]


def _planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then all second bytes and so on: high bytes of small numbers are runs of zeros to the shuffle's codec."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unplaned(data: memoryview, n: int, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, n).T).view(kind).reshape(n)


def message(h: np.ndarray, g: np.ndarray, doc: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> bytes:
    """Sorted hashes with the order of their documents."""
    used, at = np.unique(doc, return_inverse=True)
    parts = [_planes(np.diff(h, prepend=np.uint64(0))), g.tobytes(), _planes(at.astype(np.uint32)), _planes(np.diff(ids[used].view(np.uint64), prepend=np.uint64(0))), ties[used].astype(np.uint16).tobytes()]
    return b"".join([np.array([len(h), len(used)], np.uint32).tobytes(), *parts])


def opened(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, more bits, id, tie) of each window of a message."""
    n, m = map(int, np.frombuffer(data, np.uint32, 2))
    view, ends = memoryview(data), np.cumsum([8, 8 * n, 2 * n, 4 * n, 8 * m, 2 * m])
    h, g, at, ids, ties = (view[a:b] for a, b in zip(ends, ends[1:]))
    at = _unplaned(at, n, np.uint32)
    return np.cumsum(_unplaned(h, n, np.uint64)), np.frombuffer(g, np.uint16), np.cumsum(_unplaned(ids, m, np.uint64)).view(np.int64)[at], np.frombuffer(ties, np.uint16)[at]


def seen_earlier(messages: list[bytes], blocks: np.ndarray) -> list[bytes]:
    """For each message the bits of its hashes: does another one hold the same for an earlier document?"""
    parts = [opened(m) for m in messages]
    h, g, ids, ties = (np.concatenate([p[i] for p in parts]) for i in range(4))
    block = np.repeat(blocks, [len(p[0]) for p in parts])
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    rows = order[twice]
    rows = rows[np.lexsort((block[rows], ties[rows], ids[rows], g[rows], h[rows]))]
    bits = np.zeros(len(h), bool)
    bits[rows[1:]] = (h[rows[1:]] == h[rows[:-1]]) & (g[rows[1:]] == g[rows[:-1]])
    ends = np.cumsum([0, *[len(p[0]) for p in parts]])
    return [np.packbits(bits[a:b]).tobytes() for a, b in zip(ends, ends[1:])]


def intervals(start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [begin, end) of the words that the windows from ``start`` (ascending) on cover."""
    if not len(start):
        return start, start
    cut = np.flatnonzero(start[1:] > start[:-1] + width)
    return start[np.append(0, cut + 1)], start[np.append(cut, len(start) - 1)] + width


def without(rows: pa.RecordBatch, gone: np.ndarray, width: int) -> pa.RecordBatch:
    """The block's rows: id, n_words, removed intervals of words, and the remaining words joined by single spaces. gone: windows to remove."""
    n_words, removed, begin, end, texts, at, done = [], [], [], [], [], 0, 0
    for part in slices(rows, rows.schema.get_field_index("text")):
        data, offsets = utf8(part.column("text"))
        doc, first_byte, last_byte, first, _, _ = windows(data, offsets, width)
        here = first[gone[done : done + len(first)]]
        done += len(first)
        # a window never reaches into the next text, but runs of two texts may touch
        new_text = np.searchsorted(doc, np.arange(len(part) + 1))
        kept = np.ones(len(doc), bool)
        for k in np.unique(doc[here]):
            a, b = intervals(here[slice(*np.searchsorted(here, new_text[k : k + 2]))], width)
            begin.append(a - new_text[k])
            end.append(b - new_text[k])
            removed.append((at + k, len(a)))
            for i, j in zip(a, b):
                kept[i:j] = False
        n_words.append(np.diff(new_text))
        step = np.zeros(len(data) + 1, np.int8)
        step[first_byte[kept]] += 1
        step[last_byte[kept]] -= 1
        # each kept word and one space
        size = (last_byte - first_byte + 1)[kept]
        out = np.full(size.sum(), 32, np.uint8)
        letter = np.ones(len(out), bool)
        letter[np.cumsum(size) - 1] = False
        out[letter] = data[np.cumsum(step[:-1], dtype=np.int8).astype(bool)]
        size = np.bincount(doc[kept], weights=size, minlength=len(part)).astype(np.int64)
        whole = out.tobytes()
        texts += [whole[b - n : b - 1].decode() if n else "" for b, n in zip(np.cumsum(size), size)]
        at += len(part)
    count = np.zeros(len(rows), np.int64)
    for k, n in removed:
        count[k] = n
    runs = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (begin, end)], ["begin", "end"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), runs)
    return pa.RecordBatch.from_arrays([rows.column("id"), pa.array(np.concatenate([np.zeros(0, np.int64), *n_words]).astype(np.int64)), lists, pa.array(texts, pa.string())], ["id", "n_words", "removed", "text"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, removed array<struct<begin, end>>, text) for every row: the removed intervals of words, and what is left."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(1, math.ceil(total / max(block_bytes, math.sqrt(MESSAGE_BYTES * total))))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.hash(text).bitwiseAND(0xFFFF).alias("tie"), text.alias("text"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int").alias("block"))

    def send(rows: pa.Table) -> pa.Table:
        number, rows = rows.column("block")[0].as_py(), in_order(rows)
        b = Block(rows, width)
        doc, ids, ties = b.doc[b.order[b.new]], rows.column("order").to_numpy(), rows.column("tie").to_numpy()
        # ranges of equal size over the upper half of the hash
        ends = np.append(np.searchsorted(b.h >> np.uint64(32), np.array([-(-(k << 32) // n) for k in range(n)], np.uint64)), len(b.h))
        full = np.flatnonzero(np.diff(ends))
        data = [message(b.h[i:j], b.g[i:j], doc[i:j], ids, ties) for i, j in ((ends[k], ends[k + 1]) for k in full)]
        return pa.table({"block": pa.array(np.full(len(full), number, np.int32)), "part": pa.array(full.astype(np.int32)), "data": pa.array(data, pa.binary())})

    def answer(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        return pa.table({"block": rows.column("block"), "part": rows.column("part"), "data": pa.array(seen_earlier(rows.column("data").to_pylist(), rows.column("block").to_numpy()), pa.binary())})

    def cut(rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows = in_order(rows)
        b = Block(rows, width)
        h = b.h >> np.uint64(32)
        seen = np.zeros(len(b.h), bool)
        for part, data in zip(answers.column("part").to_pylist(), answers.column("data").to_pylist()):
            i, j = np.searchsorted(h, np.array([-(-(part << 32) // n), -(-((part + 1) << 32) // n)], np.uint64))
            seen[i:j] = np.unpackbits(np.frombuffer(data, np.uint8), count=j - i)
        gone = np.zeros(len(b.order), bool)
        gone[b.order] = seen[np.cumsum(b.new) - 1] | ~b.new
        return pa.Table.from_batches([without(rows, gone, width)])

    kind = "block int, part int, data binary"
    answers = rows.groupBy("block").applyInArrow(send, kind).groupBy("part").applyInArrow(answer, kind)
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(cut, "id long, n_words long, removed array<struct<begin: long, end: long>>, text string")


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of 20 words that stand earlier."""
    got = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    return got.select(F.col("id").alias("doc_id"), "n_words", size.alias("n_removed"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: Windows as texts, numbered in order of their documents; a word is removed that a window of a number above 1 covers.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (SELECT r, unnest(range(1, len(w) - 18)) AS i, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS s FROM d WHERE len(w) >= 20
), n AS (SELECT r, i, row_number() OVER (PARTITION BY s ORDER BY r, i) AS n FROM s
), g AS (SELECT DISTINCT r, i + k AS i FROM (SELECT r, i, unnest(range(20)) AS k FROM n WHERE n > 1)
), p AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d
), k AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM p ANTI JOIN g USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
