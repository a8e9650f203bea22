"""Near-duplicates of texts: BagMinHash signatures of word-shingle multisets, banding, exact verification.

Steps, all on Spark:

1. One pass over the texts gives each a 128-bit hash of its word sequence and, per band, a hash of its signature's registers.
2. Texts with equal word sequences form a class, named by its smallest id; only class names go on.
3. Classes that share a band meet: each bucket's smallest id is paired with all others of the bucket (pairs grow linearly in
   the bucket, however large).
4. Each pair's multisets are compared exactly: weighted Jaccard, sum of minima over sum of maxima, at least ``threshold``.
5. Linked classes are united. A bucket that still holds several components may hide links that its smallest id does not show:
   small buckets give all their pairs across components (a bounded number for each member), large ones are cut into blocks of
   bounded size, pairs of blocks are compared inside tasks, and only links that join components leave them. Blocks of one and
   the same component never meet, so the work is linear where a bucket is one large component and a few strays.
6. Classes and components go back to every row.

Signature (Ertl, 2018, "BagMinHash"): each shingle of weight w owns independent Poisson processes over the dyadic slices of
its weight axis, (0,1], (1,2], (2,4], ...; a point has a time, a register and a position within its slice, and counts if the
position is at most w. A register keeps the element of its earliest point; two multisets agree there with probability equal to
their weighted Jaccard similarity, without bias. Points later than a bound are never drawn: the bound is chosen from the total
weight so that every register is reached, and raised where one is not.

Nulls and ties: a null, empty or blank text, or a row with a null id, links with nothing and is its own component (null for a
null id), ``kept`` true. A text with fewer words than a shingle has one shingle, all its words. Rows that share an id are each judged by their
own text. Ties go to the smallest id. Extra columns are ignored. Memory of a task follows its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _words
from ._common import by_size, fresh, materialize, over_texts, release, slices, utf8, written
from ._graph import components

WIDTH = 5
THRESHOLD = 0.8
BANDS = 25
ROWS = 5
#: Ids that a broadcast may hold (8 bytes each, some 40 in a hash relation).
BROADCAST_IDS = 500_000
#: Members up to which a bucket gives its pairs; larger ones are compared in blocks of BLOCK members.
SMALL_BUCKET = 8
BLOCK = 256
BLOCK_WORDS = 500_000
#: Members that a hash deals into one lot, on average: most lots are one block.
LOT = 200
#: Pairs with the same first text that one task compares, on average.
PART = 256

_U = np.uint64


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """BagMinHash registers, uint64 (n, m), of n multisets given as sorted (doc, value, weight) rows; 0 for an empty one."""
    out = np.zeros((n, m), np.uint64)
    total = np.bincount(doc, weights=weight, minlength=n)
    # dyadic slices of the weight axis: number 0 is (0, 1], number j is (2**(j-1), 2**j]
    levels = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    if levels.size and levels.max() > 1:
        row = np.repeat(np.arange(len(doc)), levels)
        level = np.arange(len(row)) - np.repeat(np.cumsum(levels) - levels, levels)
        doc, value, weight = doc[row], value[row], weight[row]
    else:
        level = np.zeros(len(doc), np.int64)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    rate = np.where(level == 0, 1.0, low)  # the slice's length
    seed = _words.mix(value + _U(0xA0761D6478BD642F) * (level.astype(np.uint64) + _U(1)))
    slack = 5.0
    todo = np.flatnonzero(total > 0)
    while len(todo):
        limit = np.full(n, -1.0)
        limit[todo] = (np.log(m) + slack) / total[todo]
        at = np.flatnonzero(limit[doc] > 0)
        time, step = np.zeros(len(at)), 0
        ds, ts, ks, vs = [], [], [], []
        while len(at):
            step += 1
            h = _words.mix(seed[at] + _U(0xE7037ED1A0B428DB * step % 2**64))
            time = time - np.log(_uniform(h)) / (rate[at] * m)
            go = time <= limit[doc[at]]
            at, time, h = at[go], time[go], h[go]
            g = _words.mix(h + _U(0x8EBC6AF09C88C6E3))
            take = np.ones(len(at), bool)
            deep = np.flatnonzero(level[at] > 0)
            if len(deep):
                a = at[deep]
                take[deep] = low[a] + (1 - _uniform(_words.mix(g[deep] + _U(0x589965CC75374CC3)))) * rate[a] <= weight[a]
            hit = at[take]
            ds.append(doc[hit])
            ts.append(time[take])
            ks.append((g[take] % _U(m)).astype(np.int64))
            vs.append(h[take])
        d, t, k, v = map(np.concatenate, (ds, ts, ks, vs)) if ds else (np.zeros(0, np.int64),) * 4
        slot = d * m + k
        first = np.full(n * m, np.inf)
        np.minimum.at(first, slot, t)
        won = t == first[slot]
        flat = np.zeros(n * m, np.uint64)
        flat[slot[won]] = v[won]
        full = np.isfinite(first).reshape(n, m).all(axis=1)
        good = todo[full[todo]]
        out[good] = flat.reshape(n, m)[good]
        todo = todo[~full[todo]]
        slack *= 2
    return out


def _fingerprints(data: np.ndarray, offs: np.ndarray, width: int, bands: int, rows: int):
    """Per text: number of words, two hashes of the word sequence, hashes of the bands."""
    n = len(offs) - 1
    doc, starts, ends = _words.words(data, offs)
    h = _words.hash_runs(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    place = (np.arange(len(doc)) - first[doc]).astype(np.uint64)
    whole = np.zeros((2, n), np.uint64)
    for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
        part = _words.mix(h * _U(2 * k + 1) + (place + _U(1)) * _U(salt))
        run = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(part, out=run[1:])
        whole[k] = _words.mix(run[first + count] - run[first] + count.astype(np.uint64))
    sig = signatures(*_words.counted(*_words.shingles(doc, h, width)), n, bands * rows).reshape(n, bands, rows)
    acc = np.zeros((n, bands), np.uint64)
    for r in range(rows):
        acc = _words.mix(acc * _U(0xFF51AFD7ED558CCD) + sig[:, :, r])
    return count, whole[0], whole[1], _words.mix(acc + np.arange(bands, dtype=np.uint64))


def fingerprint(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_words, h1, h2, bands) for every row; bands is empty for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 1):
                data, offs = utf8(b.column(1))
                count, h1, h2, band = _fingerprints(data, offs, width, bands, rows)
                ends = np.append(0, np.cumsum(np.where(count > 0, bands, 0))).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(band[count > 0].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count.astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), keys], ["id", "n_words", "h1", "h2", "bands"])

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return over_texts(picked, run, "id long, n_words int, h1 long, h2 long, bands array<long>")


def _bag(text: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    doc, starts, ends = _words.words(data, np.array([0, len(data)]))
    h = _words.hash_runs(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    _, v, w = _words.counted(*_words.shingles(doc, h, width))
    return v, w


def _similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / max(1, int(a[1].sum() + b[1].sum()) - both)


def similarity(a: str, b: str, width: int = WIDTH) -> float:
    """Weighted Jaccard similarity of two texts' shingle multisets."""
    return _similarity(_bag(a, width), _bag(b, width))


def verify(pairs: DataFrame, texts: DataFrame, threshold: float, width: int = WIDTH) -> DataFrame:
    """The (a, b) of ``pairs`` (a, b, part) whose texts in ``texts`` (id, text) reach the threshold.

    Rows with one ``a`` and ``part`` stand together behind one row with the text of ``a``: that text moves once a part, not once
    a pair, and the parts of a frequent ``a`` are different tasks' work.
    """
    text = texts.select(F.col("id").alias("of"), "text")
    first = pairs.select("a", "part").distinct().withColumn("b", F.lit(None).cast("long")).join(text, F.col("a") == F.col("of")).select("a", "part", "b", "text")
    rows = pairs.join(text, F.col("b") == F.col("of")).select("a", "part", "b", "text").unionByName(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bag = None
        for batch in batches:
            a, b = batch.column(0), batch.column(2)
            hit = []
            for y, text in zip(b.to_pylist(), batch.column(3)):
                own = _bag(text.as_py(), width)
                if y is None:
                    bag = own
                hit.append(y is not None and _similarity(bag, own) >= threshold)
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return over_texts(rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first()), run, "a long, b long")


def _part(often: Column) -> Column:
    """Which part of its bucket's pairs a pair belongs to: parts hold some PART pairs with the same ``a``."""
    return F.pmod(F.xxhash64("b"), F.ceil(often / PART)).cast("int").alias("part")


def _through_least(member: DataFrame) -> DataFrame:
    """(a, b, part): every member (key, id) of a bucket with the bucket's smallest id."""
    least = member.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z"), F.count("*").alias("n")).where("a < z").select("key", "a", "n")
    pairs = member.join(least, "key").where("id <> a").groupBy("a", F.col("id").alias("b")).agg(F.max("n").alias("n"))
    return pairs.select("a", "b", _part(F.col("n")))


def _small_across(member: DataFrame) -> DataFrame:
    """(a, b, part): members (key, id, comp) of one bucket in different components; meant for buckets of a bounded size."""
    right = member.select("key", F.col("id").alias("b"), F.col("comp").alias("other"))
    pairs = member.join(right, "key").where("comp < other").select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
    return pairs.select("a", "b", F.lit(0).alias("part"))


def _block_tasks(member: DataFrame, n_keys: int) -> DataFrame:
    """(task, side, id, comp): each bucket cut into blocks; a task is a pair of blocks that may hold different components.

    A component with many members in the bucket has blocks of its own, the others share some. Members are dealt into lots by a
    hash, and each lot is cut where the running sum of its members' weights passes a whole number: a block holds BLOCK texts and
    BLOCK_WORDS words at most, and one text more.
    """
    size = member.groupBy("key", "comp").agg(F.count("*").alias("c"))
    own = F.col("c") * 2 >= BLOCK
    strays = by_size(size.where(~own).groupBy("key").agg(F.sum("c").alias("strays")), n_keys, BROADCAST_IDS)
    sized = size.join(strays, "key", "left").select("key", "comp", own.alias("own"), F.ceil(F.when(own, F.col("c")).otherwise(F.col("strays")) / LOT).alias("lots"))
    dealt = member.join(sized, ["key", "comp"]).withColumns({"only": F.when(F.col("own"), F.col("comp")), "lot": F.pmod(F.xxhash64("id"), F.col("lots"))})
    # what a member takes of a block
    weight = F.greatest(F.lit(1.0 / BLOCK), F.col("n_words") / F.lit(float(BLOCK_WORDS)))
    reach = F.sum(weight).over(Window.partitionBy("key", "only", "lot").orderBy("id"))
    placed = dealt.withColumn("blk", F.concat_ws(":", F.coalesce(F.col("only").cast("string"), F.lit("*")), F.col("lot").cast("string"), F.ceil(reach - 1e-9).cast("string"))).select("key", "id", "comp", "blk", "only")
    blocks = placed.select("key", "blk", "only").distinct()
    other = blocks.select("key", F.col("blk").alias("blk2"), F.col("only").alias("only2"))
    pairs = blocks.join(other, "key").where("blk <= blk2 and not coalesce(only = only2, false)").select("key", "blk", "blk2", F.xxhash64("key", "blk", "blk2").alias("task"))
    sides = pairs.select("key", "blk", "task", F.lit(0).alias("side")).unionByName(pairs.where("blk <> blk2").select("key", F.col("blk2").alias("blk"), "task", F.lit(1).alias("side")))
    return placed.join(sides, ["key", "blk"]).select("task", "side", "id", "comp")


def _joining(ids: np.ndarray, comp: np.ndarray, side: np.ndarray, data: np.ndarray, offs: np.ndarray, threshold: float, width: int) -> list[tuple[int, int]]:
    """Links of one task that join different components: a spanning forest of them."""
    doc, starts, ends = _words.words(data, offs)
    h = _words.hash_runs(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    doc, value, weight = _words.counted(*_words.shingles(doc, h, width))
    total = np.bincount(doc, weights=weight, minlength=len(ids))
    # an element of weight w counts as w different ones
    row = np.repeat(np.arange(len(doc)), weight)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(weight) - weight, weight)
    unit = _words.mix(value[row] + nth.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    _, column, often = np.unique(unit, return_inverse=True, return_counts=True)
    shared = often[column] > 1
    at, column = doc[row][shared], column[shared]
    both = np.zeros((len(ids), len(ids)), np.float32)
    if len(at):
        _, column = np.unique(column, return_inverse=True)
        order = np.argsort(column, kind="stable")
        at, column = at[order], column[order]
        for low in range(0, int(column[-1]) + 1, 4096):
            i, j = np.searchsorted(column, [low, low + 4096])
            grid = np.zeros((len(ids), 4096), np.float32)
            grid[at[i:j], column[i:j] - low] = 1
            both += grid @ grid.T
    similar = both >= threshold * (total[:, None] + total[None, :] - both) - 1e-9
    similar &= comp[:, None] != comp[None, :]
    if side.any():
        similar &= side[:, None] != side[None, :]
    root = {int(c): int(c) for c in comp}

    def top(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    for i, j in zip(*np.nonzero(np.triu(similar))):
        x, y = top(int(comp[i])), top(int(comp[j]))
        if x != y:
            root[x] = y
            out.append((int(ids[i]), int(ids[j])))
    return out


def _links_in_blocks(tasks: DataFrame, texts: DataFrame, threshold: float, width: int) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        text = group.column("text").chunk(0) if len(group) else pa.array([], pa.string())
        data, offs = utf8(text)
        got = _joining(group.column("id").to_numpy(), group.column("comp").to_numpy(), group.column("side").to_numpy(), data, offs, threshold, width)
        return pa.table({"a": pa.array([x for x, _ in got], pa.int64()), "b": pa.array([y for _, y in got], pa.int64())})

    return tasks.join(texts, "id").groupBy("task").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, h1, h2, class_id, component_id, kept) for every row of ``docs``.

    class_id: smallest id with the same word sequence; component_id: smallest id reachable by links; kept: id = component_id.
    """
    return _groups(docs, id_col, text_col, threshold, width, bands, rows)[0]


def _groups(docs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, int]:
    """What ``near_duplicates`` gives, and its number of rows."""
    prints, n = written(fingerprint(docs, id_col, text_col, width, bands, rows), "prints")
    usable = prints.where("n_words > 0 and id is not null")
    by_words = usable.groupBy("h1", "h2").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"), F.max("n_words").alias("n_words"), F.min_by("bands", "id").alias("bands"))
    classes, n_classes = written(by_words, "classes", _files(n, 20))
    member = classes.select(F.col("class_id").alias("id"), "n_words", F.explode("bands").alias("key"))
    # one text for each class name; a repeated id may name several classes, each with its own text
    pairs, n_pairs = written(_through_least(member), "pairs", _files(n_classes * bands, 500))
    texts = _texts(docs, pairs, id_col, text_col)
    links = materialize(verify(pairs, texts, threshold, width), "links", _files(n_pairs, 5))
    release(texts)
    comp, n_comp = components(links, "a", "b")
    # buckets that hold several components; of those with the same members one is enough
    now = _with_components(member, comp, n_comp)
    mixed = now.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.bit_xor(F.xxhash64("id")).alias("x")).where("lo < hi")
    mixed, n_mixed = written(mixed.groupBy("n", "lo", "hi", "x").agg(F.min("key").alias("key")).select("key", "n"), "mixed", _files(n_classes * bands, 500))
    if n_mixed:
        held, n_held = written(now.join(by_size(mixed, n_mixed, BROADCAST_IDS), "key"), "held", _files(n_classes * bands, 200))
        small, large = held.where(F.col("n") <= SMALL_BUCKET), held.where(F.col("n") > SMALL_BUCKET)
        rest = materialize(_small_across(small).join(by_size(pairs.select("a", "b"), n_pairs, BROADCAST_IDS), ["a", "b"], "left_anti"), "pairs", _files(n_held * SMALL_BUCKET, 200))
        tasks = materialize(_block_tasks(large, n_mixed), "tasks", _files(n_held, 20))
        texts = _texts(docs, rest, id_col, text_col, tasks.select("id"))
        more = materialize(verify(rest, texts, threshold, width).unionByName(_links_in_blocks(tasks, texts, threshold, width)), "links", _files(n_held, 5))
        release(texts, held, rest, tasks)
        both = materialize(links.unionByName(more), "links", _files(n_pairs + n_held, 500))
        comp, n_comp = components(both, "a", "b")
        release(more)
    # only classes with copies or links say more than the row itself
    named = _with_components(classes.select(F.col("class_id").alias("id"), "h1", "h2", "copies"), comp, n_comp).where("copies > 1 or comp <> id")
    named, n_named = written(named.select("h1", "h2", F.col("id").alias("class_id"), F.col("comp").alias("component_id")), "named", _files(n_classes, 100))
    release(classes, pairs, links, mixed)
    out = (
        prints.select("id", "n_words", "h1", "h2")
        .join(by_size(named, n_named, BROADCAST_IDS), ["h1", "h2"], "left")
        .select(
            "id",
            "h1",
            "h2",
            F.when(F.col("n_words") > 0, F.coalesce(F.when(F.col("id").isNotNull(), F.col("class_id")), "id")).otherwise(F.col("id")).alias("class_id"),
            F.when(F.col("n_words") > 0, F.coalesce(F.when(F.col("id").isNotNull(), F.col("component_id")), "id")).otherwise(F.col("id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)))
    )
    return out, n


def _files(rows: int, thousand: int) -> int:
    """Files for at most ``rows`` rows, so many thousand in each."""
    return rows // (1000 * thousand) + 1


def _with_components(rows: DataFrame, comp: DataFrame, n: int) -> DataFrame:
    """``rows`` (id, ...) with ``comp``: the id's component among those of ``n`` ids, or the id where it has no link."""
    return rows.join(by_size(comp, n, BROADCAST_IDS), "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")


def _texts(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, more: DataFrame | None = None) -> DataFrame:
    """(id, text) of the ids in ``pairs`` and ``more`` only, written once; the other texts are not moved."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    ids = (ids if more is None else ids.unionByName(more)).distinct()
    n = ids.count()
    all_texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return materialize(all_texts.join(by_size(ids, n, BROADCAST_IDS), "id"), "texts", _files(n, 5))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All columns of ``docs``, one row of each group of near-duplicates; repeated rows count as copies.

    Rows with a null id, and texts without words, stay. Where one id has several texts, its rows go only if all are copies; of
    its rows with the same text the first stays, by the row written as JSON.
    """
    found, n = _groups(docs, id_col, text_col, **options)
    key = fresh("near_duplicate_id", docs.columns)
    each = found.where("id is not null").groupBy(F.col("id").alias(key)).agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    odd, n_odd = written(each.where("not kept or n > 1"), "odd", _files(n, 500))
    gone, twice = odd.where("not kept").select(key), odd.where("kept and n > 1").select(key)
    own = F.col(f"`{id_col}`").cast("long")
    out = docs.join(by_size(gone, n_odd, BROADCAST_IDS), own == F.col(key), "left_anti")
    if twice.isEmpty():
        return out
    small = by_size(twice, n_odd, BROADCAST_IDS)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    repeated = out.join(small, own == F.col(key), "left_semi").groupBy(f"`{id_col}`", f"`{text_col}`").agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return out.join(small, own == F.col(key), "left_anti").unionByName(repeated)


def op8_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: one row per document with its class and component."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "component_id", "kept")


#: Shingle multisets of all word sequences, compared where they share a shingle.
ORACLE_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\\t\\n\\x0B\\f\\r ]+'), lambda w: w <> '') AS w
  FROM documents
), class AS (
  SELECT w, min(doc_id) AS class_id FROM d WHERE doc_id IS NOT NULL AND len(w) > 0 GROUP BY w
), word AS (
  SELECT class_id, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM class
), shingle AS (
  SELECT class_id, concat_ws(' ', x, lead(x, 1) OVER p, lead(x, 2) OVER p, lead(x, 3) OVER p, lead(x, 4) OVER p) AS x
  FROM word WINDOW p AS (PARTITION BY class_id ORDER BY i) QUALIFY i <= greatest(n - 4, 1)
), bag AS (
  SELECT class_id, x, count(*) AS n FROM shingle GROUP BY class_id, x
), size AS (SELECT class_id, sum(n) AS n FROM bag GROUP BY class_id
), common AS (
  SELECT a.class_id AS a, b.class_id AS b, sum(least(a.n, b.n)) AS shared FROM bag a JOIN bag b ON a.x = b.x AND a.class_id <> b.class_id GROUP BY 1, 2
), edge AS (
  SELECT a, b FROM common JOIN size p ON p.class_id = a JOIN size q ON q.class_id = b WHERE shared >= 0.8 * (p.n + q.n - shared)
), reach(id, least) USING KEY (id) AS (
  SELECT class_id, class_id FROM class
  UNION
  SELECT e.b, min(r.least) FROM reach r JOIN edge e ON e.a = r.id JOIN recurring.reach o ON o.id = e.b GROUP BY e.b HAVING min(r.least) < min(o.least)
)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(least, doc_id) AS component_id, coalesce(coalesce(least, doc_id) = doc_id, TRUE) AS kept
FROM d LEFT JOIN class ON class.w = d.w AND doc_id IS NOT NULL LEFT JOIN reach ON reach.id = class_id
"""
