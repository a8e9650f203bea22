"""Which subjects there are, and which split and shard they belong to."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import files
from ..sources.files import materialize, release
from .order import numbered, placed

DEFAULT_SHARES = {"train": 0.8, "tuning": 0.1, "held_out": 0.1}
PER_SHARD = 50_000
#: Subjects that a draw may have.
MOST_DRAWN = 20_000_000
#: Subjects whose numbers are drawn on the driver; those of more are drawn by tasks, and are the same.
FEW = 100_000
#: Numbers that one task draws.
SWAPS = 250_000
#: Subjects in one row of a drawn table.
CHUNK = 10_000


def universe(frames: list[DataFrame], column: str = "subject_id") -> DataFrame:
    """Distinct ids, neither null nor NaN, of all frames: distinct in each, then over all."""

    def own(df: DataFrame) -> DataFrame:
        c = F.col(column)
        if dict(df.dtypes)[column] in ("double", "float"):
            df = df.where(~F.isnan(c))
        return df.where(c.isNotNull()).select(c.cast("bigint").alias("subject_id")).distinct()

    return reduce(lambda a, b: a.unionByName(b), map(own, frames)).distinct()


@dataclass(frozen=True)
class Drawn:
    """One split: its name, the places its subjects take among the sorted free ones (None: an external list's own), and its shards
    as runs of places in that order."""

    name: str
    free: np.ndarray | None
    shards: list[np.ndarray]


def draw(n_free: int, per_shard: int = PER_SHARD, external: dict[str, int] | None = None, shares: dict[str, float | None] | None = None, seed: int = 1) -> list[Drawn]:
    """The splits of ``n_free`` subjects and of external lists of known lengths; only numbers are drawn, no ids.

    Each drawn split gets its share of a random permutation. Drawn from one generator, in this order: the splits' order, the
    subjects' order, and the order in each split that needs several shards.
    """
    external = external or {}
    rng = np.random.default_rng(seed)
    sizes = drawn_sizes(rng, n_free, external, shares)
    splits: dict[str, np.ndarray | None] = {}
    if sizes:
        mixed, ends = rng.permutation(n_free), np.cumsum(list(sizes.values()))
        splits = {s: mixed[e - n : e] for (s, n), e in zip(sizes.items(), ends)}
    splits |= dict.fromkeys(external)
    out = []
    for name, own in splits.items():
        n = external[name] if own is None else len(own)
        places = np.arange(n)
        out.append(Drawn(name, own, [places] if n <= per_shard else np.array_split(rng.permutation(places), math.ceil(n / per_shard))))
    return out


def drawn_sizes(rng: np.random.Generator, n_free: int, external: dict[str, int], shares: dict[str, float | None] | None = None) -> dict[str, int]:
    """How many of the free subjects each drawn split gets, in the order of the splits, which is drawn; none without free subjects."""
    if not n_free:
        return {}
    shares = {k: v for k, v in (DEFAULT_SHARES if shares is None else shares).items() if v is not None}
    total = sum(shares.values())
    if not math.isclose(total, 1):
        raise ValueError(f"split shares must add up to 1, not {total}: {shares}")
    if clash := sorted(set(shares) & set(external)):
        raise ValueError(f"splits {', '.join(clash)} are external and drawn")
    order = [list(shares)[i] for i in rng.permutation(len(shares))]
    return dict(zip(order, sizes_of(n_free, [shares[s] for s in order])))


def sizes_of(n: int, shares: list[float]) -> list[int]:
    """How many of ``n`` subjects each share gets: rounded, the last takes the rest; an empty one gets one from the largest, once."""
    sizes = [int(np.round(s * n)) for s in shares[:-1]]
    sizes.append(n - sum(sizes))
    if min(sizes) == 0:
        sizes[int(np.argmax(sizes))] -= 1
        sizes[int(np.argmin(sizes))] += 1
    if min(sizes) <= 0:
        raise ValueError(f"{n} subjects cannot fill {len(shares)} splits")
    return sizes


def assign_shards(ids, per_shard: int = PER_SHARD, external: dict[str, list] | None = None, shares: dict[str, float | None] | None = None, seed: int = 1) -> dict[str, list[int]]:
    """``{"split/shard": ids}`` of a few subjects, the same for the same set of ids in any order; ``drawn_shards`` is its form on DataFrames.

    Externally assigned subjects keep their splits.
    """
    external = external or {}
    fixed = set().union(*map(set, external.values())) if external else set()
    free = np.array(sorted({int(i) for i in ids} - fixed), dtype=np.int64)
    shards: dict[str, list[int]] = {}
    for d in draw(len(free), per_shard, {k: len(v) for k, v in external.items()}, shares, seed):
        own = free[d.free] if d.free is not None else np.array(list(external[d.name]), dtype=np.int64)
        shards |= {f"{d.name}/{i}": own[places].tolist() for i, places in enumerate(d.shards)}
    return shards


def drawn_shards(people: DataFrame, per_shard: int = PER_SHARD, external: DataFrame | None = None, shares: dict[str, float | None] | None = None, seed: int = 1, most: int = MOST_DRAWN) -> DataFrame:
    """(subject_id, split, shard, place): ``assign_shards`` on DataFrames; place: where a subject stands in its shard.

    Ids stay on the cluster: subjects are numbered in ascending order. The numbers of up to ``FEW`` subjects are drawn on the driver, those
    of more by tasks. More than ``most`` are a ValueError; then ``hashed_shards`` is the way. external: (split, number, place,
    subject_id), with the splits' order and the place in a split's list.
    """
    spark = people.sparkSession
    free = people if external is None else people.join(external.select("subject_id").distinct(), "subject_id", "left_anti")
    sizes = {} if external is None else {r["split"]: r["n"] for r in external.groupBy("split").agg(F.count("*").alias("n"), F.min("number").alias("at")).orderBy("at").collect()}
    free = materialize(free, "free")
    n = free.count()
    if n + sum(sizes.values()) > most:
        raise ValueError(f"{n + sum(sizes.values())} subjects are more than max_drawn_subjects, {most}, that a draw may have; choose split_by='hash'")
    if n + sum(sizes.values()) > FEW:
        return _drawn_by_tasks(free, n, external, sizes, per_shard, shares, seed)
    drawn = draw(n, per_shard, sizes, shares, seed)

    def table(splits: list[Drawn]) -> DataFrame:
        """(split, own, shard_no, place): own is a subject's number among the free ones, or in its external list."""
        nth, split, number = 0, F.lit(None).cast("string"), F.lit(0).cast("bigint")
        shard = F.shiftright("e", 32)
        lists: dict[str, np.ndarray] = {}
        for d in splits:
            split, number = F.when(shard >= nth, d.name).otherwise(split), F.when(shard >= nth, shard - nth).otherwise(number)
            of = "" if d.free is not None else d.name
            if of not in lists:
                lists[of] = np.zeros(sum(len(p) for s in splits if d.free is not None or s is d for p in s.shards), np.int64)
            for places in d.shards:
                lists[of][places if d.free is None else d.free[places]] = (nth << 32) + np.arange(len(places))
                nth += 1
        # many numbers a row, in order of own, which is not sent
        first = np.concatenate([np.arange(0, len(v), CHUNK) for v in lists.values()] or [np.zeros(0, np.int64)])
        cuts = np.cumsum([0, *[min(CHUNK, len(v) - i) for v in lists.values() for i in range(0, len(v), CHUNK)]])
        packed = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(np.concatenate(list(lists.values()) or [np.zeros(0, np.int64)])))
        chunks = spark.createDataFrame(pa.table([pa.array(first.astype(np.int64)), packed], ["first", "packed"]), "first bigint, packed array<bigint>")
        rows = chunks.select("first", F.posexplode("packed").alias("i", "e"))
        return rows.select(split.alias("split"), (F.col("first") + F.col("i")).alias("own"), number.cast("int").alias("shard_no"), F.col("e").bitwiseAND((1 << 32) - 1).alias("place"))

    found = numbered(free, "subject_id", "own").join(table([d for d in drawn if d.free is not None]), "own").select("subject_id", "split", "shard_no", "place")
    if external is not None:
        listed = external.select("subject_id", "split", F.col("place").alias("own"))
        found = found.unionByName(listed.join(table([d for d in drawn if d.free is None]), ["split", "own"]).select("subject_id", "split", "shard_no", "place"))
    return found.select("subject_id", "split", F.concat_ws("/", "split", F.col("shard_no").cast("string")).alias("shard"), "place")


def _drawn_by_tasks(free: DataFrame, n: int, external: DataFrame | None, sizes: dict[str, int], per_shard: int, shares: dict[str, float | None] | None, seed: int) -> DataFrame:
    """``drawn_shards`` of many subjects: drawn numbers and ids stay in tasks, which each hold a part, and nothing that grows with them is broadcast."""
    rng = np.random.default_rng(seed)
    own = drawn_sizes(rng, n, sizes, shares)
    # which permutation mixes a split; 0: the free subjects' one
    mixes = {name: i for i, (name, k) in enumerate({**own, **sizes}.items(), 1) if k > per_shard}
    mixed = permutations(free.sparkSession, rng, ({0: n} if n else {}) | {i: {**own, **sizes}[name] for name, i in mixes.items()})
    parts = []  # (subject_id, split, own): own is a subject's number in its split
    if n:
        at, name, first, start = F.col("at"), F.lit(None).cast("string"), F.lit(0).cast("bigint"), 0
        for split, k in own.items():
            name, first = F.when(at >= start, split).otherwise(name), F.when(at >= start, start).otherwise(first)
            start += k
        places = mixed.where("draw = 0").select(F.col("number").alias("nth"), name.alias("split"), (at - first).alias("own")).hint("merge")
        parts.append(numbered(free, "subject_id", "nth").join(places, "nth").select("subject_id", "split", "own"))
    if external is not None:
        parts.append(external.select("subject_id", "split", F.col("place").alias("own")))
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    draw_no, size = (_by_split(known, none) for known, none in ((mixes, -1), ({**own, **sizes}, 1)))
    order = mixed.where("draw > 0").select("draw", F.col("number").alias("own"), "at").hint("merge")
    rows = rows.select("*", draw_no.alias("draw"), size.alias("n")).join(order, ["draw", "own"], "left")
    number, place = _cut(F.coalesce("at", "own"), F.col("n"), per_shard)
    return rows.select("subject_id", "split", F.concat_ws("/", "split", number.cast("string")).alias("shard"), place.alias("place"))


def _by_split(known: dict[str, int], none: int) -> Column:
    return reduce(lambda c, kv: F.when(F.col("split") == kv[0], kv[1]).otherwise(c), known.items(), F.lit(none)).cast("bigint")


def permutations(spark: SparkSession, rng: np.random.Generator, sizes: dict[int, int]) -> DataFrame:
    """(draw, at, number): what stands at each place of ``rng.permutation(n)``, for the n of each draw, one draw after the other.

    NumPy's permutation starts from 0 to n - 1 in order; for at = n - 1 down to 1 it draws a place ``to`` <= at and swaps what stands there. The
    driver only moves the generator on; tasks draw the places again, from its states. What a place holds when its own swap comes was brought
    there by the last swap that drew it before, from that swap's own place, where the same holds: chains of rising places (the
    longest of a million with seed 1: 19 links). They are followed side by side, each round twice as far. A place that no swap drew holds its own number.
    """

    def swaps_of(generator, high, low):
        # places high to low + 1 and what they are swapped with: the permutation's draws, which are bounded by masks, as randint's are
        at = np.arange(high, low, -1)
        return at, np.random.RandomState(generator.bit_generator).randint(0, at + 1, dtype=np.int64)

    chunks = []
    for draw_no, n in sizes.items():
        for high in range(n - 1, 0, -SWAPS):
            chunks.append((draw_no, high, max(high - SWAPS, 0), rng.bit_generator.state))
            swaps_of(rng, *chunks[-1][1:3])

    # it and what it calls go to the tasks by value: executors need NumPy and PyArrow, but not this package
    def drawn(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                draw_no, high, low, state = chunks[i]
                own = np.random.default_rng()
                own.bit_generator.state = state
                at, to = swaps_of(own, high, low)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), draw_no)), pa.array(at), pa.array(to)], ["draw", "at", "to"])

    swaps = materialize(spark.range(0, len(chunks), 1, max(1, len(chunks))).mapInArrow(drawn, "draw bigint, at bigint, to bigint"), "swaps")
    # the swap that drew the same place last before; a place's first link is to the last swap that drew it before its own
    earlier = F.lead("at").over(Window.partitionBy("draw", "to").orderBy("at"))
    links = materialize(swaps.where("at > to").groupBy("draw", F.col("to").alias("p")).agg(F.min("at").alias("up"), F.lit(True).alias("moved")), "links")
    while not links.where("moved").isEmpty():
        # merged: a broadcast would gather the links on the driver
        ends = links.select("draw", F.col("p").alias("up"), F.col("up").alias("further")).hint("merge")
        longer = links.drop("moved").join(ends, ["draw", "up"], "left").select("draw", "p", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved"))
        longer, before = materialize(longer, "links"), links
        links = longer
        release(before)
    firsts = spark.createDataFrame([(d, 0, 0, 0) for d, n in sizes.items() if n], "draw bigint, at bigint, to bigint, p bigint")
    # places that no earlier swap drew find no link; keys of their own keep them apart
    found = swaps.select("draw", "at", "to", F.coalesce(earlier, -1 - F.col("at")).alias("p")).unionByName(firsts)
    ends = links.select("draw", "p", "up").hint("merge")
    number = F.coalesce("up", F.when(F.col("p") >= 0, F.col("p")), "to")
    out = materialize(found.join(ends, ["draw", "p"], "left").select("draw", "at", number.alias("number")), "permutations")
    release(swaps, links)
    return out


def write_lists(shards: DataFrame, path, storage: dict[str, str] | None = None) -> None:
    """``{"split/shard": [ids]}`` as JSON, one shard a line, in order of name; one task puts them in order (and spills), which never has more than a line in hand."""
    # one row a shard, of at most so many ids as it may have
    lists = shards.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("place", "subject_id"))).alias("m")).select(F.to_json(F.create_map("shard", "m.subject_id")).alias("j"))
    end = shards.sparkSession.range(1).select(F.lit(None).cast("string").alias("j"))
    rows = lists.unionByName(end).repartition(1).sortWithinPartitions(F.asc_nulls_last("j")).select("j", F.monotonically_increasing_id().alias("at"))
    first = F.col("at") == 0  # of the only partition's rows
    entry = F.concat(F.when(first, "{").otherwise(","), F.expr("substring(j, 2, length(j) - 2)"))
    files.write_lines(rows.select(F.coalesce(entry, F.when(first, "{}").otherwise("}")).alias("value")), path, storage)


#: Lines of such a file: its first, the others, its last.
_LISTS = (r'^\{"([^"\\]++|\\.)*+":\[[-0-9,]*+\]$', r'^,"([^"\\]++|\\.)*+":\[[-0-9,]*+\]$', r"^\}$")


def external_splits(spark: SparkSession, path, storage: dict[str, str] | None = None) -> DataFrame:
    """(split, number, place, subject_id) from a JSON file ``{"split": [ids]}``; number: rises with the lists in the file. A file as
    ``write_lists`` makes it is read by many tasks, any other one by one task."""
    if str(path).rpartition("/")[2][:1] in "._":  # which Spark's readers leave out
        path, storage = files.visible(spark, path, storage), None
    reader, lists = spark.read.options(**storage or {}), "map<string,array<bigint>>"
    # lines of a file are numbered in its order, as a scan deals its blocks in order
    lines = reader.text(files.literal(path)).select(F.monotonically_increasing_id().alias("number"), "value")
    kinds = lines.agg(*[F.count_if(F.col("value").rlike(kind)) for kind in _LISTS], F.count("*")).first()
    if kinds[0] == kinds[2] == 1 and sum(kinds[:3]) == kinds[3]:
        one = F.from_json(F.concat(F.lit("{"), F.expr("substring(value, 2)"), F.lit("}")), lists, {"mode": "FAILFAST"})
        found = lines.where("value <> '}'").select("number", F.explode(F.map_entries(one)).alias("e"))
    else:
        text = spark.read.options(**storage or {}).text(files.literal(path), wholetext=True)
        found = text.select(F.posexplode(F.map_entries(F.from_json("value", lists))).alias("number", "e"))
    placed_ids = found.select(F.col("e.key").alias("split"), F.col("number").cast("bigint").alias("number"), F.posexplode("e.value").alias("place", "subject_id"))
    return placed_ids.select("split", "number", F.col("place").cast("bigint").alias("place"), "subject_id")


def overlaps(shards: DataFrame) -> DataFrame:
    """(a, b, n): how many subjects two splits share, for those that share some."""
    several = shards.select("subject_id", "split").groupBy("subject_id").agg(F.sort_array(F.collect_set("split")).alias("s")).where(F.size("s") > 1)
    pairs = several.select(F.explode("s").alias("a"), "s").select("a", F.explode("s").alias("b")).where("a < b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"))


def split_of(shard: str) -> str:
    return shard.rpartition("/")[0]


def hashed_shards(people: DataFrame, per_shard: int = PER_SHARD, external: DataFrame | None = None, shares: dict[str, float | None] | None = None, seed: int = 1) -> DataFrame:
    """(subject_id, split, shard, place) for any number of subjects: they are ordered by a seeded hash and cut at the exact shares.

    An external split (split, number, place, subject_id) is cut into shards in the order of its list.
    """
    shares = {k: v for k, v in (DEFAULT_SHARES if shares is None else shares).items() if v is not None}
    free = people if external is None else people.join(external.select("subject_id").distinct(), "subject_id", "left_anti")
    free = materialize(free, "free")
    n = free.count()
    splits = []  # name, first place, number of subjects
    if n:
        if not math.isclose(sum(shares.values()), 1):
            raise ValueError(f"split shares must add up to 1, not {sum(shares.values())}: {shares}")
        sizes = sizes_of(n, list(shares.values()))
        splits = [(k, sum(sizes[:i]), sizes[i]) for i, k in enumerate(shares)]
    h = F.xxhash64(F.lit(seed), "subject_id")
    rows = placed(free.withColumns({"__h__": h, "__b__": F.shiftright(h, 52).cast("int")}), F.struct("__h__", "subject_id"), "at").drop("__h__")
    name, first, size = F.lit(None).cast("string"), F.lit(0), F.lit(1)
    for k, start, count in splits:
        here = F.col("at") >= start
        name, first, size = F.when(here, k).otherwise(name), F.when(here, start).otherwise(first), F.when(here, count).otherwise(size)
    rows = rows.select("subject_id", name.alias("split"), (F.col("at") - first).cast("bigint").alias("own"), size.cast("bigint").alias("n"))
    if external is not None:
        size_of = external.groupBy("split").agg(F.count("*").alias("n"))
        rows = rows.unionByName(external.join(size_of, "split").select("subject_id", "split", F.col("place").alias("own"), "n"))
    number, place = _cut(F.col("own"), F.col("n"), per_shard)
    return rows.select("subject_id", "split", F.concat_ws("/", "split", number.cast("string")).alias("shard"), place.alias("place"))


def _cut(own: Column, n: Column, per_shard: int) -> tuple[Column, Column]:
    """The shard of place ``own`` of ``n``, and the place in it: near-equal runs, the first ones longer by one, as np.array_split cuts."""
    count = F.ceil(n / per_shard)
    short, longer = F.floor(n / count), n % count
    number = F.when(own < longer * (short + 1), F.floor(own / (short + 1))).otherwise(longer + F.floor((own - longer * (short + 1)) / F.greatest(short, F.lit(1))))
    return number, (own - (number * short + F.least(number, longer))).cast("bigint")
