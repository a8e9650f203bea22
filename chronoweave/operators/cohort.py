"""Events of all tables brought together: routed to shards, made distinct, put in order, written."""

from __future__ import annotations

import logging
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import files

log = logging.getLogger(__name__)

#: A row's position in its raw table.
ROW = "__row__"
#: Where a row stands in the specification, then in its table: helper columns that take no part in being equal.
ORDER = ("__table__", "__block__", ROW)
#: More than a specification has tables, or a table has blocks.
PLACES = 1 << 20


def route(events: DataFrame, shards: DataFrame) -> DataFrame:
    """Events of known subjects with their split and shard; a subject in several splits has its rows in each, null ids go."""
    places = shards.select(*[c for c in ("subject_id", "split", "shard") if c in shards.columns]).distinct()
    return events.join(places, "subject_id")


def distinct_events(events: DataFrame, by: str | list[str] | None = "*", scope: tuple[str, ...] = ("shard",)) -> DataFrame:
    """Rows that differ: in all columns for ``*``, in the named ones for a list, all rows for None.

    Of equal rows the first stays, in order of the specification, then of the raw table; for a list, ties go by the remaining columns. Unknown
    names are left out of the list. ``scope`` columns always count. Both forms are aggregates that combine before they shuffle, so
    a value that most rows share is one row a task.
    """
    helpers = [c for c in ORDER if c in events.columns]
    scope_cols = [c for c in scope if c in events.columns]
    data = [c for c in events.columns if c not in helpers]
    if by is None:
        return events
    if by == "*":
        if not helpers:
            return events.dropDuplicates()
        return _first_of(events, data, helpers)
    if not isinstance(by, (list, tuple)) or not by:
        raise ValueError(f"unique_by must be '*', null or a list of columns, not {by!r}")
    keys = [c for c in by if c in data]
    if unknown := [c for c in by if c not in data]:
        log.warning("unique_by: no columns %s", ", ".join(unknown))
    if not keys:
        return events
    keys += [c for c in scope_cols if c not in keys]
    rest = [c for c in [*helpers, *data] if c not in keys]
    if not rest:
        return events.dropDuplicates(keys)
    # the least of all that is not a key: its fields are the row that stays
    kept = events.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("__first__"))
    return kept.select(*[F.col(f"`{c}`") if c in keys else F.col("__first__").getField(c).alias(c) for c in events.columns])


def _first_of(events: DataFrame, data: list[str], helpers: list[str]) -> DataFrame:
    """One row for each value of ``data``, with the least helpers."""
    spec = [h for h in helpers if h != ROW]
    # one number, so that the aggregate hashes; a minimum of structs would sort
    place = reduce(lambda acc, h: acc * PLACES + F.col(h), spec, F.lit(0).cast("bigint"))
    keys = [F.col(f"`{c}`") for c in data]
    parts = {h: F.floor(F.col("__place__") / PLACES**i) % PLACES for i, h in enumerate(reversed(spec))}
    out = [*keys, *[parts[h].cast("int").alias(h) for h in spec]]
    if ROW not in helpers:
        return events.groupBy(*keys).agg(F.min(place).alias("__place__")).select(*out)
    if "source_block" in data or not spec:
        # equal rows are of one block, so both least numbers are of one row
        return events.groupBy(*keys).agg(F.min(place).alias("__place__"), F.min(ROW).alias(ROW)).select(*out, ROW)
    both = F.struct(place.alias("__place__"), F.col(ROW))
    return events.groupBy(*keys).agg(F.min(both).alias("m")).select(*keys, "m.*").select(*out, ROW)


def sort_keys(events: DataFrame, also: list[str] | None = None) -> list:
    """Subject, time, named columns, place in the specification and in the raw table, then all the rest, so that the order is total."""
    if unknown := [c for c in also or [] if c not in events.columns]:
        log.warning("sort: no columns %s", ", ".join(unknown))
    lead = ["subject_id", "time", *[c for c in also or [] if c in events.columns]]
    helpers = [c for c in ORDER if c in events.columns]
    rest = [c for c in sorted(events.columns) if c not in lead and c not in helpers and c not in ("split", "shard")]
    return [F.col(f"`{c}`").asc_nulls_first() for c in [*lead, *helpers, *rest]]


def ordered(events: DataFrame, also: list[str] | None = None, by: str = "shards") -> DataFrame:
    """Rows of each shard in order; ``shard`` becomes its number within the split.

    by ``shards``: each shard in one task, which sorts it (and spills). by ``ranges``: dealt into ranges of the order, so that a
    shard, or a subject, with very many rows spans several tasks; ``events`` are read twice, so pass a written table. The order
    begins with the folders' columns, so that the writer adds no sort of its own, which would undo it.
    """
    if by not in ("shards", "ranges"):
        raise ValueError(f"order by shards or ranges, not {by!r}")

    def varying(name: str):
        # a name that the plan knows to be constant would drop out of the order, and the writer would then sort anew
        c = F.col(name)
        return F.substring(F.concat(c, F.coalesce(F.col("subject_id").cast("string"), F.lit(""))), F.lit(1), F.length(c))

    placed = events.withColumns({"split": varying("split"), "shard": F.element_at(F.split(varying("shard"), "/"), -1).cast("int")})
    keys = [F.col("split"), F.col("shard"), *sort_keys(placed, also)]
    dealt = placed.repartitionByRange(*keys) if by == "ranges" else placed.repartition("split", "shard")
    return dealt.sortWithinPartitions(*keys).drop(*ORDER)


def write_cohort(events: DataFrame, path: str, mode: str = "errorifexists", named: bool = False, storage: dict[str, str] | None = None) -> None:
    """The rows of each shard below ``split=``/``shard=`` folders, by which readers prune; its files in order of name hold them in order.

    named: then rename them to ``{split}/{shard}.parquet``, one file a shard (a shard of several files: ``{shard}-1.parquet`` and so on).
    """
    spark = events.sparkSession
    events.write.options(**storage or {}).mode(mode).partitionBy("split", "shard").parquet(path)
    if not named:
        return
    _name_files(spark, path, storage)


def _name_files(spark: SparkSession, path: str, storage: dict[str, str] | None) -> None:
    """Rename the files of ``split=``/``shard=`` folders to ``{split}/{shard}.parquet``; shards side by side, as each takes some calls to the storage."""

    def rename(split: str, shard: str) -> None:
        parts = [n for n, _ in files.children(spark, f"{path}/{split}/{shard}", storage) if n.startswith("part-")]
        for i, part in enumerate(parts):
            files.move(spark, f"{path}/{split}/{shard}/{part}", f"{path}/{unquote(split.removeprefix('split='))}/{shard.removeprefix('shard=')}{f'-{i}' if i else ''}.parquet", storage)

    splits = [n for n, _ in files.children(spark, path, storage) if n.startswith("split=")]
    with ThreadPoolExecutor(16) as pool:
        for done in [pool.submit(rename, split, shard) for split in splits for shard, _ in files.children(spark, f"{path}/{split}", storage)]:
            done.result()
    for split in splits:
        files.delete(spark, f"{path}/{split}", storage)


def read_in_order(spark: SparkSession, path: str, number: str, storage: dict[str, str] | None = None) -> DataFrame:
    """``read_cohort`` with each row's number in its shard, from 0: rows of the shard's earlier files come before."""
    rows = read_cohort(spark, path, storage).select("*", F.col("_metadata.file_path").alias("__file__"), F.col("_metadata.row_index").alias("__in_file__"))
    # {shard}.parquet, then {shard}-1.parquet and so on; files of folders have no such number and go by name
    nth = F.coalesce(F.regexp_extract("__file__", "-([0-9]+)[.]parquet$", 1).try_cast("int"), F.lit(0))
    size = rows.groupBy("split", "shard", "__file__").agg(F.count("*").alias("__n__"))
    earlier = Window.partitionBy("split", "shard").orderBy(nth, "__file__").rowsBetween(Window.unboundedPreceding, -1)
    before = size.select("__file__", F.coalesce(F.sum("__n__").over(earlier), F.lit(0)).alias("__before__"))  # one row a file
    return rows.join(before, "__file__").withColumn(number, F.col("__before__") + F.col("__in_file__")).drop("__file__", "__in_file__", "__before__")


def read_cohort(spark: SparkSession, path: str, storage: dict[str, str] | None = None) -> DataFrame:
    """A written cohort of either layout, with ``split`` and ``shard``."""
    if any(n.startswith("split=") for n, _ in files.children(spark, path, storage)):
        return spark.read.options(**storage or {}).parquet(path)
    rows = spark.read.options(**storage or {}).option("recursiveFileLookup", True).parquet(path)
    # {split}/{shard}.parquet, where a split may have slashes of its own
    below = f"^.*/{re.escape(str(path).rstrip('/').rpartition('/')[2])}/(.+)/([0-9]+)(-[0-9]+)?[.]parquet$"
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return rows.select("*", F.regexp_extract(file, below, 1).alias("split"), F.regexp_extract(file, below, 2).cast("int").alias("shard"))
