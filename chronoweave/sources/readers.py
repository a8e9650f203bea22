"""Raw tables: where they lie, and how they are read."""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.order import numbered
from ..operators.union import diagonal_union
from . import files
from .files import materialize

#: Suffixes of data files, the preferred first.
DATA_SUFFIXES = (".parquet", ".par", ".csv", ".csv.gz")
#: The same for metadata files.
METADATA_SUFFIXES = (".parquet", ".csv.gz", ".csv")


def suffix_of(path) -> str:
    return "".join(PurePosixPath(str(path)).suffixes).lower()


def _stem(name: str) -> str:
    return name[: -len(suffix_of(name))] if suffix_of(name) else name


def find_data(spark: SparkSession, root, wanted: list[str], storage: dict[str, str] | None = None) -> dict[str, str]:
    """The path of each wanted table below ``root``; FileNotFoundError if there are none at all.

    A table is a file or folder ``name.suffix`` or, next best, a folder ``name`` of such files. Failing these it may be the one
    ``name*.suffix`` that belongs to no other wanted table.
    """
    listed: dict[str, list[tuple[str, bool]]] = {}
    out = {}
    for w in wanted:
        above, _, name = w.rpartition("/")
        folder = f"{root}/{above}" if above else str(root)
        if folder not in listed:
            listed[folder] = [c for c in files.children(spark, folder, storage) if c[0][:1] not in "._"]
        data = sorted((n for n, _ in listed[folder] if suffix_of(n) in DATA_SUFFIXES), key=lambda n: DATA_SUFFIXES.index(suffix_of(n)))
        own = [n for n in data if _stem(n) == name]
        parts = [n for n, is_folder in listed[folder] if is_folder and n == name and _part_suffix(spark, f"{folder}/{n}", storage)]
        others = {o.rpartition("/")[2] for o in wanted if o.rpartition("/")[0] == above} - {name}
        near = {_stem(n): n for n in reversed(data) if n.startswith(name) and _stem(n) not in others and not any(len(o) > len(name) and n.startswith(o) for o in others)}
        found = own or parts or (list(near.values()) if len(near) == 1 else [])
        if found:
            out[w] = f"{folder}/{found[0]}"
    if not out:
        raise FileNotFoundError(f"no data files of {', '.join(wanted)} below {root}")
    return out


def _part_suffix(spark: SparkSession, folder: str, storage: dict[str, str] | None = None) -> str | None:
    """The preferred suffix of the data files in a folder."""
    inside = [n.lower() for n, _ in files.children(spark, folder, storage) if n[:1] not in "._"]
    return next((s for s in DATA_SUFFIXES if any(n.endswith(s) for n in inside)), None)


def parts_of(spark: SparkSession, path, storage: dict[str, str] | None = None) -> tuple[str, list[str]]:
    """(suffix, files in order of name) of a table that is one file or a folder of files; of a folder only files of the preferred suffix."""
    suffix = suffix_of(path) or _part_suffix(spark, str(path), storage) or ""
    if suffix not in DATA_SUFFIXES:
        raise ValueError(f"unsupported file type {suffix!r}: {path}")
    if not files.is_folder(spark, path, storage):
        return suffix, [str(path)]
    inside = [f"{path}/{n}" for n, folder in files.children(spark, path, storage) if not folder and n[:1] not in "._" and n.lower().endswith(suffix)]
    return suffix, inside or [str(path)]


def is_text(spark: SparkSession, path, storage: dict[str, str] | None = None) -> bool:
    """Whether a table lies in CSV files."""
    return (suffix_of(path) or _part_suffix(spark, str(path), storage) or "").startswith(".csv")


def find_metadata(spark: SparkSession, root, prefix: str, storage: dict[str, str] | None = None) -> list[str]:
    """All files (or folders) ``prefix*suffix`` at any depth below ``root``, of the first suffix that has any."""
    inside = list(files.walk(spark, root, lambda name: suffix_of(name) in DATA_SUFFIXES, storage=storage))
    for suffix in METADATA_SUFFIXES:
        fits = re.compile(f"(?:.*/)?{re.escape(prefix)}[^/]*{re.escape(suffix)}")
        if got := [f"{root}/{p}" for p in inside if fits.fullmatch(p)]:
            return got
    raise FileNotFoundError(f"no metadata files {prefix} below {root}")


def read_table(spark: SparkSession, path, typed: bool = True, row_index: str | None = None, columns: list[str] | None = None, position: str | None = None, storage: dict[str, str] | None = None) -> DataFrame:
    """A table from a CSV, gzipped CSV or Parquet file, or a folder of such files, on any storage. No character of the path is a wildcard.

    Files of a folder may differ: those with the same header, or the same footer, are one scan; the scans are united by name, a column that a
    file lacks is null in its rows, and types meet in the narrowest that holds both. CSV is scanned once and written as Parquet, of
    ``columns`` only if given; fields may hold separators, doubled quotes and line breaks.

    typed: give CSV columns the narrowest of bigint, double, boolean and string that holds all their values. row_index: name of
    an added column with row numbers; position: of one with numbers that only ascend in the table's order, which cost no join.
    """
    suffix, paths = parts_of(spark, path, storage)
    if text := suffix not in (".parquet", ".par"):
        df = _csv(spark, paths, columns, storage)
    else:
        df = _parquet(spark, paths, columns, "__at__" if position or row_index else None, storage)
    if row_index:
        df = numbered(df, "__at__", row_index)
    df = df.withColumnRenamed("__at__", position) if position else df.drop("__at__")
    return promote(df) if text and typed else df


#: Bits of a position: the upper ones number a table's files, the rest the rows of a file.
POSITION_BITS = 47
#: Files of a table whose numbers a broadcast may list.
BROADCAST_FILES = 100_000


def _numbered(df: DataFrame, spark: SparkSession, paths: list[str], row: Column, name: str, storage: dict[str, str] | None, file: Column | None = None) -> DataFrame:
    """``df`` of some of the files with each row's position: its file's place among ``paths``, then ``row``."""
    if len(paths) == 1:
        return df.withColumn(name, row.cast("bigint"))
    shift = POSITION_BITS - (len(paths) - 1).bit_length()
    numbers = spark.createDataFrame([(files.url(spark, p, storage), i) for i, p in enumerate(paths)], "__file__ string, __nth__ bigint")
    numbers = F.broadcast(numbers) if len(paths) <= BROADCAST_FILES else numbers
    rows = df.select("*", (files.read_from() if file is None else file).alias("__file__"), row.cast("bigint").alias("__in_file__"))
    return rows.join(numbers, "__file__").withColumn(name, F.shiftleft("__nth__", shift) + F.least("__in_file__", F.lit((1 << shift) - 1))).drop("__file__", "__nth__", "__in_file__")


def _groups(paths: list[str], key_of) -> dict[str, list[str]]:
    """Paths by what ``key_of`` says of them, looked up side by side."""
    with ThreadPoolExecutor(min(32, len(paths))) as pool:
        keys = list(pool.map(key_of, paths))
    out: dict[str, list[str]] = {}
    for path, key in zip(paths, keys):
        out.setdefault(key, []).append(path)
    return out


def _parquet(spark: SparkSession, paths: list[str], columns: list[str] | None, position: str | None, storage: dict[str, str] | None) -> DataFrame:
    groups = _groups(paths, lambda p: files.parquet_schema(spark, p, storage)) if len(paths) > 1 else {"": paths}
    frames = []
    for own in groups.values():
        df = spark.read.options(**storage or {}).parquet(*map(files.literal, own))
        if position:
            df = _numbered(df, spark, paths, F.col("_metadata.row_index"), position, storage)
        if columns:
            df = df.select(*[F.col(f"`{c}`") for c in df.columns if c in columns or c == position])
        frames.append(df)
    return frames[0] if len(frames) == 1 else diagonal_union(frames)


#: Stands between no two fields, so that a line is one field.
_WHOLE_LINE = "\x01\x02\x01"


def _header(line: str | None) -> list[str]:
    """Column names; empty and repeated ones get their place."""
    names = next(csv.reader([line])) if line else []
    return [n if n and n not in names[:i] else f"{n or '_c'}{i}" for i, n in enumerate(names)]


def _records(spark: SparkSession, paths: list[str], storage: dict[str, str] | None) -> DataFrame:
    """(__path__, __record__, __from__): the records of CSV files with line breaks inside fields, the header left out; __from__ ascends in a file.

    A line belongs to the record before it if the number of quotes ahead of it is odd. Lines are counted through within each block of a
    file, and one small row a block says how many quotes the earlier blocks have and where their last record begins.
    """
    lines = spark.read.options(**storage or {}).text(list(map(files.literal, paths)), lineSep="\n").select(
        F.col("value").alias("__line__"), files.read_from().alias("__path__"), F.col("_metadata.file_block_start").alias("__block__"), F.monotonically_increasing_id().alias("__id__"))
    quotes = (F.length("__line__") - F.length(F.replace("__line__", F.lit('"'), F.lit("")))).cast("bigint")
    lines = materialize(lines.withColumns({"__quotes__": quotes % 2, "__id__": F.col("__id__").bitwiseAND((1 << 33) - 1)}), "lines")
    earlier = Window.partitionBy("__path__").orderBy("__block__").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("__path__", "__block__").agg(F.sum("__quotes__").alias("q"))
    ahead = blocks.select("__path__", "__block__", F.coalesce(F.sum("q").over(earlier), F.lit(0)).alias("__ahead__"))  # one row a block
    before = Window.partitionBy("__path__", "__block__").orderBy("__id__").rowsBetween(Window.unboundedPreceding, -1)
    until = Window.partitionBy("__path__", "__block__").orderBy("__id__").rowsBetween(Window.unboundedPreceding, 0)
    here = lines.join(F.broadcast(ahead), ["__path__", "__block__"]).withColumn("__begins__", (F.col("__ahead__") + F.coalesce(F.sum("__quotes__").over(before), F.lit(0))) % 2 == 0)
    at = F.struct("__block__", "__id__")
    here = here.withColumn("__start__", F.max(F.when(F.col("__begins__"), at)).over(until))
    # lines at a block's head may go on with a record of an earlier block
    last = here.groupBy("__path__", "__block__").agg(F.max("__start__").alias("s"))
    carried = last.select("__path__", "__block__", F.max("s").over(earlier).alias("__carried__"))
    rows = here.join(F.broadcast(carried), ["__path__", "__block__"]).withColumn("__start__", F.coalesce("__start__", "__carried__"))
    records = rows.groupBy("__path__", "__start__").agg(F.array_sort(F.collect_list(F.struct("__block__", "__id__", "__line__"))).alias("l"))
    records = records.select("__path__", F.array_join(F.col("l.__line__"), "\n").alias("__record__"), "__start__")
    # the first line that is not blank is the header
    shown = lines.where(F.regexp_replace("__line__", "[\\s\\ufeff]", "") != "").groupBy("__path__").agg(F.min(at).alias("__header__"))
    rest = records.join(F.broadcast(shown), "__path__").where(F.col("__start__") > F.col("__header__"))
    return rest.select("__path__", "__record__", (F.col("__start__.__block__") + F.col("__start__.__id__")).alias("__from__"))


def _well_quoted(name: str) -> Column:
    """Whether quotes stand only around whole fields, or doubled inside them: then lines were put together as a parser would."""
    pieces = F.split(F.regexp_replace(name, "\r$", ""), '"', -1)
    n = F.size(pieces)
    # every other piece lies outside of quotes: it has separators at its quoted ends, or is nothing between two quotes
    def fits(piece, i):
        middle = (piece == "") & (i > 0) & (i < n - 1)
        return (i % 2 == 1) | middle | (((i == 0) | piece.startswith(",")) & ((i == n - 1) | piece.endswith(",") | ((i == 0) & (piece == ""))) & ~piece.contains("\r")) | ((i == n - 1) & (piece == ""))

    return (n % 2 == 1) & F.forall(F.transform(pieces, fits), lambda ok: ok)


def _csv(spark: SparkSession, paths: list[str], columns: list[str] | None, storage: dict[str, str] | None) -> DataFrame:
    """CSV files as text columns and ``__at__``, a row's position, from one scan that is written as Parquet.

    Lines are split into fields as they are scanned, and the number of quotes in each line is kept as odd or even. A file in which it
    is odd somewhere has line breaks inside fields: its rows are left out of the copy, and its lines are put together to records, by many tasks.
    Only a gzipped file, or one with stray quotes, is read again as a whole, in one task.
    """
    options = {"escape": '"', **(storage or {})}
    groups, frames = _groups(paths, lambda p: files.first_line(spark, p, storage) or ""), []
    for header, own in groups.items():
        names = _header(header)
        if not names:
            continue
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        ddl = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
        kept = [n for n in names if columns is None or n in columns]
        lines = spark.read.options(**storage or {}).csv(list(map(files.literal, own)), schema="__line__ string", header=True, sep=_WHOLE_LINE, quote="")
        # rows are counted within a task, which a file's later block begins at 0
        row = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        odd = (F.length("__line__") - F.length(F.replace("__line__", F.lit('"'), F.lit("")))) % 2 == 1
        lines = _numbered(lines.select("*", odd.alias("__odd__"), files.read_from().alias("__path__")), spark, paths, row, "__at__", storage)
        fields = lines.select(F.from_csv("__line__", ddl, {"escape": '"'}).alias("__f__"), "__odd__", "__path__", "__at__")
        copy = materialize(fields.select(*[F.col("__f__").getField(n).alias(n) for n in kept], "__odd__", "__path__", "__at__"), "csv")
        broken = copy.where("__odd__").select("__path__").distinct()
        torn = {r[0] for r in broken.collect()}  # one row a file
        whole = copy.join(F.broadcast(broken) if len(torn) <= BROADCAST_FILES else broken, "__path__", "left_anti") if torn else copy
        frames.append(whole.select(*[F.col(f"`{n}`") for n in kept], "__at__"))
        if torn:
            again = [p for p in own if files.url(spark, p, storage) in torn]
            if plain := [p for p in again if not p.lower().endswith(".gz")]:
                records = materialize(_records(spark, plain, storage), "records")
                # one row a file
                stray = {r[0] for r in records.where(~_well_quoted("__record__")).select("__path__").distinct().collect()}
                joined = [p for p in plain if files.url(spark, p, storage) not in stray]
                if joined:
                    good = records.where(~F.col("__path__").isin(list(stray))) if stray else records
                    good = good.where(F.trim(F.regexp_replace("__record__", "[\\r\\n]", "")) != "")
                    text = F.regexp_replace("__record__", "\\r$", "")
                    good = _numbered(good, spark, paths, F.col("__from__"), "__at__", storage, F.col("__path__"))
                    fields = good.select(F.from_csv(text, ddl, {"escape": '"', "multiLine": "true"}).alias("__f__"), "__at__")
                    frames.append(fields.select(*[F.col("__f__").getField(n).alias(n) for n in kept], "__at__"))
                again = [p for p in again if p not in set(joined)]
            if not again:
                continue
            rows = spark.read.options(**options).csv(list(map(files.literal, again)), schema=schema, header=True, multiLine=True)
            rows = _numbered(rows, spark, paths, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1), "__at__", storage)
            frames.append(materialize(rows.select(*[F.col(f"`{n}`") for n in kept], "__at__"), "csv"))
    if not frames:
        return spark.createDataFrame([], "__at__ bigint")
    return frames[0] if len(frames) == 1 else diagonal_union(frames)


def with_row_index(df: DataFrame, name: str = "__row_idx__") -> DataFrame:
    """A table read from Parquet files, with the number of each row from 0 on: files in order of path, rows in order of the file."""
    at = F.col("_metadata.file_path").alias("__file__")
    size = df.select(at).groupBy("__file__").agg(F.count("*").alias("__n__"))
    before = F.coalesce(F.sum("__n__").over(Window.orderBy("__file__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row a file
    rows = df.select("*", at, F.col("_metadata.row_index").alias("__in_file__")).join(size.select("__file__", before.alias("__before__")), "__file__")
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__before__") + F.col("__in_file__")).alias(name))


def promote(df: DataFrame) -> DataFrame:
    """String columns in the narrowest type that fits every value, found in one pass."""
    kinds = ("bigint", "double", "boolean")
    names = [c for c, kind in df.dtypes if kind == "string"]
    if not names:
        return df
    shape = {"bigint": r"^[-+]?[0-9]+$", "double": r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$|^[-+]?(inf|NaN)$", "boolean": r"^(true|false)$"}

    def fits(name: str, kind: str):
        c = F.col(f"`{name}`")
        return F.every(c.isNull() | (c.rlike(shape[kind]) & c.try_cast(kind).isNotNull()))

    checks = [fits(n, k).alias(f"{i}_{k}") for i, n in enumerate(names) for k in kinds]
    seen = [F.count(F.col(f"`{n}`")).alias(f"{i}_n") for i, n in enumerate(names)]
    got = df.agg(*checks, *seen).first()
    kind_of = {n: next((k for k in kinds if got[f"{i}_{k}"]), "string") if got[f"{i}_n"] else "string" for i, n in enumerate(names)}
    return df.select(*[F.col(f"`{c}`").cast(kind_of[c]).alias(c) if c in kind_of else F.col(f"`{c}`") for c in df.columns])


def read_metadata(spark: SparkSession, paths: list, storage: dict[str, str] | None = None) -> DataFrame:
    """Metadata rows of one or several files with the same columns; CSV stays text."""
    frames = [read_table(spark, p, typed=False, storage=storage) for p in paths]
    if any(set(f.columns) != set(frames[0].columns) for f in frames):
        raise ValueError(f"metadata files differ in columns: {', '.join(map(str, paths))}")
    return diagonal_union(frames)


def ends_of(df: DataFrame, n: int = 10) -> tuple[list[Row], list[Row]]:
    """The first and the last ``n`` rows, for messages."""
    return df.head(n), df.tail(n)


def require(df: DataFrame, columns: list[str], name: str, path=None, storage: dict[str, str] | None = None) -> DataFrame:
    """``df``, checked to have columns and rows; of a text file at ``path`` without rows the message shows the first and last lines."""
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"table {name} lacks columns {', '.join(missing)}; it has {', '.join(df.columns)}")
    if df.isEmpty():
        shown = ""
        if path is not None and is_text(df.sparkSession, path, storage):
            first, last = ends_of(df.sparkSession.read.options(**storage or {}).text(files.literal(path)))
            shown = f"; it begins with {[r[0] for r in first]} and ends with {[r[0] for r in last]}"
        raise ValueError(f"table {name} has no rows, only the columns {', '.join(df.columns)}{shown}")
    return df


def row_range(df: DataFrame, index: str, start: int, end: int) -> DataFrame:
    """Rows whose index lies in [start, end)."""
    return df.where((F.col(index) >= start) & (F.col(index) < end))
