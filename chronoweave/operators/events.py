"""From a raw table to the rows of its event blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import Expr
from ..functions.formats import as_text
from ..plans.spec import Event, Join, Table
from .cohort import ROW, distinct_events
from .union import common_types, in_types

UNKNOWN = "UNK"


def lookup_join(left: DataFrame, right: DataFrame, join: Join, how: str = "left") -> DataFrame:
    """LEFT JOIN of ``left`` with the lookup's columns; one that ``left`` has already gets ``_right``. how: or ``inner``.

    The lookup keeps its duplicates. Adaptive execution picks the algorithm: a small lookup is broadcast below Spark's own size
    bound, and a skewed key is split.
    """
    key = "__lookup_key__"
    named = {c: f"{c}_right" if c in left.columns and c != join.left_on else c for c in join.columns if c != join.right_on}
    side = right.select(F.col(f"`{join.right_on}`").alias(key), *[F.col(f"`{c}`").alias(n) for c, n in named.items()])
    return left.join(side, F.col(f"`{join.left_on}`") == F.col(key), how).drop(key)


def code_of(code: Expr) -> Column:
    """The event code: text is composed null-safe, each null piece as ``UNK``."""
    if code.kind == "text":
        return F.concat(*[F.coalesce(as_text(a.compile()), F.lit(UNKNOWN)) for a in code.args])
    if code.kind in ("literal", "column"):
        return as_text(code.compile())
    return F.coalesce(as_text(code.compile()), F.lit(UNKNOWN))


def row_filter(event: Event, schema: T.StructType) -> Column | None:
    """Rows that an event block takes: a bare-column code is not null; all columns of its time are neither null nor empty text.

    The time's columns are tested, not its value, so a lenient time that does not parse stays, as null.
    """
    tests = []
    if event.code.kind == "column":
        tests.append(event.code.compile().isNotNull())
    if event.time is not None:
        names = sorted(event.time.columns)
        for n in names:
            tests.append(F.col(f"`{n}`").isNotNull())
            if isinstance(schema[n].dataType, T.StringType):
                tests.append(F.col(f"`{n}`") != "")
        if not names:
            tests.append(event.time.compile().isNotNull())
    return reduce(lambda a, b: a & b, tests) if tests else None


def text_unless_number(text: Column, number: Column) -> Column:
    """The text, or null where it says the same 32-bit number as ``number``."""
    plain = F.when(text.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"), text.try_cast("float"))
    return F.when(plain == number.cast("float"), None).otherwise(text)


def event_columns(rows: DataFrame, event: Event, dedup_text: bool = True, source_block: bool = True, row: bool = False) -> tuple[Column | None, list[Column], T.StructType]:
    """What an event block makes of ``rows``: which of them it takes, its columns, and their schema. Nothing is computed yet."""
    try:
        if missing := event.columns - set(rows.columns):
            raise ValueError(f"columns {', '.join(sorted(missing))} are not there")
        keep = row_filter(event, rows.schema)
        cols = [F.col("subject_id"), code_of(event.code).alias("code")]
        if parts := sorted(event.code.columns):
            cols.append(F.struct(*[F.col(f"`{c}`").alias(c) for c in parts]).alias("code_components"))
        time = F.lit(None).cast("timestamp_ntz") if event.time is None else event.time.compile()
        cols.append(time.alias("time"))
        extras = {k: e.compile() for k, e in event.extras.items()}
        if dedup_text and {"text_value", "numeric_value"} <= set(extras):
            extras["text_value"] = text_unless_number(extras["text_value"].cast("string"), extras["numeric_value"])
        cols += [c.alias(k) for k, c in extras.items()]
        if source_block:
            cols.append(F.lit(event.source_block).alias("source_block"))
        if row:
            cols.append(F.col(ROW))
        return keep, cols, rows.select(*cols).schema
    except Exception as e:
        raise ValueError(f"Error extracting event {event.source_block}: {e}") from e


def extract_event(df: DataFrame, event: Event, dedup_text: bool = True, source_block: bool = True, distinct: bool = True) -> DataFrame:
    """One block's events: subject_id, code, [code_components], time, extra columns, [source_block]."""
    keep, cols, _ = event_columns(df, event, dedup_text, source_block)
    out = (df if keep is None else df.where(keep)).select(*cols)
    return out.dropDuplicates() if distinct else out


def subject_rows(raw: DataFrame, table: Table, lookup: DataFrame | None = None) -> DataFrame:
    """The raw table after its lookup join, with ``subject_id`` and the transforms' columns; transforms do not see one another.

    Where the id comes from the lookup, rows without a match have none and no event: the join is an inner one then, which Spark may
    broadcast either side of and filter by the other side's keys.
    """
    df = raw
    if table.join is not None:
        theirs = table.id_expr is None and table.id_col not in raw.columns and table.id_col in table.join.columns
        df = lookup_join(raw, lookup, table.join, "inner" if theirs else "left")
    if table.id_expr is not None:
        df = df.withColumn("subject_id", table.id_expr.compile().cast("bigint"))
    elif table.id_col != "subject_id":
        # a copy: the id may be part of an expression, too
        df = df.withColumn("subject_id", F.col(f"`{table.id_col}`").cast("bigint"))
    else:
        df = df.withColumn("subject_id", F.col("subject_id").cast("bigint"))
    return df.withColumns({k: e.compile() for k, e in table.transforms.items()}) if table.transforms else df


def table_events(raw: DataFrame, table: Table, lookup: DataFrame | None = None, distinct: bool = True, dedup_text: bool = True) -> DataFrame | None:
    """All events of a table, with the block's place in the specification as ``__block__``; None for a table without blocks.

    A column with the rows' position in the raw table is passed on.

    The table is read, and joined, once: each row becomes an array with one entry for each block, null where the block does not
    take the row, and the array becomes rows. Only rows that some block takes are read.
    """
    if not table.events:
        return None
    rows = subject_rows(raw, table, lookup)
    blocks = [event_columns(rows, e, dedup_text, row=ROW in raw.columns) for e in table.events]
    if len(blocks) == 1:
        keep, cols, _ = blocks[0]
        out = (rows if keep is None else rows.where(keep)).select(*cols, F.lit(0).alias("__block__"))
    else:
        types = common_types([schema for _, _, schema in blocks])
        entries = []
        for i, (keep, cols, schema) in enumerate(blocks):
            entry = F.struct(*in_types(dict(zip(schema.names, cols)), schema, types), F.lit(i).alias("__block__"))
            entries.append(entry if keep is None else F.when(keep, entry))
        keeps = [keep for keep, _, _ in blocks]
        taken = rows if any(k is None for k in keeps) else rows.where(reduce(lambda a, b: a | b, keeps))
        out = taken.select(F.explode(F.array(*entries)).alias("e")).where("e is not null").select("e.*")
    return distinct_events(out) if distinct else out
