"""Helpers that the corpus operators share: shared-folder tables, safe column names, bounded Arrow slices."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.files import materialize, release

__all__ = ["by_size", "fitted", "fresh", "materialize", "middle", "over_texts", "release", "slices", "unit", "utf8", "written"]

#: Rows with texts that go to a worker at once.
BATCH_ROWS = 1_000
#: Text bytes that a task turns into NumPy arrays at once.
SLICE_BYTES = 1_000_000


def written(df: DataFrame, tag: str, files: int | None = None) -> tuple[DataFrame, int]:
    """``materialize``, and the number of rows, which the write itself counts."""
    seen = Observation()
    table = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), tag, files)
    return table, seen.get.get("n", 0)


def over_texts(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for rows with whole texts, of which the session's default batch of 10,000 is too many.

    Sets the session's batch to ``BATCH_ROWS`` unless it was set to something else: a batch lies in memory four times, before and
    behind the worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if conf.get(name) == "10000":
        conf.set(name, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def fitted(sample: DataFrame, fit: Callable[[pa.Table], object]):
    """What ``fit`` makes of all rows of a bounded sample, computed in one task; the driver gets the result alone. None without rows."""

    def run(rows: pa.Table) -> pa.Table:
        return pa.table({"model": pa.array([pickle.dumps(fit(rows), 5)], pa.binary())})

    got = sample.groupBy().applyInArrow(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else None


def middle(text: Column, most: int) -> Column:
    """The text, or the ``most`` characters in the middle of a longer one."""
    size = F.length(text)
    return F.when(size <= most, text).otherwise(F.substring(text, F.floor((size - most) / 2).cast("int") + 1, F.lit(most)))


def unit(h: Column) -> Column:
    """A 64-bit hash as a number from 0 to 1."""
    return (h + 2.0**63) / 2.0**64


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or with underscores added until no column has it (Spark compares names without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_size(df: DataFrame, rows: int, most: int) -> DataFrame:
    """``df`` with a broadcast hint where its counted ``rows`` are at most ``most``; else the join shuffles."""
    return F.broadcast(df) if rows <= most else df


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of at most ``rows`` rows whose texts hold at most ``most`` bytes (a longer text stands alone)."""
    import numpy as np

    col = batch.column(text)
    n = len(col)
    if n == 0:
        return
    wide = pa.types.is_large_string(col.type)
    ends = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    at = 0
    while at < n:
        to = int(np.searchsorted(ends, ends[at] + most, side="right")) - 1
        to = min(n, at + rows, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to


def utf8(col: pa.Array):
    """(bytes, offsets) of a string column: bytes as uint8, offsets from 0, a null as an empty text."""
    import numpy as np

    if col.null_count:
        import pyarrow.compute as pc

        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    n = len(col)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]
