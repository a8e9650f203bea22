"""Balanced contiguous shards: global prefix sums of byte sizes from per-partition totals, cut at equal targets.

Only ids, sizes and checksums move, never texts. Rows are range-partitioned and sorted by id, checksum and size; each partition
writes its running sums; the partitions' totals (one row a partition) give every partition its offset; a document goes to the
shard that holds the middle of its bytes. Shards are contiguous runs of ids whose sizes differ from the target by less than
the largest document.

Nulls, ties: a null text has size 1 and checksum 0; null ids come first. Rows with the same id are ordered by checksum, then
size; rows equal in all three are interchangeable. Any order of the input gives the same shards. An empty table gives no rows. With more shards
than bytes some stay empty. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize

SHARDS = 16


def _running_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, rows, size = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        own = b.column("size").to_numpy()
        ends = size + np.cumsum(own)
        cols = [*b.columns, pa.array(np.full(len(b), part, np.int32)), pa.array(rows + np.arange(len(b))), pa.array(ends - own)]
        yield pa.RecordBatch.from_arrays(cols, ["id", "size", "crc", "part", "row", "before"])
        rows += len(b)
        size = int(ends[-1]) if len(b) else size


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row; size: UTF-8 bytes and one for the separator."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    # written, as finding the ranges reads its input, too: texts are read once
    sized = materialize(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc")), "texts")
    kind = sized.schema["id"].dataType.simpleString()
    # rows equal in all that is kept are spread by where they were read; which of them comes first changes nothing
    spread = sized.withColumn("tie", F.monotonically_increasing_id())
    ordered = spread.repartitionByRange("id", "crc", "size", "tie").sortWithinPartitions("id", "crc", "size").select("id", "size", "crc")
    local = materialize(ordered.mapInArrow(_running_sums, f"id {kind}, size long, crc long, part int, row long, before long"), "sizes")
    totals = sorted(local.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect())  # one row a partition
    total = sum(t["b"] for t in totals)
    offsets, n, b = [], 0, 0
    for t in totals:
        offsets.append((t["part"], n, b))
        n, b = n + t["n"], b + t["b"]
    spark = docs.sparkSession
    at = F.broadcast(spark.createDataFrame(offsets, "part int, rows0 long, bytes0 long"))
    placed = local.join(at, "part").select("id", "size", F.col("crc").alias("text_crc32"), (F.col("row") + F.col("rows0")).alias("place"), F.expr(f"int(least({shards - 1}L, (((before + bytes0) * 2 + size) * {shards}L) div {2 * max(total, 1)}L))").alias("shard"))
    firsts = F.broadcast(placed.groupBy("shard").agg(F.min("place").alias("first")))  # one row a shard
    return placed.join(firsts, "shard").select("id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    out = shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _crc_table() -> str:
    """The remainders of all bytes under the polynomial of crc32, as an SQL list."""
    table = []
    for v in range(256):
        for _ in range(8):
            v = v >> 1 ^ (0xEDB88320 if v & 1 else 0)
        table.append(v)
    return f"[{', '.join(map(str, table))}]"


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM documents
), s AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda a, b: xor(a >> 8, {_crc_table()}[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM d
), p AS (
  SELECT *, sum(size) OVER w - size AS before, sum(size) OVER () AS total, row_number() OVER w AS place
  FROM s WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
), q AS (
  SELECT *, CAST(least(15, (before * 2 + size) * 16 // (2 * total)) AS INTEGER) AS shard FROM p
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, place - min(place) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM q
"""
