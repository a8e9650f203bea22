"""Row numbers over a whole table without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of values that are numbered apart.
RANGES = 256


def numbered(rows: DataFrame, by: str, name: str, ranges: int = RANGES) -> DataFrame:
    """``rows`` with their place, from 0, in ascending order of a whole number that is not null and does not repeat.

    Values are cut into ranges of about equal numbers of rows by approximate quantiles; rows are numbered within a range, and one small
    row a range says how many came before.
    """
    ends = rows.select(F.percentile_approx(by, [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0]
    cut = F.array(*[F.lit(e).cast("bigint") for e in sorted(set(ends or []))])
    bucket = F.size(F.filter(cut, lambda e: e < F.col(by))) if ends else F.lit(0)
    return placed(rows.withColumn("__b__", bucket), F.col(by), name)


def placed(rows: DataFrame, order: Column, name: str) -> DataFrame:
    """Rows with a bucket ``__b__`` (of a fixed number, in order of ``order``), numbered over all buckets."""
    count = rows.groupBy("__b__").agg(F.count("*").alias("__n__"))
    before = F.coalesce(F.sum("__n__").over(Window.orderBy("__b__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(count.select(F.col("__b__").alias("__of__"), before.alias("__before__")))  # one row a bucket
    within = F.row_number().over(Window.partitionBy("__b__").orderBy(order)) - 1
    # a plain equality lets Spark infer a filter for the other side, at times with a column that only this side has
    same = F.col("__b__").eqNullSafe(F.col("__of__"))
    return rows.join(starts, same).withColumn(name, (F.col("__before__") + within).cast("bigint")).drop("__b__", "__of__", "__before__")
