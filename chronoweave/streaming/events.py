"""Event extraction on streams: the same projections, with state only where duplicates are to go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.events import table_events
from ..plans.spec import Table


def stream_events(raw: DataFrame, table: Table, lookup: DataFrame | None = None, watermark: str | None = None) -> DataFrame:
    """Events of a streamed table. ``lookup`` is a static frame. With a watermark, duplicates within it are dropped; without one rows pass without state."""
    out = table_events(raw, table, lookup, distinct=False).drop("__block__")
    if watermark is None:
        return out
    # event time needs an instant; the zone is the session's
    timed = out.withColumn("__at__", F.col("time").cast("timestamp_ltz")).withWatermark("__at__", watermark)
    return timed.dropDuplicatesWithinWatermark([c for c in out.columns if c != "code_components"]).drop("__at__")
