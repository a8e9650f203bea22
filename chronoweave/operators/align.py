"""Final schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType([T.StructField("subject_id", T.LongType()), T.StructField("time", T.TimestampNTZType()), T.StructField("code", T.StringType()), T.StructField("numeric_value", T.FloatType())])
CODES = T.StructType([T.StructField("code", T.StringType()), T.StructField("description", T.StringType()), T.StructField("parent_codes", T.ArrayType(T.StringType()))])
SPLITS = T.StructType([T.StructField("subject_id", T.LongType()), T.StructField("split", T.StringType())])


def align(df: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """The schema's columns first, cast, and null where ``df`` lacks them; other columns follow. ValueError if a required one is missing."""
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"mandatory columns {', '.join(missing)} are missing")
    own = {f.name: f.dataType for f in df.schema}
    cols = []
    for f in schema:
        c = F.col(f"`{f.name}`") if f.name in own else F.lit(None)
        if isinstance(f.dataType, T.ArrayType) and isinstance(own.get(f.name), T.StringType):
            c = F.when(c.isNotNull(), F.array(c))
        cols.append(c.cast(f.dataType).alias(f.name))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames()]
    text = [c.cast("string").alias("text_value") if n == "text_value" else c for n, c in zip([c for c in df.columns if c not in schema.fieldNames()], rest)]
    return df.select(*cols, *text)


def align_events(df: DataFrame) -> DataFrame:
    return align(df, EVENTS, ("subject_id", "time", "code"))


def align_codes(df: DataFrame) -> DataFrame:
    return align(df, CODES, ("code",))
