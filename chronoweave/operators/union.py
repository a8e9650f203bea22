"""Unions by name across differing schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = {T.BooleanType: 0, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4, T.FloatType: 5, T.DoubleType: 6}


def supertype(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both: null < anything, numbers widen, date < timestamp, anything else is text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f.dataType for f in a}
        for f in b:
            fields[f.name] = supertype(fields[f.name], f.dataType) if f.name in fields else f.dataType
        return T.StructType([T.StructField(k, fields[k]) for k in sorted(fields)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(supertype(a.elementType, b.elementType))
    if isinstance(a, T.ArrayType) or isinstance(b, T.ArrayType):
        array, other = (a, b) if isinstance(a, T.ArrayType) else (b, a)
        return T.ArrayType(supertype(array.elementType, other))
    if {type(a), type(b)} <= set(_RANK):
        low, high = sorted((a, b), key=lambda t: _RANK[type(t)])
        if isinstance(low, T.BooleanType):
            return T.StringType()
        if isinstance(high, T.FloatType) and isinstance(low, (T.IntegerType, T.LongType)):
            return T.DoubleType()
        return high
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def _as(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return c
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name: f.dataType for f in have}
        fields = [(_as(c[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and not isinstance(have, (T.ArrayType, T.NullType)):
        return F.when(c.isNotNull(), F.array(c.cast(want.elementType)))
    return c.cast(want)


def common_types(schemas: list[T.StructType]) -> dict[str, T.DataType]:
    """Each column that some schema has, in order of first appearance, with the supertype of its types."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            types[f.name] = supertype(types[f.name], f.dataType) if f.name in types else f.dataType
    return types


def in_types(columns: dict[str, Column], schema: T.StructType, types: dict[str, T.DataType]) -> list[Column]:
    """The columns (of the types in ``schema``) in the wanted types and their order, null where there is none."""
    own = {f.name: f.dataType for f in schema}
    return [(_as(columns[n], own[n], t) if n in own else F.lit(None).cast(t)).alias(n) for n, t in types.items()]


def diagonal_union(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name: a missing column is null, types meet in their supertype, structs get all fields.

    Spark's own coercion would turn a union of numbers and text into numbers and fail on the text, so casts come first.
    """
    types = common_types([df.schema for df in frames])
    aligned = [df.select(*in_types({c: F.col(f"`{c}`") for c in df.columns}, df.schema, types)) for df in frames]
    return reduce(lambda a, b: a.unionByName(b), aligned)


def vertical_union(frames: list[DataFrame], relaxed: bool = False) -> DataFrame:
    """UNION ALL of frames with the same columns; types must agree unless ``relaxed``."""
    first = frames[0]
    for df in frames[1:]:
        if set(df.columns) != set(first.columns) or not relaxed and dict(df.dtypes) != dict(first.dtypes):
            raise ValueError(f"frames differ: {first.dtypes} and {df.dtypes}")
    return diagonal_union(frames)
