"""Aligning frames whose columns drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC_RANK = {T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2, T.LongType: 3,
                 T.FloatType: 4, T.DoubleType: 5}


def quoted(name: str) -> str:
    """``name`` as an expression, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """Common type of two columns: equal types stay, numbers widen to the
    larger (integers with fractions to double), structs and arrays merge, and
    anything else goes to string."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    ra, rb = _NUMERIC_RANK.get(type(a)), _NUMERIC_RANK.get(type(b))
    if ra is not None and rb is not None:
        return a if ra >= rb else b
    if isinstance(a, T.DecimalType) and rb is not None or isinstance(b, T.DecimalType) and ra is not None:
        return T.DoubleType()
    return T.StringType()


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """Union of columns by name, in first-seen order, with widened types."""
    order: list[str] = []
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            if f.name not in types:
                order.append(f.name)
                types[f.name] = f.dataType
            else:
                types[f.name] = widen(types[f.name], f.dataType)
    return T.StructType([T.StructField(n, types[n]) for n in order])


def _cast(col: str, src: T.DataType, dst: T.DataType):
    value = F.col(quoted(col))
    if src == dst:
        return value
    if isinstance(dst, T.StringType) and isinstance(src, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    if isinstance(dst, (T.StructType, T.ArrayType)):
        return F.from_json(F.to_json(value), dst)  # by name at every level, as casts are not
    return value.cast(dst)


def align_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union all of ``frames`` by column name; a column missing from a frame
    is NULL there, and disagreeing types are widened first (never the
    positional union that puts values under the wrong name)."""
    if not frames:
        raise ValueError("nothing to align")
    target = common_schema([f.schema for f in frames])
    aligned = []
    for frame in frames:
        have = {f.name: f.dataType for f in frame.schema.fields}
        aligned.append(frame.select(*[
            (_cast(f.name, have[f.name], f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields]))
    return reduce(lambda a, b: a.unionByName(b), aligned)
