"""Columns that come, go and widen between a snapshot and a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

_WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())
# Digits that whole numbers of these types may have, and the types that hold them exactly.
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}
_EXACT_IN = {FloatType(): (ByteType(), ShortType()), DoubleType(): (ByteType(), ShortType(), IntegerType(), FloatType())}


def wider(one: DataType, other: DataType) -> DataType | None:
    """The type that holds every value of both without loss, None if there is none."""
    if one == other:
        return one
    for a, b in ((one, other), (other, one)):
        if a in _WHOLE and b in _WHOLE and _WHOLE.index(a) < _WHOLE.index(b):
            return b
        if a in _EXACT_IN.get(b, ()):
            return b
        if isinstance(a, DateType) and isinstance(b, TimestampNTZType):
            return b
        if isinstance(b, DecimalType) and (a in _DIGITS or isinstance(a, DecimalType)):
            scale = max(b.scale, a.scale if isinstance(a, DecimalType) else 0)
            whole = max(b.precision - b.scale, a.precision - a.scale if isinstance(a, DecimalType) else _DIGITS[a])
            return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def widened(existing: StructType, new: StructType) -> StructType:
    """The columns of both, those of `existing` first, each of a type that holds both. Names differ by more than case.

    A column whose types hold no common one without loss (text and numbers, say) is refused: to go on, the new column
    needs a new name or a cast.
    """
    known = {f.name.lower(): f for f in new.fields}
    fields = []
    for field in existing.fields:
        other = known.pop(field.name.lower(), None)
        kind = wider(field.dataType, other.dataType) if other else field.dataType
        if kind is None:
            types = f"{field.dataType.simpleString()} and {other.dataType.simpleString()}"
            raise TypeError(f"column {field.name}: no type holds both {types}")
        fields.append(StructField(field.name, kind, True, field.metadata))
    return StructType([*fields, *[StructField(f.name, f.dataType, True, f.metadata) for f in known.values()]])


def under(df: DataFrame, schema: StructType) -> DataFrame:
    """`df` under a schema as `widened` makes it: columns it lacks are NULL, narrower ones are cast."""
    own = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        held = own.get(field.name.lower())
        if held is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif held.dataType == field.dataType:
            columns.append(F.col(held.name).alias(field.name))
        else:
            columns.append(F.col(held.name).cast(field.dataType).alias(field.name))
    return df.select(*columns)


def reconciled(existing: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames under the columns of both; a frame that has them already passes as it is, layout and all."""
    schema = widened(existing.schema, new.schema)
    shape = [(f.name, f.dataType) for f in schema.fields]
    frames = [
        df if [(f.name, f.dataType) for f in df.schema.fields] == shape else under(df, schema) for df in (existing, new)
    ]
    return frames[0], frames[1]
