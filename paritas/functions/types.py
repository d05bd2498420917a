"""Type classes used to pick which checks apply to a column.

The reference names numeric, string and temporal sets by class name; we test with
``isinstance`` so that parameterised types (decimal, varchar) and timestamp_ntz count.
"""

from __future__ import annotations

from pyspark.sql import types as T


_UNORDERED = (T.MapType,) + ((T.VariantType,) if hasattr(T, "VariantType") else ())


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def is_floating(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def is_string(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.VarcharType, T.CharType))


def is_temporal(dt: T.DataType) -> bool:
    return isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType))


def is_orderable(dt: T.DataType) -> bool:
    """min/max apply: atomic types, and arrays/structs of orderable types."""
    if isinstance(dt, _UNORDERED):
        return False
    if isinstance(dt, T.ArrayType):
        return is_orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(is_orderable(f.dataType) for f in dt.fields)
    return True


def contains_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.ArrayType):
        return contains_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(contains_map(f.dataType) for f in dt.fields)
    return False


def type_class(dt: T.DataType) -> str:
    if is_numeric(dt):
        return "numeric"
    if is_string(dt):
        return "string"
    if is_temporal(dt):
        return "temporal"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, T.BinaryType):
        return "binary"
    return "nested"


def _digits(dt: T.DataType) -> tuple[int, int] | None:
    """(integer digits, scale) of an integral or decimal type."""
    whole = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}.get(type(dt))
    if whole:
        return whole, 0
    return (dt.precision - dt.scale, dt.scale) if isinstance(dt, T.DecimalType) else None


def comparable(a: T.DataType, b: T.DataType) -> bool:
    """Values of the two types can be compared natively: the type Spark widens both to holds every value of
    both exactly (a bigint or decimal against a double does not: 2^53 and 2^53 + 1 would meet). Float
    against double does not count either: widened, 0.1 would differ from 0.1, while both equal the
    decimal 0.1; all three meet in their normal form."""
    if a == b:
        return True
    if is_numeric(a) and is_numeric(b):
        da, db = _digits(a), _digits(b)
        if da and db:
            return max(da[0], db[0]) + max(da[1], db[1]) <= 38
        if not da and not db:
            return False
        held, floating = (da, b) if da else (db, a)
        return isinstance(a if da else b, (T.ByteType, T.ShortType, T.IntegerType)) and held[0] <= (15 if isinstance(floating, T.DoubleType) else 5)
    return is_temporal(a) and is_temporal(b) and not {type(a), type(b)} == {T.DateType, T.TimestampType}
