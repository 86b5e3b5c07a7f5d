"""Type families and the common type under which two columns are compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from evenkeel.functions import sqltext

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
NESTED = (T.ArrayType, T.MapType, T.StructType)
TIMESTAMP = (T.TimestampType, T.TimestampNTZType)
TEXT = (T.StringType, T.CharType, T.VarcharType)

# Digits of a decimal that a double always holds.
_DOUBLE_DIGITS = 15

# Decimal digits that hold every value of the integral type.
_INTEGRAL_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, INTEGRAL + FLOATING + (T.DecimalType,))


def holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(holds_map(f.dataType) for f in dtype.fields)
    return False


def _as_decimal(dtype: T.DataType) -> T.DecimalType:
    if isinstance(dtype, T.DecimalType):
        return dtype
    return T.DecimalType(_INTEGRAL_DIGITS[dtype.simpleString()], 0)


def _beside_double(exact: T.DecimalType) -> T.DecimalType:
    """The decimal in which a wide decimal or bigint meets a double: all its own digits, one more whole digit if there is
    room for it, and as many places as are left."""
    whole = exact.precision - exact.scale
    return T.DecimalType(38, max(exact.scale, 38 - whole - 1))


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type both sides can be cast to without losing a difference; ``None`` if there is none."""
    if isinstance(a, TEXT) and isinstance(b, TEXT):
        return T.StringType()
    if isinstance(a, TIMESTAMP) and isinstance(b, TIMESTAMP):
        return T.TimestampType()
    if a == b:
        return a
    for date, time in ((a, b), (b, a)):
        if isinstance(date, T.DateType) and isinstance(time, TIMESTAMP):
            return T.TimestampType()
    if is_numeric(a) and is_numeric(b):
        if isinstance(a, FLOATING) or isinstance(b, FLOATING):
            other = b if isinstance(a, FLOATING) else a
            if isinstance(other, FLOATING) or _as_decimal(other).precision <= _DOUBLE_DIGITS:
                return T.DoubleType()
            return _beside_double(_as_decimal(other))
        if isinstance(a, INTEGRAL) and isinstance(b, INTEGRAL):
            return T.LongType()
        da, db = _as_decimal(a), _as_decimal(b)
        scale = max(da.scale, db.scale)
        whole = max(da.precision - da.scale, db.precision - db.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if isinstance(a, NESTED) and a.simpleString() == b.simpleString():
        return a
    return None


def converted(e: str, dtype: T.DataType, to: T.DataType, exact: bool = True) -> str:
    """A value in the common type. A double beside a wide decimal or bigint is the decimal that its shortest text names.
    One that is too large for it or not a number becomes the largest decimal of the type, which the other side does not
    reach (unless it has 38 digits itself); so does one with more places than fit, if it is to be ``exact``, as nothing
    there can equal it; else it is rounded to the places that fit."""
    if isinstance(dtype, FLOATING) and isinstance(to, T.DecimalType):
        cast, whole = f"try_cast({e} AS {to.simpleString()})", to.precision - to.scale
        beyond = f"CAST('{'9' * whole}{'.' + '9' * to.scale if to.scale else ''}' AS {to.simpleString()})"
        held = f"if(CAST({cast} AS DOUBLE) = CAST({e} AS DOUBLE), {cast}, NULL)" if exact else cast
        return f"if({e} IS NULL, NULL, coalesce({held}, {beyond}))"
    return f"CAST({e} AS {to.simpleString()})"


def with_sorted_maps(e: str, dtype: T.DataType, depth: int = 0) -> str:
    """Rewrite every map so that its entries are in key order; equal maps then print alike."""
    if not holds_map(dtype):
        return e
    x = f"x{depth}"
    if isinstance(dtype, T.ArrayType):
        return f"transform({e}, {x} -> {with_sorted_maps(x, dtype.elementType, depth + 1)})"
    if isinstance(dtype, T.StructType):
        fields = {f.name: with_sorted_maps(f"({e}).{sqltext.name(f.name)}", f.dataType, depth) for f in dtype.fields}
        return f"if(({e}) IS NULL, NULL, {sqltext.struct(fields)})"
    value = f"{x}.value"
    if holds_map(dtype.valueType):  # maps have no order of their own, their text has
        value = sqltext.json(with_sorted_maps(value, dtype.valueType, depth + 1))
    entry = sqltext.struct({"key": f"{x}.key", "value": value})
    return f"map_from_entries(array_sort(transform(map_entries({e}), {x} -> {entry})))"


def as_text(e: str, dtype: T.DataType) -> str:
    """A value as evidence: readable text that keeps full precision."""
    if isinstance(dtype, T.BinaryType):
        return f"hex({e})"
    if isinstance(dtype, NESTED):
        return sqltext.json(with_sorted_maps(e, dtype))
    return f"CAST({e} AS STRING)"
