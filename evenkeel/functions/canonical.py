"""Canonical text of rows, and the digests that stand for them in shuffles. All functions return SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from evenkeel.functions import sqltext
from evenkeel.functions.types import FLOATING, INTEGRAL, NESTED, TIMESTAMP, as_text, type_of, with_sorted_maps
from evenkeel.spec import HASH_DECIMALS


def rounded(e: str, decimals: int) -> str:
    """``round(e, decimals)`` for doubles, several times faster where the value has no more decimals.

    ``round`` goes through decimal text. Below 10^14 units the scaled value is off by less than 0.01, so
    when it is whole, the nearest double to that many units is the rounded value; adding 0 drops the
    sign of a negative zero.
    """
    unit = f"1e{decimals}D"
    scaled = f"{e} * {unit}"
    return f"if(abs({e}) < 1e{14 - decimals}D AND {scaled} = rint({scaled}), rint({scaled}) / {unit} + 0.0D, round({e}, {decimals}))"


def canonical(
    e: str,
    dtype: T.DataType,
    decimals: int | None = HASH_DECIMALS,
    round_decimals: bool = False,
    timestamp_unit: str = "second",
) -> str:
    """The text under which a value is hashed: two values are equal when their texts are. Floats are
    rounded, unless ``decimals`` is None; decimals are where ``round_decimals`` says so, and stay decimals."""
    if isinstance(dtype, T.BinaryType):
        return f"hex({e})"
    if isinstance(dtype, FLOATING) and decimals is not None:
        return f"CAST({rounded(e, decimals) if isinstance(dtype, T.DoubleType) else f'round({e}, {decimals})'} AS STRING)"
    if isinstance(dtype, FLOATING):
        return f"CAST({e} + CAST(0 AS {dtype.simpleString()}) AS STRING)"  # drops the sign of a negative zero
    if isinstance(dtype, T.DecimalType) and round_decimals and decimals is not None:
        return f"CAST(round({e}, {decimals}) AS STRING)"
    if isinstance(dtype, NESTED):
        return sqltext.json(with_sorted_maps(e, dtype))
    if isinstance(dtype, TIMESTAMP):
        epoch = "unix_micros" if timestamp_unit == "microsecond" else "unix_seconds"
        return f"CAST({epoch}(CAST({e} AS TIMESTAMP)) AS STRING)"
    return f"CAST({e} AS STRING)"


def decimals_for(tolerance: float) -> int | None:
    """Decimal places that keep differences above the tolerance visible; ``None``, which is exact, for none."""
    return None if tolerance <= 0 else max(0, math.ceil(-math.log10(tolerance)))


def canonical_columns(df: DataFrame, columns, **form) -> dict[str, str]:
    return {c: canonical(sqltext.name(c), type_of(df, c), **form) for c in columns}


def canonical_rows(df: DataFrame, columns, **form) -> DataFrame:
    """Project ``columns`` to their canonical text."""
    return df.selectExpr(*[f"{e} AS {sqltext.name(c)}" for c, e in canonical_columns(df, columns, **form).items()])


def row_json(df: DataFrame, columns, **form) -> str:
    """One row as JSON of its canonical values: columns by name, nulls spelled out."""
    return sqltext.json(sqltext.struct(canonical_columns(df, sorted(columns), **form)))


def row_digest(df: DataFrame, columns, **form) -> str:
    """SHA-256 (hex) over the row's JSON; a constant if there is nothing to hash."""
    return f"sha2({row_json(df, columns, **form)}, 256)" if columns else "'no_compare_cols'"


def with_row_hash(df: DataFrame, columns, keys=(), column: str = "row_hash", **form) -> DataFrame:
    """Add the digest of the compared columns that are not keys."""
    digest = row_digest(df, [c for c in columns if c not in set(keys)], **form)
    return df.selectExpr("*", f"{digest} AS {sqltext.name(column)}")


def digest_words(digest: str) -> list[str]:
    """Two 64-bit words of a hex digest.

    Fixed-width words can live in hash-aggregate buffers, which strings cannot; 128 bits of SHA-256
    leave no practical chance that two different rows of one key look alike.
    """
    return [f"xxhash64(substring({digest}, {start}, 32))" for start in (1, 33)]


def comparable(e: str, dtype: T.DataType, decimals: int | None = HASH_DECIMALS, round_decimals: bool = False, timestamp_unit: str = "second") -> str:
    """A value whose hash stands for its canonical text: equal exactly when the texts are equal, but not made text where
    its type can be hashed as it is."""
    form = {"decimals": decimals, "round_decimals": round_decimals, "timestamp_unit": timestamp_unit}
    if isinstance(dtype, T.DoubleType) and decimals is not None:
        return rounded(e, decimals)
    if isinstance(dtype, FLOATING):
        return f"round({e}, {decimals})" if decimals is not None else e
    if isinstance(dtype, T.DecimalType) and round_decimals and decimals is not None:
        return f"round({e}, {decimals})"
    if isinstance(dtype, TIMESTAMP):
        return f"{'unix_micros' if timestamp_unit == 'microsecond' else 'unix_seconds'}(CAST({e} AS TIMESTAMP))"
    if isinstance(dtype, NESTED) or not isinstance(dtype, INTEGRAL + (T.DecimalType, T.StringType, T.BinaryType, T.BooleanType, T.DateType)):
        return canonical(e, dtype, **form)
    return e


#: The form of keys, which are never rounded.
_EXACT = {"decimals": None, "timestamp_unit": "microsecond"}


def digest_of(df: DataFrame, keys, columns, seed: int, form) -> str:
    """SQL for a 64-bit digest of a row; nulls count."""
    values = [(c, comparable(sqltext.name(c), type_of(df, c), **(_EXACT if c in keys else form))) for c in [*keys, *columns]]
    return f"xxhash64({', '.join([str(seed), *[f'{sqltext.name(c)} IS NULL, {v}' for c, v in values]])})"


def quick_words(df: DataFrame, columns, **form) -> list[str]:
    """Two 64-bit words of a row that differ where its texts do, up to chance, hashed from values that are not made text:
    several times faster than ``row_digest``."""
    return [digest_of(df, (), columns, seed, form) for seed in (0, 1)]


def quick_digest(words) -> str:
    """Such words as bytes, in place of a SHA-256."""
    return f"CAST(concat({words[0]}, ' ', {words[1]}) AS BINARY)"


def key_json(keys, df: DataFrame) -> str:
    """Key values as JSON text, nulls spelled out."""
    return sqltext.json(sqltext.struct({k: as_text(sqltext.name(k), type_of(df, k)) for k in keys}))
