"""Values that a database stores in another form than it was given: JSON documents and padded or case-blind text.

A column is brought to one form on both sides before anything looks at it, so keys, digests and column diffs agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from evenkeel.errors import ConfigError
from evenkeel.functions.sqltext import name
from evenkeel.functions.types import NESTED, TEXT, type_of

#: Collations by Spark's names: trailing blanks do not count, case does not count, or both.
COLLATIONS = ("UTF8_BINARY_RTRIM", "UTF8_LCASE", "UTF8_LCASE_RTRIM")


def json_text(e: str, dtype: T.DataType) -> str:
    """JSON with its keys sorted and no spaces; text that is no JSON stays as it is. Zeros behind the last place of a number
    do not count; a number with an exponent is a double, and no integer equals it."""
    if isinstance(dtype, T.VariantType) or isinstance(dtype, NESTED):
        e = f"to_json({e})"
    elif not isinstance(dtype, TEXT):
        raise ConfigError(f"a column of type {dtype.simpleString()} holds no JSON")
    return f"coalesce(to_json(try_parse_json({e})), {e})"


def collated(e: str, dtype: T.DataType, collation: str) -> str:
    """A text that is equal to another one's exactly when the collation calls the two equal."""
    if collation not in COLLATIONS:
        raise ConfigError(f"unknown collation {collation!r}; known: {', '.join(COLLATIONS)}")
    if not isinstance(dtype, TEXT):
        raise ConfigError(f"a column of type {dtype.simpleString()} has no collation")
    if "RTRIM" in collation:
        e = f"rtrim({e})"
    # lower() writes a final sigma in a form of its own
    return f"translate(lower({e}), 'ς', 'σ')" if "LCASE" in collation else f"CAST({e} AS STRING)"


def normalised(df: DataFrame, json_columns=(), collations=()) -> DataFrame:
    """The frame with some columns in one form; columns that it lacks are left to the drift check."""
    forms = {c: json_text(name(c), type_of(df, c)) for c in json_columns if c in df.columns}
    for c, collation in collations:
        if c in forms:
            raise ConfigError(f"column {c} is both JSON and collated text")
        if c in df.columns:
            forms[c] = collated(name(c), type_of(df, c), collation)
    return df.selectExpr(*[f"{forms[c]} AS {name(c)}" if c in forms else name(c) for c in df.columns]) if forms else df
