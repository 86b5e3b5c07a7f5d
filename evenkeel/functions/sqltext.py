"""SQL text. The comparison operators build their expressions as text: one ``selectExpr`` is a single
call into Spark, where the same expression made of column objects is dozens."""

from __future__ import annotations

from datetime import datetime


_MICROSECONDS = "yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS"
_JSON_OPTIONS = f"'ignoreNullFields', 'false', 'timestampFormat', '{_MICROSECONDS}XXX', 'timestampNTZFormat', '{_MICROSECONDS}'"


def name(column: str) -> str:
    """A column name, quoted."""
    return "`" + column.replace("`", "``") + "`"


def names(columns) -> list[str]:
    return [name(c) for c in columns]


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def moment(ts: datetime) -> str:
    """A ``timestamp_ntz`` literal."""
    return f"TIMESTAMP_NTZ '{ts:%Y-%m-%d %H:%M:%S.%f}'"


def struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"{text(n)}, {e}" for n, e in fields.items()) + ")"


def json(expression: str) -> str:
    """JSON text with nulls spelled out and times to the microsecond."""
    return f"to_json({expression}, map({_JSON_OPTIONS}))"


def any_null(columns) -> str:
    return "(" + " OR ".join(f"{name(c)} IS NULL" for c in columns) + ")"
