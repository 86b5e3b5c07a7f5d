"""Which columns of two tables are compared, under which types, and how the schemas differ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from evenkeel.errors import ConfigError, SchemaDrift
from evenkeel.functions import sqltext
from evenkeel.functions.canonical import canonical
from evenkeel.functions.literals import literal_frame
from evenkeel.functions.types import NESTED, common_type, converted, type_of
from evenkeel.spec import DRIFT_POLICIES

DRIFT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("column_name", "drift", "source_type", "target_type")])


def resolve_columns(source: DataFrame, target: DataFrame, skip=(), policy: str = "fail") -> list[str]:
    """Sorted names of the compared columns, or ``SchemaDrift``.

    ``fail`` looks at all columns, skipped ones included. ``intersect`` and ``ignore_extra`` both
    take what the sides share; ``require_source_columns`` also insists that the target has every
    column of the source.
    """
    if policy not in DRIFT_POLICIES:
        raise ConfigError(f"unknown schema drift policy {policy!r}; known: {', '.join(DRIFT_POLICIES)}")
    in_source, in_target = set(source.columns), set(target.columns)
    missing, extra = in_source - in_target, in_target - in_source
    if policy == "fail" and (missing or extra):
        raise SchemaDrift(missing, extra)
    if policy == "require_source_columns" and missing:
        raise SchemaDrift(missing, ())
    return sorted((in_source & in_target) - set(skip))


def schema_drift(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per column that is on one side only, or whose types have no common type."""
    sides = {s.name: s.dataType for s in source.schema.fields}, {t.name: t.dataType for t in target.schema.fields}
    rows = []
    for name in sorted(sides[0].keys() | sides[1].keys()):
        s, t = sides[0].get(name), sides[1].get(name)
        if t is None:
            kind = "extra_in_source"
        elif s is None:
            kind = "extra_in_target"
        elif common_type(s, t) is None:
            kind = "type_mismatch"
        else:
            continue
        rows.append((name, kind, s and s.simpleString(), t and t.simpleString()))
    return literal_frame(source.sparkSession, rows, DRIFT_SCHEMA)


def align(source: DataFrame, target: DataFrame, columns, exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """Project both sides to ``columns`` under one type each; text where no common type exists. ``exact`` says whether a
    double may equal a decimal of which it differs in places beyond those of the common type."""
    left, right = [], []
    for c in columns:
        s, t, q = type_of(source, c), type_of(target, c), sqltext.name(c)
        shared = common_type(s, t)
        for out, dtype in ((left, s), (right, t)):
            if shared is None:
                out.append(f"{canonical(q, dtype)} AS {q}")
            else:
                out.append(q if dtype == shared else f"{converted(q, dtype, shared, exact)} AS {q}")
    return source.selectExpr(*left), target.selectExpr(*right)


def coerce_complex_to_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for sinks that only know scalar columns."""
    return df.selectExpr(*[
        f"to_json({sqltext.name(f.name)}) AS {sqltext.name(f.name)}" if isinstance(f.dataType, NESTED) else sqltext.name(f.name)
        for f in df.schema.fields
    ])
