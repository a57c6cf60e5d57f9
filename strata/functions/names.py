"""Column-name functions over a schema (PRJ-10, CON-3)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def standardize_column_name(name: str) -> str:
    """lower; space and hyphen -> ``_``; drop anything else outside [a-z0-9_]."""
    s = name.lower().replace(" ", "_").replace("-", "_")
    return re.sub(r"[^a-z0-9_]", "", s)


def standardize_names(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`standardize_column_name`; two columns
    mapping to one name is an error rather than a silent overwrite."""
    new = [standardize_column_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if not n:
            raise ValueError(f"column {old!r} standardizes to an empty name")
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both standardize to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def strip_header(df: DataFrame) -> DataFrame:
    """Strip whitespace around header names (SRC-3)."""
    return df.toDF(*[c.strip() for c in df.columns])


# Naming rules on columns by suffix -> allowed Spark types.
SUFFIX_TYPES = {
    "_flag": (T.BooleanType,),
    "_at": (T.TimestampType, T.TimestampNTZType),
    "_amount": (T.DecimalType,),
    "_pct": (T.DecimalType,),
    "_count": (T.LongType, T.IntegerType),
}
_SNAKE = re.compile(r"^[a-z][a-z0-9_]*$")


def naming_violations(schema: T.StructType, table: str = "") -> list[tuple[str, str, str]]:
    """CON-3: ``(table, column, problem)`` for non-snake_case names and for
    suffixes whose type does not match.  Operates on metadata only."""
    out = []
    for f in schema.fields:
        if not _SNAKE.match(f.name) or "__" in f.name:
            out.append((table, f.name, "not snake_case"))
        for suffix, types in SUFFIX_TYPES.items():
            if f.name.endswith(suffix) and not isinstance(f.dataType, types):
                out.append((table, f.name, f"suffix {suffix} requires {'/'.join(t.__name__ for t in types)}"))
    return out
