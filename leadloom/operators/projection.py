"""Projection and null predicates."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(
    df: DataFrame,
    columns: Mapping[str, str | Column],
    pad: Mapping[str, str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Select, rename and reorder; ``pad`` adds typed NULL columns.

    ``columns`` maps the new name to an old name or an expression. A bare
    ``lit(None)`` would be of type void and cannot be written to Parquet, so
    padding always names a type.
    """
    out = {new: F.col(old) if isinstance(old, str) else old for new, old in columns.items()}
    for name, dtype in (pad or {}).items():
        out[name] = F.lit(None).cast(dtype)
    return df.select(*[out[name].alias(name) for name in (order or out)])


def any_not_null(*cols: str | Column) -> Column:
    tests = [(F.col(c) if isinstance(c, str) else c).isNotNull() for c in cols]
    return reduce(lambda a, b: a | b, tests)


def not_null(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).isNotNull()
