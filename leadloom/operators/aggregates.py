"""Grouped aggregation and the aggregate expressions the models share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregate(df: DataFrame, keys: Sequence[str | Column], measures: Mapping[str, Column]) -> DataFrame:
    """``groupBy(keys).agg(...)``; NULL keys form one group."""
    return df.groupBy(*keys).agg(*[c.alias(name) for name, c in measures.items()])


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; false and NULL do not count."""
    return F.count_if(condition)


def value_of_latest(
    value: Column,
    order_by: Column,
    nulls: str = "first",
    tiebreak: Sequence[Column] = (),
    only: Column | None = None,
) -> Column:
    """Value taken from the row that a descending order would put first.

    ``nulls="first"`` ranks a NULL order value above all others. The ordering
    struct is never NULL itself, so the value may be NULL. One candidate row per
    group is kept while aggregating, no array is built. ``only`` restricts the
    candidates.
    """
    if nulls not in ("first", "last"):
        raise ValueError(f"nulls must be 'first' or 'last', not {nulls!r}")
    null_rank = order_by.isNull() if nulls == "first" else order_by.isNotNull()
    rank = F.struct(null_rank, order_by, *tiebreak)
    return F.max_by(value, rank if only is None else F.when(only, rank))


def distinct_days(ts: Column) -> Column:
    return F.count_distinct(F.to_date(ts))


def reached_after(ts: Column, start: Column, days: int) -> Column:
    """1 if any row lies at least ``days`` after ``start``, 0 if none does,
    NULL if no comparison has a result."""
    limit = start + F.make_dt_interval(F.lit(days))
    return F.bool_or(ts >= limit).cast("int")


def category_counts(df: DataFrame, column: str, default: str = "UNKNOWN") -> DataFrame:
    label = F.coalesce(F.col(column), F.lit(default)).alias(column)
    return df.groupBy(label).agg(F.count("*").alias("row_count"))
