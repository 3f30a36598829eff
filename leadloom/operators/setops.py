"""Unions."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_all(*dfs: DataFrame) -> DataFrame:
    """Stack tables of one layout; columns are matched by name."""
    return reduce(DataFrame.unionByName, dfs)


def union_by_name(
    named: Mapping[str, DataFrame],
    tag_column: str | None = None,
    exclude: Collection[str] = (),
    skip_empty: bool = False,
) -> DataFrame:
    """Stack tables of different layouts; a column a table lacks reads NULL.

    ``tag_column`` records the name of the table a row came from. An empty table
    adds no columns when ``skip_empty`` is set. No table gives an empty result.
    """
    kept = {n: df for n, df in named.items() if n not in exclude}
    if skip_empty:
        kept = {n: df for n, df in kept.items() if not df.isEmpty()}
    if not kept:
        return SparkSession.active().createDataFrame([], T.StructType([]))
    parts = list(kept.values())
    if tag_column is not None:
        parts = [df.withColumn(tag_column, F.lit(n)) for n, df in kept.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
