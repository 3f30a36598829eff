"""Attach child rows to their parent, in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.operators.joins import HEAVY_ROWS, left_join_fanout


def attach_rows(
    parents: DataFrame,
    children: DataFrame,
    key: str,
    position: str,
    fields: Sequence[str],
    order: str,
    keep_childless: bool = True,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Parents with their children, one row per child, numbered from 1 in ``order``.

    ``position`` is an integer, counted from 0 and unique within the key, so the
    number follows from it and no task needs all children of a parent: a parent
    that owns a third of all children is spread over many tasks. Parents without
    children get one row with NULLs, or none.
    """
    named = children.select(key, (F.col(position) + 1).cast("long").alias(order), *fields)
    if keep_childless:
        return left_join_fanout(parents, named, [key], heavy_rows)
    return parents.join(named, on=key)
