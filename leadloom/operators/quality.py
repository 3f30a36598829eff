"""Checks that return the violating rows, so an empty result means "passed"."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count.

    As in a unique constraint, a key with a NULL part never collides.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.where(complete).groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counts.where(F.col("row_count") > 1)


def _violating(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    hits = F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))
    return df.withColumn("violated", hits).where(F.size("violated") > 0)


def violations_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a required column; ``violated`` lists the columns."""
    return _violating(df, {c: F.col(c).isNull() for c in cols})


def violations_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text longer than its column allows."""
    return _violating(df, {c: F.char_length(F.col(c)) > n for c, n in limits.items()})


def column_type_mismatches(df: DataFrame, declared: Mapping[str, str]) -> list[tuple[str, str, str]]:
    """Columns whose type differs from the declared dimension type.

    ``declared`` names ``timestamp``, ``number``, ``boolean`` or ``string``; the
    answer comes from the schema, no rows are read.
    """
    families = {
        "timestamp": ("timestamp", "timestamp_ntz", "date"),
        "number": ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"),
        "boolean": ("boolean",),
        "string": ("string",),
    }
    actual = dict(df.dtypes)
    return [
        (c, kind, actual.get(c, "missing"))
        for c, kind in declared.items()
        if actual.get(c, "missing").split("(")[0] not in families[kind]
    ]


def row_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and whether the declared grain holds."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("row_count"),
        F.count("*").alias("key_count"),
    )
    return total.withColumn("grain_holds", F.col("row_count") == F.col("key_count"))


def split_rejects(df: DataFrame, bad: str | Column = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Good rows, and rows that could not be read.

    ``bad`` is the column a permissive reader fills for an unreadable record, or
    a condition.
    """
    if isinstance(bad, str):
        return df.where(F.col(bad).isNull()).drop(bad), df.where(F.col(bad).isNotNull())
    failed = F.coalesce(bad, F.lit(False))
    return df.where(~failed), df.where(failed)


def page_completeness(pages: DataFrame, items: DataFrame, id_field: str, limit: int) -> DataFrame:
    """Is the extract of each endpoint complete?

    ``pages`` has one row per landed page (endpoint, page, reported, total_pages,
    item_count), ``items`` one row per item (endpoint, ``id_field``). An extract
    is complete when it holds as many distinct items as the server reports, and
    the end was reached: there are as many different pages as the server announced,
    or, if it announced none, the page with the highest number is shorter than ``limit``.
    Where the server reports no count, completeness is unknown (NULL), unless the
    end was not reached.
    """
    by_page = pages.groupBy("endpoint").agg(
        F.max("reported").alias("reported"),
        F.sum("item_count").cast("long").alias("fetched"),
        F.count_distinct("page").alias("pages"),
        F.max("total_pages").alias("total_pages"),
        F.max_by("item_count", "page").alias("last_page_items"),
    )
    ids = items.groupBy("endpoint").agg(F.count_distinct(id_field).alias("distinct_ids"))
    joined = by_page.join(ids, on="endpoint", how="left").fillna({"distinct_ids": 0})
    reached_end = F.coalesce(F.col("pages") >= F.col("total_pages"), F.col("last_page_items") < limit)
    complete = reached_end & (F.col("distinct_ids") >= F.col("reported"))
    return joined.withColumn("complete", complete)
