"""Landed API pages: one JSON document per page, items nested in an envelope.

Two envelopes occur, ``{count, items: [...]}`` and
``{code, message, data: [...], meta: {total_pages, total_count, page, limit}}``.
A page is bounded by the page size of the API, so one page per row is small; the
items of all pages are spread over the cluster by the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

META = "struct<total_pages: bigint, total_count: bigint, page: bigint, limit: bigint>"


def page_schema(item_schema: str, items_field: str = "items") -> str:
    """DDL of an envelope whose items have the given DDL struct fields."""
    return (
        f"count bigint, code int, message string, meta {META}, "
        f"{items_field} array<struct<{item_schema}>>"
    )


def read_pages(
    spark: SparkSession,
    path: str,
    item_schema: str,
    items_field: str = "items",
    one_per_line: bool = False,
) -> DataFrame:
    """Envelopes of all page files below ``path``, with the file they came from.

    A file holds one page, or one page per line. A page that is no valid JSON is
    kept with its text in ``_corrupt_record``; ``split_rejects`` sets it apart.
    """
    schema = page_schema(item_schema, items_field) + ", _corrupt_record string"
    pages = spark.read.schema(schema).json(path, multiLine=not one_per_line)
    return pages.withColumn("page_file", F.col("_metadata.file_path"))


def parse_pages(df: DataFrame, text: str, item_schema: str, items_field: str = "items") -> DataFrame:
    """Envelopes from a text column, for pages landed in a table."""
    schema = page_schema(item_schema, items_field)
    parsed = df.withColumn("__page", F.from_json(F.col(text), schema))
    return parsed.select(*[c for c in df.columns if c != text], "__page.*")


def explode_pages(
    pages: DataFrame,
    items_field: str = "items",
    keep: tuple[str, ...] = (),
    position: str | None = None,
) -> DataFrame:
    """One row per item; an empty page gives none.

    ``position`` names a column for the item's place in its page, from 0.
    """
    if position is None:
        rows = pages.select(*keep, F.explode(F.col(items_field)).alias("__item"))
        return rows.select(*keep, "__item.*")
    rows = pages.select(*keep, F.posexplode(F.col(items_field)).alias(position, "__item"))
    return rows.select(*keep, position, "__item.*")


def read_api_pages(
    spark: SparkSession,
    path: str,
    item_schema: str,
    items_field: str = "items",
    one_per_line: bool = False,
) -> DataFrame:
    """Item table of one endpoint from its landed page files."""
    pages = read_pages(spark, path, item_schema, items_field, one_per_line)
    return explode_pages(pages, items_field, ("page_file",))


def page_stats(
    pages: DataFrame, endpoint: str | Column, items_field: str = "items", page: Column | None = None
) -> DataFrame:
    """Per page: endpoint, page number, what the server reports, and how many items it holds.

    The page number is the last number in the name of the landed file unless ``page`` gives it.
    """
    name = F.col(endpoint) if isinstance(endpoint, str) else endpoint
    if page is None:
        page = F.regexp_extract("page_file", r"(\d+)[^/\d]*$", 1).try_cast("long")
    return pages.select(
        name.alias("endpoint"),
        page.alias("page"),
        F.coalesce(F.col("count"), F.col("meta.total_count")).alias("reported"),
        F.col("meta.total_pages").alias("total_pages"),
        F.coalesce(F.array_size(F.col(items_field)), F.lit(0)).cast("long").alias("item_count"),
    )
