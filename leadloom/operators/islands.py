"""Runs and gaps of whole numbers, such as the pages of an extract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Numbers that one task looks at together.
BUCKET = 100_000


def with_previous(df: DataFrame, by: Sequence[str], value: str, bucket: int = BUCKET) -> DataFrame:
    """The distinct numbers of each group, with the next smaller one (NULL for the first).

    A group is cut into buckets of numbers, so one with a large share of all numbers is spread;
    the first of a bucket follows the largest of the buckets before it, which a window over one
    row per bucket finds.
    """
    names = [f"`{b}`" for b in by]
    at = F.call_function("div", F.col(value) - F.pmod(F.col(value), F.lit(bucket)), F.lit(bucket)).alias("__bucket")
    numbers = df.where(F.col(value).isNotNull()).select(*names, F.col(value).cast("long").alias(value), at).distinct()
    last = numbers.groupBy(*names, "__bucket").agg(F.max(value).alias("__last"))
    before = Window.partitionBy(*names).orderBy("__bucket")
    borders = last.select(*[F.col(n).alias(f"__{i}") for i, n in enumerate(names)], F.col("__bucket").alias("__at"), F.lag("__last").over(before).alias("__before"))
    same = F.col("__bucket") == F.col("__at")
    for i, n in enumerate(names):
        same &= F.col(n).eqNullSafe(F.col(f"__{i}"))
    inside = Window.partitionBy(*names, "__bucket").orderBy(value)
    near = numbers.select("*", F.lag(value).over(inside).alias("__near"))
    return near.join(borders, same).select(*names, value, F.coalesce("__near", "__before").alias("previous"))


def runs(df: DataFrame, by: Sequence[str], value: str, bucket: int = BUCKET) -> DataFrame:
    """Runs of consecutive numbers of each group: by, first, last, n. A NULL group has none."""
    names = [f"`{b}`" for b in by]
    starts = with_previous(df, by, value, bucket).where(F.col("previous").isNull() | (F.col(value) > F.col("previous") + 1))
    # a run ends where the next one's gap begins; one row per run, so a window is small
    following = Window.partitionBy(*names).orderBy(value)
    most = df.groupBy(*names).agg(F.max(F.col(value)).cast("long").alias("__most"))
    ends = starts.select(*names, F.col(value).alias("first"), F.lead("previous").over(following).alias("__end"))
    return ends.join(most, list(by)).select(*names, "first", F.coalesce("__end", "__most").alias("last")).withColumn("n", F.col("last") - F.col("first") + 1)


def gaps(df: DataFrame, by: Sequence[str], value: str, bucket: int = BUCKET) -> DataFrame:
    """Numbers that are missing between those of a group: by, first, last, n."""
    missing = with_previous(df, by, value, bucket).where(F.col(value) > F.col("previous") + 1)
    first, last = F.col("previous") + 1, F.col(value) - 1
    return missing.select(*[f"`{b}`" for b in by], first.alias("first"), last.alias("last"), (last - first + 1).alias("n"))


def extract_faults(
    pages: DataFrame, items: DataFrame | None = None, id_field: str = "id", first_page: int = 1, bucket: int = BUCKET
) -> DataFrame:
    """What is wrong with the pages of each endpoint: endpoint, kind, first, last, n.

    ``pages`` has one row per landed page (endpoint, page, total_pages). ``missing``: pages first
    to last were not landed, before, between or after those that were, the end being known if the
    server announced it. ``repeated``: the page was landed n times more than once. With ``items``
    (endpoint, page, ``id_field``), ``overlap``: n items of the page are on an earlier page too,
    as happens when rows come in while pages are fetched.
    """
    ends = pages.groupBy("endpoint").agg(
        F.min("page").cast("long").alias("low"), F.max("page").cast("long").alias("high"), F.max("total_pages").cast("long").alias("total")
    )
    start, end = F.lit(first_page).cast("long"), F.col("total") + first_page - 1
    before = ends.where(F.col("low") > start).select("endpoint", start.alias("first"), (F.col("low") - 1).alias("last"))
    after = ends.where(F.col("high") < end).select("endpoint", (F.col("high") + 1).alias("first"), end.alias("last"))
    missing = gaps(pages, ["endpoint"], "page", bucket).drop("n").unionByName(before).unionByName(after)
    page = F.col("page").cast("long")
    landed = pages.groupBy("endpoint", page.alias("first")).agg((F.count("*") - 1).alias("n")).where("n > 0 and first is not null")
    parts = [
        missing.select("endpoint", F.lit("missing").alias("kind"), "first", "last", (F.col("last") - F.col("first") + 1).alias("n")),
        landed.select("endpoint", F.lit("repeated").alias("kind"), "first", F.col("first").alias("last"), "n"),
    ]
    if items is not None:
        seen = items.where(F.col(id_field).isNotNull()).select("endpoint", page.alias("page"), F.col(id_field).alias("id")).distinct()
        earliest = seen.groupBy("endpoint", "id").agg(F.min("page").alias("earliest"))
        again = seen.join(earliest, ["endpoint", "id"]).where(F.col("page") > F.col("earliest"))
        overlap = again.groupBy("endpoint", F.col("page").alias("first")).agg(F.count("*").alias("n"))
        parts.append(overlap.select("endpoint", F.lit("overlap").alias("kind"), "first", F.col("first").alias("last"), "n"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
