"""Surrogate keys: numbered once, or the same at every refresh."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadloom.commits import commit_entry, committed
from leadloom.session import delete_folder, shared_path


def add_surrogate_key(
    df: DataFrame, order_by: Sequence[Column] | None = None, name: str = "id", start: int = 1
) -> DataFrame:
    """Unique number per row; an incoming column of that name becomes
    ``source_<name>``.

    Without ``order_by`` the numbers are unique but neither dense nor stable
    between runs. With ``order_by`` (a total order) they run ``start``,
    ``start + 1``, ... in that order. Rows are then range-partitioned and sorted,
    and each partition adds the number of rows in the partitions before it, so no
    task sees all rows. The sorted rows are written to the shared folder: the
    offsets and the rows must come from one and the same partitioning, also after
    an executor was lost, and the offsets need one column of the table only.
    """
    if name in df.columns:
        df = df.withColumnRenamed(name, f"source_{name}")
    if order_by is None:
        return df.select(F.monotonically_increasing_id().alias(name), "*")

    # monotonically_increasing_id = partition number << 33 | row number in it
    at, partition = F.col("__at"), F.shiftright(F.col("__at"), 33)
    ranges = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    path = shared_path(df.sparkSession, "numbered")
    ranges.withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    placed = df.sparkSession.read.parquet(path).withColumn("__partition", partition)
    # one row per partition, so this window is as small as the partition count
    sizes = placed.groupBy("__partition").agg(F.count("*").alias("__rows"))
    before = Window.orderBy("__partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__partition", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    # bounded by the number of partitions
    numbered = placed.join(F.broadcast(offsets), on="__partition")
    within = at.bitwiseAND(F.lit((1 << 33) - 1))
    number = (F.col("__offset") + within + F.lit(start)).cast("long").alias(name)
    return numbered.select(number, *df.columns)


# rows of a key beyond which its occurrences are counted by more than one task
HEAVY_ROWS = 100_000

_RANGE = "digest binary, first long, n long"


@dataclass(frozen=True)
class _Dictionary:
    """Numbers given so far: segments of ranges (digest of a key, first number, how many), one per
    refresh that met new rows, in the order of a commit log."""

    spark: SparkSession
    path: str
    folders: list[str]
    following: int | None

    @classmethod
    def at(cls, spark: SparkSession, path: str) -> _Dictionary:
        entries = committed(spark, path)
        return cls(spark, path.rstrip("/"), [e["folder"] for e in entries], entries[-1]["following"] if entries else None)

    def ranges(self) -> DataFrame:
        if not self.folders:
            return self.spark.createDataFrame([], _RANGE)
        return self.spark.read.schema(_RANGE).parquet(*[f"{self.path}/{f}" for f in self.folders])

    def extended(self, missing: DataFrame, order: Sequence[str], start: int) -> _Dictionary | None:
        """With numbers for `missing` (digest, n, key columns), in the order of the keys. None if
        another writer was faster."""
        spark, staged = self.spark, shared_path(self.spark, "new-keys")
        by = [F.col(c).asc_nulls_first() for c in order]
        placed = missing.repartitionByRange(*by).sortWithinPartitions(*by)
        placed.select("digest", "n", F.monotonically_increasing_id().alias("at")).write.parquet(staged)
        new = spark.read.schema("digest binary, n long, at long").parquet(staged)
        new = new.withColumn("part", F.shiftright("at", 33))
        total = new.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if not total:
            delete_folder(spark, staged)
            return self
        # each partition gets a range of numbers, and each key of it a range of that
        sizes = new.groupBy("part").agg(F.sum("n").alias("size"))
        base = start if self.following is None else self.following
        parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select("part", (F.coalesce(F.sum("size").over(parts), F.lit(0)) + base).alias("offset"))
        within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        numbered = new.select("digest", "n", "part", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("before"))
        first = (F.col("offset") + F.col("before")).alias("first")
        folder = f"segment-{uuid.uuid4().hex}"
        numbered.join(F.broadcast(offsets), "part").select("digest", first, "n").write.parquet(f"{self.path}/{folder}")
        delete_folder(spark, staged)
        content = json.dumps({"folder": folder, "following": base + total})
        if commit_entry(spark, self.path, len(self.folders), content):
            return _Dictionary(spark, self.path, [*self.folders, folder], base + total)
        delete_folder(spark, f"{self.path}/{folder}")
        return None


def _in_ranges(ranges: Column, nth: Column) -> Column:
    """The nth number of a list of ranges."""
    start = F.struct(nth.cast("long").alias("left"), F.lit(None).cast("long").alias("number"))

    def step(s: Column, r: Column) -> Column:
        here = s["number"].isNull() & (s["left"] <= r["n"])
        return F.struct((s["left"] - r["n"]).alias("left"), F.when(here, r["first"] + s["left"] - 1).otherwise(s["number"]).alias("number"))

    return F.aggregate(ranges, start, step, lambda s: s["number"])


def _occurrences(rows: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """Adds `nth`, the number of a row among those with its digest."""
    order = F.xxhash64(*[F.col(f"`{c}`") for c, t in rows.dtypes if not t.startswith(("variant", "map"))])
    nth = F.row_number().over(Window.partitionBy("__digest").orderBy(order)).alias("__nth")
    if heavy is None:
        return rows.select("*", nth)
    # a key's rows are counted per partition; they are written so that the partitions stay
    light = rows.join(heavy, "__digest", "left_anti").select(*rows.columns, nth)
    path = shared_path(rows.sparkSession, "heavy-rows")
    many = rows.join(heavy, "__digest", "left_semi").select(*rows.columns)
    many.withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    placed = rows.sparkSession.read.parquet(path).withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy("__digest", "__part").agg(F.count("*").alias("__size"))
    before = Window.partitionBy("__digest").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__digest", "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    within = F.row_number().over(Window.partitionBy("__digest", "__part").orderBy("__at"))
    counted = placed.withColumn("__in", within).join(offsets, ["__digest", "__part"])
    return light.unionByName(counted.select(*rows.columns, (F.col("__in") + F.col("__offset")).alias("__nth")))


def stable_surrogate_key(
    df: DataFrame,
    keys: Sequence[str],
    dictionary: str,
    name: str = "id",
    start: int = 1,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Unique number per row that a row keeps at every refresh; an incoming column of that name
    becomes ``source_<name>``.

    ``keys`` are the columns that make a row the same at the next refresh. The folder
    ``dictionary`` remembers the numbers of each key. Rows that are new get the next numbers, in
    the order of their keys; numbers of rows that are gone are kept for them. Rows that repeat a
    key have a number each: of n of them the first n numbers of the key are in use.

    Only the dictionary is written: a digest of the key (SHA-256) and a range of numbers per key
    and refresh that met more rows of it. New numbers are handed out as ranges, to partitions and
    in them to keys. A refresh that loses a race for the dictionary starts again from the
    winner's. ``df`` is read more than once and must give the same rows; a row that the first
    pass has not seen raises. Rows of a key with more than ``heavy_rows`` are the exception: they
    are written once, so that several tasks can count them.
    """
    if name in df.columns:
        keys = [f"source_{name}" if k == name else k for k in keys]
        df = df.withColumnRenamed(name, f"source_{name}")
    spark = df.sparkSession
    packed = F.to_json(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"})
    rows = df.withColumn("__digest", F.unhex(F.sha2(packed, 256)))
    order = [f"k{i}" for i in range(len(keys))]
    named = [F.col(f"`{k}`").alias(o) for k, o in zip(keys, order, strict=True)]
    now = rows.select(F.col("__digest").alias("digest"), *named).groupBy("digest", *order).agg(F.count("*").alias("rows"))

    known = None
    while known is None:
        before = _Dictionary.at(spark, dictionary)
        have = before.ranges().groupBy("digest").agg(F.sum("n").alias("have"))
        more = F.col("rows") - F.coalesce("have", F.lit(0))
        missing = now.join(have, "digest", "left").withColumn("n", more).where("n > 0")
        known = before.extended(missing.select("digest", "n", *order), order, start)

    counts = rows.groupBy("__digest").agg(F.count("*").alias("__rows"))
    heavy = counts.where(F.col("__rows") > heavy_rows).select("__digest")
    numbers = known.ranges().groupBy(F.col("digest").alias("__digest")).agg(
        F.sort_array(F.collect_list(F.struct("first", "n"))).alias("__ranges")
    )
    joined = _occurrences(rows, None if heavy.isEmpty() else heavy).join(numbers, "__digest", "left")
    unseen = F.raise_error(F.lit("a row was not there when numbers were given")).cast("long")
    number = F.coalesce(_in_ranges(F.col("__ranges"), F.col("__nth")), unseen).alias(name)
    return joined.select(number, *[F.col(f"`{c}`") for c in df.columns])
