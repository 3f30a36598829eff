"""JSON arrays and objects to rows. Parents without members give no row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.jsonv import json_array, json_object


def unnest_array(
    df: DataFrame,
    v: Column,
    fields: Mapping[str, Column],
    position: str = "position",
    base: int = 0,
    path: str = "$",
) -> DataFrame:
    """One row per array element with its position, counted from ``base``.

    ``fields`` are expressions over the element, a VARIANT column ``value``.
    """
    kept = [c for c in df.columns]
    rows = df.select(*kept, F.posexplode(json_array(v, path)).alias("__pos", "value"))
    out = [F.col(c) for c in kept if c not in fields and c != position]
    out += [(F.col("__pos") + F.lit(base)).cast("long").alias(position)]
    return rows.select(*out, *[c.alias(n) for n, c in fields.items()])


def unnest_object(
    df: DataFrame,
    v: Column,
    fields: Mapping[str, Column],
    key: str = "key",
    key_type: str = "string",
    path: str = "$",
) -> DataFrame:
    """One row per object member; anything that is no object gives no row.

    ``fields`` are expressions over the member, a VARIANT column ``value``.
    """
    kept = [c for c in df.columns]
    rows = df.select(*kept, F.explode(json_object(v, path)).alias("__key", "value"))
    out = [F.col(c) for c in kept if c not in fields and c != key]
    out += [F.col("__key").cast(key_type).alias(key)]
    return rows.select(*out, *[c.alias(n) for n, c in fields.items()])
