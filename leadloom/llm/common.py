"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.session import shared_path

#: The ASCII white space that separates words: space, tab, line feed, vertical tab, form feed, return.
ASCII_SPACE = " \t\n\x0b\f\r"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df, computed once into the shared folder and read from there. It cuts the lineage and
    outlives executors."""
    spark: SparkSession = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_bucket(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod).cast("int")


def need_columns(df: DataFrame, *names: str) -> None:
    for name in names:
        if df.columns.count(name) != 1:
            raise ValueError(f"exactly one column {name!r} is needed, there are {df.columns}")


def with_python(df: DataFrame, inputs: list[str], func, fields: str) -> DataFrame:
    """(row, fields): the rows of df, each as one struct, and columns that func computes from the
    columns named in Arrow batches. No column of df can clash with the new ones, whatever its name;
    the inputs travel in the struct only.

    func maps a list of Arrow arrays, one per input, to a list of arrays, one per field.
    """
    src = df.select(F.struct("*").alias("row"))
    extra = T._parse_datatype_string(fields)
    schema = T.StructType([src.schema.fields[0], *extra.fields])

    at = [df.columns.index(c) for c in inputs]

    def run(batches):
        for b in batches:
            row = b.column(0)
            new = func([row.field(i) for i in at])
            yield pa.RecordBatch.from_arrays([row, *new], names=["row", *extra.names])

    return src.mapInArrow(run, schema)
