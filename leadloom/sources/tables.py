"""Table readers (files, catalog, JDBC) and the full-refresh writer."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from leadloom.commits import commit, version_path
from leadloom.operators.setops import union_by_name

# rows fetched per round trip; JDBC drivers default to far fewer or to all rows
JDBC_FETCH_SIZE = "10000"


def jdbc_options(
    connection: Mapping[str, str], query: str | None, partition: Mapping[str, object] | None
) -> dict[str, str]:
    """Reader options for a projection query on a source database.

    ``partition`` names ``column``, ``lower``, ``upper`` and ``num``: the query
    is then read by ``num`` tasks, each with its own range of the column. Spark
    accepts a partitioned read of a table expression only, hence the alias.
    """
    options = {"fetchsize": JDBC_FETCH_SIZE, **connection}
    if partition is None:
        if query is not None:
            options["query"] = query
        return options
    if query is not None:
        options["dbtable"] = f"({query}) AS src"
    options["partitionColumn"] = str(partition["column"])
    options["lowerBound"] = str(partition["lower"])
    options["upperBound"] = str(partition["upper"])
    options["numPartitions"] = str(partition["num"])
    return options


def read_source(
    spark: SparkSession,
    source: str | Mapping[str, str],
    columns: Sequence[str] | None = None,
    query: str | None = None,
    partition: Mapping[str, object] | None = None,
    params: Mapping[str, object] | None = None,
    version: int | None = None,
) -> DataFrame:
    """Whole table, named columns, or the result of a projection query.

    ``source`` is a Parquet path, a catalog table name, or JDBC options. Column
    selection reaches the scan in each case. ``version`` names an earlier version
    of a refreshed table. A query names its table ``src``,
    unless it runs on a JDBC source, and may have named ``params`` (``:name``);
    Spark cannot bind parameters of a JDBC query.
    """
    if isinstance(source, Mapping):
        if params:
            raise ValueError("a JDBC query takes no parameters")
        df = spark.read.format("jdbc").options(**jdbc_options(source, query, partition)).load()
    elif query is not None:
        # a view of its own, so that no view of the caller is replaced
        name = f"src_{uuid.uuid4().hex}"
        read_source(spark, source, version=version).createOrReplaceTempView(name)
        try:
            named = re.sub(r"^\s*with\b", ",", query, count=1, flags=re.IGNORECASE)
            df = spark.sql(f"WITH src AS (SELECT * FROM {name}) {named}", args=dict(params or {}))
        finally:
            spark.catalog.dropTempView(name)
    elif "/" in source:
        df = spark.read.parquet(current_path(spark, source, version))
    else:
        df = spark.read.table(source)
    return df if columns is None else df.select(*columns)


def read_tables(
    spark: SparkSession, sources: Mapping[str, str], add_table_name_column: bool = True
) -> DataFrame:
    """Several tables stacked by column name, tagged with the table's name."""
    named = {name: read_source(spark, path) for name, path in sources.items()}
    return union_by_name(named, tag_column="table_name" if add_table_name_column else None)


def current_path(spark: SparkSession, path: str, version: int | None = None) -> str:
    """Folder of the rows of a table: its last or a given version, or the path itself if the table
    was never refreshed."""
    return version_path(spark, path, version) or path


def full_refresh(
    df: DataFrame,
    path: str,
    skip_if_empty: bool = True,
    expected: int | None = None,
    retain_seconds: float = 86_400,
) -> int:
    """Replace the table at ``path`` and return its row count.

    The rows become the next version of the table (``leadloom.commits``): nothing is
    moved, readers (``read_source``) see the old rows or the new ones, never a mixture or a gap,
    and a failed job or an empty extract (0 is returned) leaves the old version as it was. The
    result is counted from the written files, the query runs once. Schema and rows are replaced
    together. Of two refreshes at the same time each becomes a version, one after the other; a
    refresh that must follow a version that its caller has read names it as ``expected`` and
    raises ``ConcurrentRefresh`` if another came in between. A replaced version stays for
    ``retain_seconds``, for readers that have begun with it.
    """
    made = commit(df, path, lambda rows, _: rows > 0 or not skip_if_empty, expected, retain_seconds)
    return made.rows if made is not None else 0


def materialize(df: DataFrame, name: str, kind: str = "view", base: str | None = None) -> DataFrame:
    """Persist one model: a temporary view, or a Parquet table below ``base``.

    A table is read back, so later models start from its files and not from the
    query that made it.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table" or base is None:
        raise ValueError("kind must be 'view', or 'table' with a base folder")
    path = f"{base.rstrip('/')}/{name}"
    made = commit(df, path)
    # the version just made, also if another writer has refreshed the table since
    table = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{made.folder}")
    table.createOrReplaceTempView(name)
    return table
