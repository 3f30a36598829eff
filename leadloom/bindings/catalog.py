"""Registry that keeps each query next to the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            if name in self.queries:
                raise KeyError(f"query {name!r} is registered twice")
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = " ".join(sql.split("\n"))
            return fn

        return register

    def include(self, other: Catalog) -> None:
        for name, fn in other.queries.items():
            self.query(name, other.sql.get(name))(fn)


def flat(df: DataFrame) -> DataFrame:
    """Columns in types both engines return alike: VARIANT as JSON text, decimal
    as double, date as text."""
    out = []
    for name, dtype in df.dtypes:
        c = F.col(name)
        if dtype == "variant":
            c = F.to_json(c)
        elif dtype.startswith("decimal"):
            c = c.cast("double")
        elif dtype == "date":
            c = c.cast("string")
        out.append(c.alias(name))
    return df.select(*out)
