from __future__ import annotations


def rows(df):
    """Rows as a sorted list of tuples; NULL sorts first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def final_plan(df) -> str:
    """Physical plan after adaptive execution has run it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def first_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def one(spark, value, dtype="string"):
    """One-row table with a single column c."""
    return spark.createDataFrame([(value,)], f"c {dtype}")
