"""Metrics from a summary that merges: any roll-up, also over several loads, from one small table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.temporal import minutes_2dp
from leadloom.operators.keys import stable_surrogate_key
from leadloom.plans.metrics import METRICS, Metric

#: Type of sums; minutes have two decimals, other summed columns none.
_TOTAL = "decimal(38,2)"


def _added(metric: Metric) -> Column:
    """What a row adds to a metric that is no distinct count."""
    return minutes_2dp(F.col(metric.column)) if metric.kind == "minutes" else F.col(metric.column)


def metric_summary(df: DataFrame, metrics: Sequence[str], dims: Sequence[str], dictionary: str) -> DataFrame:
    """State of metrics per value of the dimensions: dims, metric, bucket, bitmap, total, n.

    A distinct count is kept exactly, as bitmaps: each value has a code, and bit ``code`` is set
    where the value occurs, in pieces (``bucket``) of 32,768 bits. Codes come from the folder
    ``dictionary`` and stay the same from load to load, so summaries of several loads that share
    it can be stacked. Other metrics keep a sum and a count. A bitmap has 4 KB per dimension value
    and piece at most, however often its values occur; NULL counts nowhere.
    """
    dim_names = [f"`{d}`" for d in dims]
    distinct = [m for m in metrics if METRICS[m].kind == "distinct"]
    added = [m for m in metrics if METRICS[m].kind != "distinct"]
    parts = []
    if distinct:
        values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(METRICS[m].column).cast("string").alias("value")) for m in distinct])
        pairs = df.select(*dim_names, F.explode(values).alias("v")).select(*dim_names, "v.*").where("value is not null").distinct()
        codes = stable_surrogate_key(pairs.select("metric", "value").distinct(), ["metric", "value"], dictionary, "code")
        coded = pairs.join(codes, ["metric", "value"])
        bits = coded.groupBy(*dim_names, "metric", F.bitmap_bucket_number("code").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bitmap")
        )
        parts.append(bits.select("*", F.lit(None).cast(_TOTAL).alias("total"), F.lit(None).cast("long").alias("n")))
    if added:
        sums = [F.struct(F.lit(m).alias("metric"), F.sum(_added(METRICS[m])).cast(_TOTAL).alias("total"),
                         F.count(_added(METRICS[m])).alias("n")) for m in added]
        rows = df.groupBy(*dim_names).agg(F.array(*sums).alias("s")).select(*dim_names, F.explode("s").alias("s"))
        nothing = F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("bitmap")
        parts.append(rows.select(*dim_names, "s.metric", *nothing, "s.total", "s.n"))
    if not parts:
        raise ValueError("no metrics")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def metrics_from_summary(
    summary: DataFrame, metrics: Sequence[str], dims: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """Metrics by any of the summary's dimensions, after a filter on them: the rows that
    ``metric_query`` gives on the table itself, but for groups in which no metric has a value.

    Pieces of bitmaps are merged per piece, so no task holds a whole one.
    """
    rows = summary if where is None else summary.where(where)
    rows = rows.where(F.col("metric").isin(*metrics))
    names = [f"`{d}`" for d in dims]
    merged = rows.groupBy(*names, "metric", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("bits"), F.sum("total").alias("total"), F.sum("n").alias("n")
    )
    out = []
    for m in metrics:
        here = lambda c, m=m: F.sum(F.when(F.col("metric") == m, F.col(c)))
        state = {
            "distinct": F.coalesce(here("bits"), F.lit(0)),
            "mean": here("total").cast("double") / F.nullif(here("n"), F.lit(0)),
            "minutes": here("total"),
            "sum": here("total").cast("long"),
        }
        out.append(state[METRICS[m].kind].alias(m))
    return merged.groupBy(*names).agg(*out)
