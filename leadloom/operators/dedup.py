"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

_RANK = "__rank"


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str | Column],
    order_by: Sequence[Column],
    tiebreak: Sequence[Column] = (),
) -> DataFrame:
    """Keep the first row per key in the given order.

    The filter sits directly on the rank, so Catalyst plans a partial
    ``WindowGroupLimit`` before the shuffle: every map task sends at most one
    row per key, which keeps a key that holds a third of the table harmless.
    Without a total ``tiebreak`` the choice among equal rows is arbitrary.
    """
    window = W.Window.partitionBy(*keys).orderBy(*order_by, *tiebreak)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)
