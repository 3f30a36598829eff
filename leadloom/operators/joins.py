"""Joins that stay balanced when one key holds a large share of the rows.

No side is broadcast by hint: Spark broadcasts a side only when its own estimate,
or the size that adaptive execution has measured, is below
``spark.sql.autoBroadcastJoinThreshold``. Above that the join is a sort-merge join,
and adaptive execution splits an oversized partition. It
can split both sides of an inner join, the left side of a left or anti join and
no side of a full join, and only if each side comes straight from the join's own
shuffle; the operators below are written to meet these conditions, or measure the
keys that adaptive execution could not split and salt them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Left join to a lookup with at most one row per key."""
    return fact.join(dim, on=on, how="left")


# rows of a key in one task of a join beyond which its other rows go to further tasks
HEAVY_ROWS = 200_000

# keys that the sketch of frequent keys reports and tracks; its memory is bounded by the second
REPORTED, TRACKED = 1_000, 100_000


def heavy_keys(df: DataFrame, on: Sequence[str], heavy_rows: int = HEAVY_ROWS) -> dict[str, int]:
    """Keys with more than about ``heavy_rows`` rows, as JSON text, with their estimated count.

    One aggregate over the key columns, with a frequent-items sketch: a key that holds more than a
    small share of all rows (1 in ``TRACKED``) is found, whatever the number of keys. Keys with a
    NULL part match nothing and do not count.
    """
    keyed = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on]))
    sketch = keyed.select(_key_text(on).alias("key")).agg(F.expr(f"approx_top_k(key, {REPORTED}, {TRACKED})").alias("top"))
    top = sketch.first().top or []
    return {r["item"]: r["count"] for r in top if r["count"] > heavy_rows}


def _key_text(on: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(on)]))


def left_join_fanout(
    fact: DataFrame, other: DataFrame, on: Sequence[str], heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Left join in which ``other`` may repeat a key any number of times.

    One join gives matched and unmatched rows, and reads each side once. Adaptive execution splits
    a key that is hot in ``fact``, also NULL, but could not split one that is hot in ``other``. So
    the heavy keys of ``other`` are measured first, from its key columns. If there are any, their
    rows in ``other`` are dealt to salts, as many as their count asks for, by a hash of the row;
    their ``fact`` rows go to every salt, where a copy that meets nothing is dropped, because a
    heavy key is known to match in another salt. All other keys have salt 0.
    """
    keys = list(on)
    heavy = heavy_keys(other, keys, heavy_rows)
    if not heavy:
        return fact.join(other, on=keys, how="left")
    names = F.create_map(*[F.lit(x) for key, n in heavy.items() for x in (key, -(-n // heavy_rows))])
    # NULL where the key is not heavy; a key with a NULL part never is
    salts = F.try_element_at(names, _key_text(keys))
    hashed = [F.col(c) for c, t in other.dtypes if not t.startswith(("variant", "map"))]
    dealt = other.select(
        "*", F.coalesce(F.pmod(F.xxhash64(*hashed), salts), F.lit(0)).cast("int").alias("__salt"), F.lit(True).alias("__met")
    )
    copies = fact.select(
        "*", salts.isNotNull().alias("__heavy"), F.explode(F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1)).alias("__salt")
    )
    joined = copies.join(dealt, on=[*keys, "__salt"], how="left")
    return joined.where(~F.col("__heavy") | F.col("__met").isNotNull()).drop("__salt", "__heavy", "__met")


@dataclass(frozen=True)
class Repeated:
    """A table that may hold a key any number of times, but never NULL.

    ``keys`` is a cheaper table with the same keys, if there is one (the rows
    before a deduplication, say). ``unkeyed`` are rows of the table without a
    key; they join to nothing and are appended to the result.
    """

    rows: DataFrame
    keys: DataFrame | None = None
    unkeyed: DataFrame | None = None

    @classmethod
    def split(cls, df: DataFrame, key: str) -> Repeated:
        """From a table that may hold NULL keys."""
        has_key = F.col(key).isNotNull()
        return cls(rows=df.where(has_key), unkeyed=df.where(~has_key))


def full_outer_on(
    key: str, repeated: Sequence[Repeated], per_key: Sequence[DataFrame], heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Full outer join of several tables on one key, NULL keys unmatched.

    The result of a chain of full joins on the coalesced key is, per key, the cross product of
    the tables that have the key. It is made in one pass: the rows of all tables are tagged and
    stacked, one shuffle brings a key together as a list of rows per table, and the lists are
    expanded; an empty one gives NULLs. ``per_key`` tables hold a key at most once and never NULL.

    Keys with more than ``heavy_rows`` rows in a repeated table are measured first, from its key
    column. Such a table's rows are dealt to chunks, by a hash of the row, and a key's cells are
    the combinations of its chunks: a row goes to every cell of its chunk, a row of another table
    to all cells. A cell in which a chunk is empty gives nothing, because the table is known to
    hold the key elsewhere. So no task gets more than about ``heavy_rows`` rows of a key and table.

    Apart from the key, the column names of the tables must not overlap. All columns travel, so
    tables should be selected to what is needed.
    """
    counts = [heavy_keys(t.rows if t.keys is None else t.keys, [key], heavy_rows) for t in repeated]
    chunks = {
        k: [-(-c[k] // heavy_rows) if k in c else 1 for c in counts] for k in set().union(*counts)
    }
    tables = [(t, None) for t in per_key] + [(t.rows, i) for i, t in enumerate(repeated)]
    tagged = [_in_cells(t, key, chunks, i).select(key, "__cell", _packed(t, key).alias(f"__p{n}")) for n, (t, i) in enumerate(tables)]
    lists = [
        (F.first(f"__p{n}", ignorenulls=True) if i is None else F.collect_list(f"__p{n}")).alias(f"__p{n}")
        for n, (_, i) in enumerate(tables)
    ]
    out = _stack(tagged).groupBy(key, "__cell").agg(*lists)
    if chunks:
        dealt = _chunks_of(key, chunks)
        for n, (_, i) in enumerate(tables):
            if i is not None:
                out = out.where((F.size(f"__p{n}") > 0) | (F.coalesce(F.get(dealt, F.lit(i)), F.lit(1)) == 1))
    for n, (_, i) in enumerate(tables):
        if i is not None:
            out = out.withColumn(f"__p{n}", F.explode_outer(f"__p{n}"))
    names = [(n, c) for n, (t, _) in enumerate(tables) for c in t.columns if c != key]
    out = out.select(key, *[F.col(f"__p{n}.`{c}`").alias(c) for n, c in names])
    return _stack([out, *[t.unkeyed for t in repeated if t.unkeyed is not None]])


def _packed(table: DataFrame, key: str) -> Column:
    names = [f"`{c}`" for c in table.columns if c != key]
    return F.struct(*names) if names else F.struct(F.lit(True).alias("here"))


def _chunks_of(key: str, chunks: Mapping[str, Sequence[int]]) -> Column:
    """Chunks of a row's key per repeated table; NULL if the key is not heavy."""
    items = [x for k, c in chunks.items() for x in (F.lit(k), F.array(*map(F.lit, c)))]
    return F.try_element_at(F.create_map(*items), _key_text([key]))


def _in_cells(table: DataFrame, key: str, chunks: Mapping[str, Sequence[int]], i: int | None) -> DataFrame:
    """A copy of each row for every cell it belongs to. Cells are numbered by their chunks, the
    first table's chunk counting fastest; ``i`` is the table's place among the repeated ones."""
    if not chunks:
        return table.withColumn("__cell", F.lit(0).cast("long"))
    dealt = _chunks_of(key, chunks)
    product = lambda a: F.aggregate(a, F.lit(1).cast("long"), lambda x, n: x * n)
    if i is None:
        cells = F.sequence(F.lit(0).cast("long"), product(dealt) - 1)
    else:
        hashed = [F.col(f"`{c}`") for c, t in table.dtypes if not t.startswith(("variant", "map"))]
        below, mine = product(F.slice(dealt, 1, i)), F.get(dealt, F.lit(i))
        chunk = F.pmod(F.xxhash64(*hashed), mine)
        others = F.call_function("div", product(dealt), mine)
        cells = F.transform(
            F.sequence(F.lit(0).cast("long"), others - 1),
            lambda q: F.call_function("div", q, below) * below * mine + chunk * below + q % below,
        )
    return table.withColumn("__cell", F.explode(F.coalesce(cells, F.array(F.lit(0).cast("long")))))


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def drill_across(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_aggs: Mapping[str, Column],
    right_aggs: Mapping[str, Column],
) -> DataFrame:
    """Join two fact tables after summarising each to the shared key.

    Keys of either table stay; rows without a key are summarised as one. The key is
    grouped and joined inside a struct, which is never NULL itself and equals another
    one that holds NULL. So each table is read once, both summaries hold a key once and
    are partitioned by it, and the join adds no shuffle and cannot multiply rows.
    """
    packed = F.struct(F.col(key).alias("key")).alias("__key")
    a = left.groupBy(packed).agg(*[c.alias(n) for n, c in left_aggs.items()])
    b = right.groupBy(packed).agg(*[c.alias(n) for n, c in right_aggs.items()])
    joined = a.join(b, on="__key", how="full")
    return joined.select(F.col("__key.key").alias(key), *left_aggs, *right_aggs)
