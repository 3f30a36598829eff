"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation.

A term is a component's index, a weight its whole number floor(256 x), and the posting list of
a term the rows that have a weight other than 0 there. A block of rows is scored for a set of
queries at once: each term that a query has scatters its posting list, times the query's weight,
into the dense array of the block's scores. Partition selection then takes the k best of each
query, blocks are merged inside the task, and a ranked window merges the tasks.

Rows are packed once, some ten thousand to a piece, and the queries are cut from the same pieces,
so that a row has one address however often its id occurs. Rows and queries are dealt to lanes of
bounded size, and a task holds one lane of rows and one of queries. So rows travel once per lane
of queries, queries once per lane of rows, and neither side is ever whole in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import rows_of
from .common import need_columns, written
from .packed import pack, pack_sorted, unpack, unpack_sorted

#: Rows of a piece, and the most rows and queries that a lane is made for.
PIECE_ROWS = 16_384
LANE_ROWS = 262_144
LANE_QUERIES = 65_536

#: Rows and queries that are scored together; their scores fit a core's cache.
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 64

_PIECE = "piece long, n long, queries long, ids binary, nulls binary, sizes binary, terms binary, weights binary"
_NO_ID = np.iinfo(np.int64).max


def _zigzag(x: np.ndarray) -> np.ndarray:
    return (x << 1 ^ x >> 63).view(np.uint64)


def _unzigzag(u: np.ndarray) -> np.ndarray:
    return (u >> np.uint64(1)).view(np.int64) ^ -(u & np.uint64(1)).view(np.int64)


class Rows:
    """Sparse rows: ids (null ones as the largest number), addresses, and terms with weights."""

    def __init__(self, ids, null, at, sizes, terms, weights):
        self.ids, self.null, self.at = ids, null, at
        self.sizes, self.terms, self.weights = sizes, terms, weights
        self.ends = np.cumsum(sizes)

    def take(self, order: np.ndarray) -> Rows:
        size = self.sizes[order]
        first = np.cumsum(size) - size
        flat = np.arange(int(size.sum())) + np.repeat(self.ends[order] - size - first, size)
        return Rows(self.ids[order], self.null[order], self.at[order], size, self.terms[flat], self.weights[flat])

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        names = ("ids", "null", "at", "sizes", "terms", "weights")
        return Rows(*(np.concatenate([getattr(p, n) for p in parts]) for n in names))

    def packed(self) -> dict:
        """All but the addresses."""
        return {
            "ids": pack(self.ids.view(np.uint64)),
            "nulls": np.packbits(self.null).tobytes(),
            "sizes": pack(self.sizes.astype(np.uint64)),
            "terms": pack(self.terms.astype(np.uint64)),
            "weights": pack(_zigzag(self.weights)),
        }

    @staticmethod
    def unpacked(row: dict, at: np.ndarray) -> Rows:
        null = np.unpackbits(np.frombuffer(row["nulls"], np.uint8), count=len(at)).astype(bool)
        ids, sizes, terms = (unpack(row[n]).view(np.int64) for n in ("ids", "sizes", "terms"))
        return Rows(ids, null, at, sizes, terms, _unzigzag(unpack(row["weights"])))


def _sparse(ids: pa.Array, vectors: pa.Array) -> Rows:
    """Rows of vectors that are whole: not null, all components finite."""
    flat = vectors.flatten()
    x = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.array(vectors.value_lengths().fill_null(0), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    whole = np.array(vectors.is_valid(), bool)
    whole[row[~np.isfinite(x)]] = False
    place = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size)
    used = whole[row]
    w = np.floor(256 * x[used])
    if (np.abs(w) >= 2.0**63).any():
        raise OverflowError("a component of a vector times 256 is beyond 64 bits")
    w, row, place = w.astype(np.int64), row[used], place[used]
    there = w != 0
    w, row, place = w[there], row[there], place[there]
    null = np.array(ids.is_null(), bool)
    n = np.bincount(row, minlength=len(size))[whole]
    number = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    return Rows(number[whole], null[whole], np.zeros(int(whole.sum()), np.int64), n, place, w)


def _pieces(vectors: DataFrame, every: int) -> DataFrame:
    def run(parts):
        first = TaskContext.get().partitionId() << 20
        held: list[Rows] = []
        count = 0

        def piece():
            rows = Rows.joined(held)
            row = rows.packed() | {"piece": first + count, "n": len(rows.ids)}
            row["queries"] = int(np.count_nonzero(_asked(rows, every)))
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in parts:
            for i in range(0, b.num_rows, PIECE_ROWS // 4):
                cut = b.slice(i, PIECE_ROWS // 4)
                held.append(_sparse(cut.column(0), cut.column(1)))
                if sum(len(r.ids) for r in held) >= PIECE_ROWS:
                    yield piece()
                    held, count = [], count + 1
        if any(len(r.ids) for r in held):
            yield piece()

    kinds = {"long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (f.split() for f in _PIECE.split(", "))])
    return vectors.mapInArrow(run, _PIECE)


def _asked(rows: Rows, every: int) -> np.ndarray:
    return ~rows.null & (rows.ids % every == 0)


def _addresses(piece: int, n: int) -> np.ndarray:
    """Of the rows of a piece: 16 bits for the row, 20 for the piece in its task, then the task."""
    return (piece << 16) + np.arange(n)


_QUERIES = "piece long, at binary, ids binary, nulls binary, sizes binary, terms binary, weights binary"


def _query_pieces(pieces: DataFrame, every: int) -> DataFrame:
    def run(parts):
        for row in rows_of(parts):
            rows = Rows.unpacked(row, _addresses(row["piece"], row["n"]))
            asked = np.flatnonzero(_asked(rows, every))
            for i in range(0, len(asked), 4 * BLOCK_QUERIES):
                some = rows.take(asked[i : i + 4 * BLOCK_QUERIES])
                out = some.packed() | {"piece": row["piece"], "at": pack_sorted(some.at)}
                yield pa.RecordBatch.from_pylist([out], schema=schema)

    schema = pa.schema([(f.split()[0], pa.int64() if "long" in f else pa.binary()) for f in _QUERIES.split(", ")])
    return pieces.where("queries > 0").mapInArrow(run, _QUERIES)


class Postings:
    """Per term of a block of rows: the rows that have it, and their weights. A term that most
    rows have keeps a weight for every row instead, 0 where it is missing."""

    def __init__(self, rows: Rows):
        self.n = len(rows.ids)
        row = np.repeat(np.arange(self.n), rows.sizes)
        order = np.argsort(rows.terms, kind="stable")
        terms, first = np.unique(rows.terms[order], return_index=True)
        self.largest = int(np.abs(rows.weights).max(initial=0))
        self.longest = int(rows.sizes.max(initial=0))
        self.lists: dict[int, tuple[np.ndarray | None, np.ndarray]] = {}
        for t, at in zip(terms.tolist(), np.split(order, first[1:]), strict=True):
            if 2 * len(at) > self.n:
                every = np.zeros(self.n, np.int64)
                every[row[at]] = rows.weights[at]
                self.lists[t] = (None, every)
            else:
                self.lists[t] = (row[at], rows.weights[at])

    def scores(self, queries: Rows) -> np.ndarray:
        """One row per query, one column per row of the block."""
        most = self.largest * int(np.abs(queries.weights).max(initial=0)) * max(1, self.longest)
        kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
        score = np.zeros((len(queries.ids), self.n), kind)
        query = np.repeat(np.arange(len(queries.ids)), queries.sizes)
        order = np.argsort(queries.terms, kind="stable")
        terms, first = np.unique(queries.terms[order], return_index=True)
        for t, at in zip(terms.tolist(), np.split(order, first[1:]), strict=True):
            if t not in self.lists:
                continue
            rows, weights = self.lists[t]
            product = np.multiply.outer(queries.weights[at].astype(kind), weights.astype(kind))
            if rows is not None:
                score[np.ix_(query[at], rows)] += product
            elif len(at) == len(score):
                score += product
            else:
                score[query[at]] += product
        return score


def best(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, highest first, ties to the earlier place."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        above = np.flatnonzero(score > least)
        at = np.concatenate([above, np.flatnonzero(score == least)[: k - len(above)]])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((at, ~score[at]))] if score.dtype != object else np.array(
        sorted(at.tolist(), key=lambda i: (-score[i], i)), np.int64
    )


_FOUND = "query_at long, query_id long, vec_id long, score long"


def _search(rows: Rows, queries: Rows, k: int) -> Iterator[pa.RecordBatch]:
    """The k best rows of the lane for each query, without the query's own row."""
    rows = rows.take(np.lexsort((rows.at, rows.ids, rows.null)))
    by_at = np.argsort(rows.at)
    own = by_at[np.minimum(np.searchsorted(rows.at, queries.at, sorter=by_at), len(by_at) - 1)]
    own = np.where(rows.at[own] == queries.at, own, -1)
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in queries.ids]
    slices = [
        (i, queries.take(np.arange(i, min(i + BLOCK_QUERIES, len(queries.ids)))))
        for i in range(0, len(queries.ids), BLOCK_QUERIES)
    ]
    for first in range(0, len(rows.ids), BLOCK_ROWS):
        block = Postings(rows.take(np.arange(first, min(first + BLOCK_ROWS, len(rows.ids)))))
        for i, some in slices:
            for q, score in enumerate(block.scores(some), i):
                mine = own[q] - first
                places = np.arange(len(score))
                if own[q] >= 0 and 0 <= mine < len(score):
                    places, score = np.delete(places, mine), np.delete(score, mine)
                at = best(score, k)
                found[q].append((places[at] + first, score[at]))
                if len(found[q]) == 16:
                    found[q] = [_merged(found[q], k)]
    out: dict[str, list] = {n.split()[0]: [] for n in _FOUND.split(", ")}
    for q, lists in enumerate(found):
        for place, score in zip(*(x.tolist() for x in _merged(lists, k)), strict=True):
            values = (int(queries.at[q]), int(queries.ids[q]), None if rows.null[place] else int(rows.ids[place]), score)
            for name, v in zip(out, values, strict=True):
                out[name].append(v)
    yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(n, pa.int64()) for n in out]))


def _merged(lists, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of earlier rows come first, so ties go to the smaller place."""
    place, score = (np.concatenate(x) for x in zip(*lists, strict=True))
    at = best(score, k)
    return place[at], score[at]


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of the highest inner product with each
    query, a query being a row whose id is divisible by `every`, all if there are fewer; ties go
    to the smaller vec_id.

    A component x counts as floor(256 x). Vectors that are null or hold a null or non-finite
    component take no part; vectors of different lengths are padded with zeros, so an empty one
    scores 0 with all. A row with a null id is no query, and ranks after all others among equal
    scores. Rows that repeat an id are queries of their own, each compared with every row but
    itself. A component or a score beyond 64 bits raises. An empty table gives an empty result;
    other columns are ignored.
    """
    need_columns(vectors, id_col, vector_col)
    spark = vectors.sparkSession
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("v"))
    pieces = written(_pieces(rows, every), "vector-pieces", codec="none")
    n, n_queries = pieces.agg(F.sum("n"), F.sum("queries")).first()
    n, n_queries = n or 0, n_queries or 0
    # lanes are small enough to give every core some, and never larger than a task can hold
    lane = min(LANE_ROWS, max(BLOCK_ROWS, n // (3 * spark.sparkContext.defaultParallelism)))
    lanes, query_lanes = -(-n // lane) or 1, -(-n_queries // LANE_QUERIES) or 1
    number = lambda n: F.pmod(F.xxhash64("piece", "part"), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    parts = _cut_pieces(pieces, lane)
    left = parts.select("*", number(lanes).alias("lane"), each(query_lanes).alias("query_lane"))
    asked = _query_pieces(pieces, every).withColumn("part", F.xxhash64("at"))
    right = asked.select("*", number(query_lanes).alias("query_lane"), each(lanes).alias("lane"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        schema = pa.schema([(f.split()[0], pa.int64()) for f in _FOUND.split(", ")])
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        some = [Rows.unpacked(r, unpack_sorted(r["at"]).view(np.int64)) for r in a.to_pylist()]
        queries = [Rows.unpacked(r, unpack_sorted(r["at"]).view(np.int64)) for r in b.to_pylist()]
        return pa.Table.from_batches(_search(Rows.joined(some), Rows.joined(queries), k), schema)

    keys = ("lane", "query_lane")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, _FOUND)
    order = Window.partitionBy("query_at").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _cut_pieces(pieces: DataFrame, lane: int) -> DataFrame:
    """Pieces as parts that are at most a quarter of a lane, so that lanes come out even."""
    size = max(1, min(PIECE_ROWS, lane // 4))

    def run(parts):
        for row in rows_of(parts):
            rows = Rows.unpacked(row, _addresses(row["piece"], row["n"]))
            for i in range(0, row["n"], size):
                some = rows.take(np.arange(i, min(i + size, row["n"])))
                out = some.packed() | {"piece": row["piece"], "part": i, "at": pack_sorted(some.at)}
                yield pa.RecordBatch.from_pylist([out], schema=schema)

    fields = _QUERIES + ", part long"
    schema = pa.schema([(f.split()[0], pa.int64() if "long" in f else pa.binary()) for f in fields.split(", ")])
    return pieces.mapInArrow(run, fields)
