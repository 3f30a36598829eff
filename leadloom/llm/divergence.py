"""How the sources of a language differ in their words: a single-pass in-memory index.

A task reads its documents once and counts into block postings, per group the occurrences of a
term and per language its documents. When the block is full it is spilled: as runs sorted by
term, cut by the hash shard of language and term into pieces. A shard gets its pieces in the
order of their first terms and merges them through a heap, which holds the pieces that have
begun and no more, into the frequencies of a term in every source. Terms in too few documents
end there.

Probabilities are smoothed, so a term that a source lacks still has one, the same for all such
terms. The distance of two sources is therefore a base, as if neither had any term, and a
correction per term that either has. Corrections are streamed over lanes of terms, in tiles of
two blocks of sources, and summed by Spark.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import rows_of
from .common import need_columns, written
from .packed import pack, unpack

#: Bytes of a block's postings, as estimated, at which it is spilled.
BLOCK_BYTES = 128_000_000

#: Postings of a piece of a run, and of a lane of the corrections.
PIECE_ENTRIES = 16_384
LANE_ENTRIES = 20_000

#: Sources of a block; a tile holds two blocks.
BLOCK_SOURCES = 128

_SCALE = 1_000_000_000
_SMOOTH = 5

# letters and all bytes beyond ASCII stay, A-Z in lower case; what is left separates terms
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Block:
    """Postings in memory: occurrences by group, documents by language."""

    def __init__(self):
        self.count: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        terms = terms_of(text)
        if not terms:
            return
        once = set(terms)
        count, docs = self.count[lang, source], self.docs[lang]
        before = len(count) + len(docs)
        count.update(terms)
        docs.update(once)
        new = len(count) + len(docs) - before
        if new:
            self.size += new * (120 + sum(map(len, once)) // len(once))

    def runs(self, shards: int) -> Iterator[dict]:
        """Pieces, sorted by shard, language and term."""
        for lang, docs in sorted(self.docs.items()):
            terms = sorted(docs)
            place = dict(zip(terms, range(len(terms)), strict=True))
            sources = sorted(s for name, s in self.count if name == lang)
            at, code, number = [], [], []
            for i, s in enumerate(sources):
                count = self.count[lang, s]
                at.append(np.fromiter(map(place.__getitem__, count), np.int64, len(count)))
                number.append(np.fromiter(count.values(), np.int64, len(count)))
                code.append(np.full(len(count), i, np.int64))
            at, code, number = np.concatenate(at), np.concatenate(code), np.concatenate(number)
            start = zlib.crc32(lang.encode())
            shard = np.fromiter((zlib.crc32(t, start) % shards for t in terms), np.int64, len(terms))
            order = np.lexsort((code, at, shard[at]))
            code, number = code[order], number[order]
            by_shard = np.argsort(shard, kind="stable")
            lists = np.bincount(at, minlength=len(terms))[by_shard]
            ends = np.cumsum(lists)
            weight = np.cumsum(lists + np.fromiter(map(len, terms), np.int64, len(terms))[by_shard] // 40)
            shard = shard[by_shard]
            first = 0
            while first < len(terms):
                last = np.searchsorted(weight, (weight[first - 1] if first else 0) + PIECE_ENTRIES) + 1
                last = min(last, np.searchsorted(shard, shard[first], side="right"))
                names = [terms[i] for i in by_shard[first:last].tolist()]
                cut = slice(ends[first - 1] if first else 0, ends[last - 1])
                text = b" ".join(names)
                yield {
                    "shard": int(shard[first]),
                    "lang": lang,
                    "first": names[0],
                    "sources": sources,
                    "text_size": len(text),
                    "terms": zstandard.ZstdCompressor(level=1).compress(text),
                    "docs": pack(np.fromiter(map(docs.__getitem__, names), np.uint64, len(names))),
                    "lists": pack(lists[first:last].astype(np.uint64)),
                    "codes": pack(code[cut].astype(np.uint64)),
                    "counts": pack(number[cut].astype(np.uint64)),
                }
                first = int(last)


_RUN = pa.schema(
    [
        ("shard", pa.int64()),
        ("lang", pa.string()),
        ("first", pa.binary()),
        ("sources", pa.list_(pa.string())),
        ("text_size", pa.int64()),
        *((n, pa.binary()) for n in ("terms", "docs", "lists", "codes", "counts")),
    ]
)
_RUN_SQL = (
    "shard long, lang string, first binary, sources array<string>, text_size long, "
    "terms binary, docs binary, lists binary, codes binary, counts binary"
)


def _spill(docs: DataFrame, shards: int) -> DataFrame:
    """docs: lang, source, text. Runs of all blocks."""

    def run(parts):
        block = Block()

        def spilled():
            for piece in block.runs(shards):
                yield pa.RecordBatch.from_pylist([piece], schema=_RUN)

        for b in parts:
            texts = b.column(2).cast(pa.binary())
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts, strict=True):
                block.add(lang, source, text.as_py())
                if block.size >= BLOCK_BYTES:
                    yield from spilled()
                    block = Block()
        yield from spilled()

    return docs.mapInArrow(run, _RUN_SQL)


def _entries(row: dict) -> Iterator[tuple[bytes, int, list[str], list[int]]]:
    names = zstandard.ZstdDecompressor().decompress(row["terms"], max_output_size=row["text_size"]).split(b" ")
    docs, lists, codes, counts = (unpack(row[n]).tolist() for n in ("docs", "lists", "codes", "counts"))
    sources, end = row["sources"], 0
    for t, d, n in zip(names, docs, lists, strict=True):
        begin, end = end, end + n
        yield t, d, [sources[i] for i in codes[begin:end]], counts[begin:end]


def merged(pieces: Iterator[dict]) -> Iterator[tuple[bytes, int, dict[str, int]]]:
    """Term, documents and occurrences by source, from the pieces of one shard and language in
    the order of their first terms. Only pieces that have begun are open."""
    heap: list[tuple] = []
    opened = itertools.count()
    coming = next(pieces, None)
    while heap or coming is not None:
        while coming is not None and (not heap or coming["first"] <= heap[0][0]):
            rest = _entries(coming)
            heapq.heappush(heap, (coming["first"], next(opened), next(rest), rest))
            coming = next(pieces, None)
        term, docs, count = heap[0][0], 0, {}
        while heap and heap[0][0] == term:
            _, order, (_, d, sources, counts), rest = heap[0]
            docs += d
            for s, n in zip(sources, counts, strict=True):
                count[s] = count.get(s, 0) + n
            following = next(rest, None)
            if following is None:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (following[0], order, following, rest))
        yield term, docs, count


_KEPT = pa.schema(
    [
        ("lang", pa.string()),
        ("term", pa.string()),
        ("sources", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)


def _merge(runs: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """Per language and kept term its sources and their counts."""

    def run(parts):
        for (_, lang), pieces in itertools.groupby(rows_of(parts), key=lambda r: (r["shard"], r["lang"])):
            out: dict[str, list] = {n: [] for n in _KEPT.names}
            held = 0
            for term, docs, count in merged(pieces):
                if docs < min_docs:
                    continue
                for name, v in zip(out, (lang, term.decode(), list(count), list(count.values())), strict=True):
                    out[name].append(v)
                held += len(count) + 1
                if held >= PIECE_ENTRIES:
                    yield pa.RecordBatch.from_pydict(out, schema=_KEPT)
                    out, held = {n: [] for n in out}, 0
            if held:
                yield pa.RecordBatch.from_pydict(out, schema=_KEPT)

    dealt = runs.repartition(shards, "shard").sortWithinPartitions("shard", "lang", "first")
    return dealt.mapInArrow(run, "lang string, term string, sources array<string>, counts array<long>")


def probability(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / total) in whole numbers: long division, three digits at a time."""
    whole, rest = np.divmod(count + _SMOOTH, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def _p(count: Column, total: Column) -> Column:
    """The same as a column expression."""
    up = (count.cast("decimal(19,0)") + _SMOOTH) * F.lit(_SCALE).cast("decimal(10,0)")
    return F.call_function("div", up, total.cast("decimal(20,0)")) + 1


_CORRECTION = "lang string, one string, other string, correction long"


def _corrections(kept: DataFrame, groups: DataFrame, lanes: int, blocks: int) -> DataFrame:
    """(lang, one < other, correction) for pairs of sources, in parts to be summed."""
    tile = [(a, b) for a in range(blocks) for b in range(a, blocks)]
    block = lambda s: F.pmod(F.xxhash64(s), F.lit(blocks))
    lane = F.pmod(F.xxhash64("term"), F.lit(lanes)).alias("lane")
    tiles = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in tile])).alias("tile")
    entry = F.arrays_zip("sources", "counts").alias("entry")
    here = F.filter("entry", lambda e: block(e["sources"]).isin(F.col("tile.a"), F.col("tile.b")))
    if blocks == 1:
        here = F.col("entry")
    left = kept.select("lang", lane, entry, tiles).select("lang", "lane", "tile", here.alias("entry"))
    left = left.where(F.size("entry") > 0).select("lang", "lane", "tile", "entry.sources", "entry.counts")
    right = (
        groups.select("lang", "source", "total", block("source").alias("block"), tiles)
        .where("block in (tile.a, tile.b)")
        .withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)).cast("array<long>")))
        .select("lang", "lane", "tile", "source", "total", "block")
    )
    schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (f.split() for f in _CORRECTION.split(", "))])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or b.num_rows < 2:
            return schema.empty_table()
        order = sorted(range(b.num_rows), key=b.column("source").to_pylist().__getitem__)
        source, total, blk = (b.column(n).take(order).to_pylist() for n in ("source", "total", "block"))
        lists = pa.compute.list_value_length(a.column("sources")).to_numpy()
        at = {s: i for i, s in enumerate(source)}
        code = np.array([at[s] for s in a.column("sources").combine_chunks().flatten().to_pylist()], np.int64)
        count = a.column("counts").combine_chunks().flatten().to_numpy()
        two = b.column("tile")[0].as_py()
        pairs = np.ones((len(source), len(source)), bool)
        if two["a"] != two["b"]:
            pairs = np.not_equal.outer(blk, blk)
        sums = summed_corrections(lists, code, count, np.array(total, np.int64), pairs)
        one, other = np.nonzero(np.triu(sums + sums.T, 1))
        value = (sums + sums.T)[one, other]
        out = [b.column("lang")[0].as_py()] * len(one), [source[i] for i in one], [source[i] for i in other], value
        return pa.table(dict(zip(schema.names, out, strict=True)), schema=schema)

    keys = ("lang", "lane", "tile")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, _CORRECTION)


def summed_corrections(lists, code, count, total, pairs) -> np.ndarray:
    """Per pair of sources, in one of its two cells: over the terms that either has, the distance
    of their probabilities less the distance of the probabilities of missing terms.

    Terms have `lists` postings each: source `code` and `count`. A pair's term is taken where its
    earlier source has the term, or else where the later one has it.
    """
    n = len(total)
    none = probability(np.zeros(n, np.int64), total)
    p = probability(count, total[code])
    sums = np.zeros((n, n), np.int64)
    later = np.triu(np.ones((n, n), bool), 1)
    edges = np.concatenate([[0], np.cumsum(lists)])
    step = max(1, 1_000_000 // n)
    for first in range(0, len(lists), step):
        last = min(first + step, len(lists))
        cut = slice(edges[first], edges[last])
        row = np.repeat(np.arange(last - first), lists[first:last])
        dense = np.tile(none, (last - first, 1))
        dense[row, code[cut]] = p[cut]
        has = np.zeros(dense.shape, bool)
        has[row, code[cut]] = True
        for g in range(n):
            at = np.flatnonzero(has[:, g])
            if len(at):
                change = np.abs(dense[at, g, None] - dense[at]) - np.abs(none[g] - none)
                sums[g] += np.where((later[g] | ~has[at]) & pairs[g], change, 0).sum(axis=0)
    return sums


def divergence(
    docs: DataFrame,
    min_docs: int = 30,
    top_terms: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from each
    other one (part `pair`, item the other source, all ranks), and the terms in which it exceeds
    its language most (part `term`, ranks up to `top_terms`).

    Terms are runs of letters (and of anything beyond ASCII), A-Z in lower case. A language keeps
    the terms of at least `min_docs` of its documents. A kept term has the probability
    p = 1 + floor(10^9 (count + 5) / (N + 5 V)) in a group (lang, source) and in the language, N
    being the occurrences of kept terms there and V the number of kept terms. A pair's value is
    the sum of |p - q| over all kept terms, 0 if there are none; a term's is p - q. Values rank
    in descending order, ties by the item in UTF-8.

    Null text, lang and source read as ''. Every row is a document, whatever its id. A group
    without terms has its pairs; a language with a single source has none. An empty table gives
    an empty result; other columns are ignored.
    """
    need_columns(docs, text_col, lang_col, source_col)
    spark = docs.sparkSession
    clean = lambda c, name: F.coalesce(docs[c], F.lit("")).alias(name)
    rows = docs.select(clean(lang_col, "lang"), clean(source_col, "source"), clean(text_col, "text"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = written(_merge(_spill(rows, shards), shards, min_docs), "frequencies")

    entries = kept.select("lang", "term", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("in_lang"),
                          F.explode(F.arrays_zip("sources", "counts")).alias("e")).select(
        "lang", "term", "in_lang", F.col("e.sources").alias("source"), F.col("e.counts").alias("count")
    )
    found = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("v"))
    by_lang = Window.partitionBy("lang")
    n = F.coalesce("n", F.lit(0))
    groups = written(
        rows.select("lang", "source").distinct().join(found, ["lang", "source"], "left").join(vocabulary, "lang", "left")
        .select("lang", "source", n.alias("n"), F.coalesce("v", F.lit(0)).alias("v"), F.sum(n).over(by_lang).alias("n_lang"),
                F.count("*").over(by_lang).alias("n_sources"))
        .withColumn("total", F.col("n") + _SMOOTH * F.col("v")),
        "groups",
    )

    most = kept.groupBy("lang").agg(F.sum(F.size("sources")).alias("n")).agg(F.max("n")).first()[0] or 0
    widest = groups.agg(F.max("n_sources")).first()[0] or 0
    lanes, blocks = int(most) // LANE_ENTRIES + 1, int(widest) // BLOCK_SOURCES + 1
    parts = _corrections(kept, groups.where("v > 0"), lanes, blocks)
    corrections = parts.groupBy("lang", "one", "other").agg(F.sum("correction").alias("correction"))

    none = F.when(F.col("v") > 0, _p(F.lit(0), F.col("total"))).otherwise(0)
    a = groups.select("lang", "source", "v", none.alias("p"))
    b = groups.select("lang", F.col("source").alias("item"), none.alias("q"))
    pairs = (
        a.join(b, "lang")
        .where(F.col("source") != F.col("item"))
        .select("*", F.least("source", "item").alias("one"), F.greatest("source", "item").alias("other"))
        .join(corrections, ["lang", "one", "other"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item",
                (F.col("v") * F.abs(F.col("p") - F.col("q")) + F.coalesce("correction", F.lit(0))).alias("value"))
    )

    p, q = _p(F.col("count"), F.col("total")), _p(F.col("in_lang"), F.col("n_lang") + _SMOOTH * F.col("v"))
    terms = entries.join(groups, ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order)
    return (
        terms.where("value > 0").withColumn("rank", rank).where(F.col("rank") <= top_terms)
        .unionByName(pairs.withColumn("rank", rank))
    )
