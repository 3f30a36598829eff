"""Passages of benchmark items in documents, found with one Aho-Corasick automaton.

The automaton holds every window of `window` consecutive words of every item, as the numbers
of its words in a few digits each, so a window has a few nodes per word at most. It is built once from the benchmark table,
whose size is checked, and each document is scanned once. A hit gives word positions, and from
those byte and character offsets in the original text.
"""

from __future__ import annotations

import re
import uuid
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import need_columns, written

#: Bytes that separate words: ASCII without letters and digits. Bytes from 0x80 belong to words.
_SPACES = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes(0x20 if b in _SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile(rb"[^ ]+")

#: Benchmark text that one automaton may hold, in bytes; a larger benchmark takes several passes.
MAX_BENCHMARK_BYTES = 1_000_000


def fold(text: str | None) -> bytes:
    """Lower case for A-Z, a space for each separating byte; byte offsets stay."""
    return (text or "").encode().translate(_FOLD)


def _ascending(ids: set[int | None]) -> list[int | None]:
    return sorted(ids, key=lambda i: (i is None, i or 0))


class Scanner:
    """The automaton over all windows of some items. A word is written as its number in the items,
    in DIGITS digits that have an alphabet per place, so a window can only be found at a word."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        self.sign: dict[bytes, str] = {}
        having: dict[str, set[int | None]] = {}
        for item_id, text in items:
            words = [self.sign.setdefault(w, _sign(len(self.sign))) for w in fold(text).split()]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                having.setdefault("".join(words[i : i + window]), set()).add(item_id)
        self.auto = ahocorasick.Automaton()
        for w, ids in having.items():
            self.auto.add_word(w, (len(w) // DIGITS, tuple(_ascending(ids))))
        if having:
            self.auto.make_automaton()

    def hits(self, words: list[bytes]) -> list[tuple[int, tuple]]:
        """(last word, (number of words, items)) of each window that occurs."""
        if not words or not len(self.auto):
            return []
        text = "".join(map(self.sign.get, words, repeat(_NO_SIGN)))
        return [(end // DIGITS, found) for end, found in self.auto.iter(text)]


#: Digits of a word's number and how many values each but the last has: a node of the automaton has
#: no more children, which it searches in sequence.
DIGITS, BASE = 3, 100

#: What stands for words that no item has.
_NO_SIGN = "\x01" * DIGITS


def _sign(n: int) -> str:
    low = "".join(chr(2 + k * BASE + n // BASE**k % BASE) for k in range(DIGITS - 1))
    return low + chr(2 + (DIGITS - 1) * BASE + n // BASE ** (DIGITS - 1))


_scanners: dict[str, Scanner] = {}


def _scanner(key: str, items: list[tuple[int | None, str | None]], window: int) -> Scanner:
    """The scanner of this worker process for one slice of a benchmark, built once."""
    if key not in _scanners:
        _scanners.clear()
        _scanners[key] = Scanner(items, window)
    return _scanners[key]


def scan(scanner: Scanner, text: str | None) -> tuple[int, list[tuple[int, int]], list[int | None]]:
    """Words in the text, merged hit ranges as (first, last) word, items that occur."""
    words = fold(text).split()
    found = scanner.hits(words)
    if not found:
        return len(words), [], []
    last = np.array([end for end, _ in found], np.int64)
    n = np.array([x[0] for _, x in found], np.int64)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, last - n + 1, 1)
    np.add.at(change, last + 1, -1)
    hit = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]])
    edge = np.flatnonzero(np.diff(hit))
    ranges = [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)]
    return len(words), ranges, _ascending({i for _, x in found for i in x[1]})


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets (start, end) in the original text of word ranges."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(fold(text))] if ranges else []
    chars = lambda i: len(raw[:i].decode())
    return [(chars(at[a][0]), chars(at[b][1])) for a, b in ranges]


def _slices(benchmark: DataFrame, item_col: str, text_col: str, limit: int, null_ids: bool) -> list[DataFrame]:
    """The items in slices of about `limit` bytes of text; items without an id are dealt by their text."""
    rows = benchmark.select(
        benchmark[item_col].cast("long").alias("item"), F.coalesce(benchmark[text_col], F.lit("")).alias("text")
    ).where(F.col("item").isNotNull() | F.lit(null_ids))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // limit))
    dealt = F.when(F.col("item").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("item"))
    return [rows.where(F.pmod(dealt, F.lit(parts)) == k) for k in range(parts)]


def united(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of word ranges."""
    out: list[tuple[int, int]] = []
    for first, last in sorted([*a, *b]):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: tuple[str, ...] = (),
    max_bytes: int = MAX_BENCHMARK_BYTES,
    null_ids: bool = True,
) -> DataFrame:
    """(row, text, n_words, spans, items): the id and the columns in keep as one struct, so that no
    name can clash, without the text, which is beside it if it is kept."""
    need_columns(docs, id_col, text_col)
    kept = [n for n in dict.fromkeys((id_col, *keep)) if n != text_col]
    with_text = text_col in keep
    need_columns(docs, *kept)
    span = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")]))
    spans_type = "array<struct<first:long,last:long,start:long,end:long>>"
    df = docs.select(
        F.struct(*(docs[n] for n in kept)).alias("row"),
        docs[text_col].alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr(f"cast(array() as {spans_type})").alias("spans"),
        F.expr("cast(array() as array<long>)").alias("items"),
    )
    schema = df.schema

    def scanner(some, last_pass):
        key = uuid.uuid4().hex

        def run(batches):
            auto = _scanner(key, some, window)
            for b in batches:
                n, spans, items = [], [], []
                columns = (b.column(k).to_pylist() for k in ("text", "spans", "items"))
                for t, had, ids in zip(*columns, strict=True):
                    k, ranges, more = scan(auto, t)
                    if had:
                        ranges = united([(h["first"], h["last"]) for h in had], ranges)
                    places = original_spans(t or "", ranges) if last_pass else [(0, 0)] * len(ranges)
                    n.append(k)
                    spans.append(
                        [
                            {"first": r[0], "last": r[1], "start": p[0], "end": p[1]}
                            for r, p in zip(ranges, places, strict=True)
                        ]
                    )
                    items.append(_ascending({*ids, *more}))
                text = pa.nulls(b.num_rows, pa.string()) if last_pass and not with_text else b.column("text")
                found = [pa.array(n, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([b.column("row"), text, *found], b.schema.names)

        return run

    slices = _slices(benchmark, item_col, item_text_col, max_bytes, null_ids)
    for k, part in enumerate(slices):
        some = [(r[0], r[1]) for r in part.collect()]  # its size is bounded, by max_bytes or one item
        df = df.mapInArrow(scanner(some, k == len(slices) - 1), schema)
        if k < len(slices) - 1:
            df = written(df, "benchmark-pass")  # one automaton in memory at a time
    return df


def _kept(docs: DataFrame, names, text_col: str) -> list:
    return [F.col("text").alias(n) if n == text_col else F.col(f"row.`{n}`") for n in names]


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, keep: tuple[str, ...] = (), null_ids: bool = False, **names
) -> DataFrame:
    """One row per document: doc_id, the columns in `keep`, n_words, spans (arrays of first and
    last word, start and end character in the original text), items (ids that occur, ascending).

    A null text has no words. Items without words find nothing, nor do items with a null id
    unless `null_ids` is given; then all of them are one null at the end of items. An item with fewer words than the window is one window. Of equal items all count; rows that
    repeat an id are scanned like any other. Without items no document has hits; without
    documents the result is empty. `keep` must not name the columns n_words, spans, items.
    """
    text_col, id_col = names.get("text_col", "text"), names.get("id_col", "doc_id")
    out = _hits(docs, benchmark, window, keep=keep, null_ids=null_ids, **names)
    shown = _kept(docs, dict.fromkeys((id_col, *keep)), text_col)
    return out.select(*shown, "n_words", "spans", "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, **names) -> DataFrame:
    """The documents, with all their columns, in which no benchmark window occurs, of items
    with a null id neither."""
    out = _hits(docs, benchmark, window, keep=tuple(docs.columns), **names)
    return out.where(F.size("items") == 0).select(*_kept(docs, docs.columns, names.get("text_col", "text")))


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Items with a null id count, together as one item, and are left out of the hashed list.
    """
    hits = benchmark_hits(docs, benchmark, window, null_ids=True)
    listed = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"] + 1)
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
