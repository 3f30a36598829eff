"""Repeated passages: words covered by a window of words that also starts earlier.

Count-min prefilter. Every batch of documents makes a sketch of its windows: in each of `DEPTH`
rows, the cells that its windows hash to, with counts that stop at 2. Sketches of all batches are
merged cell by cell, each block of cells in one task, so the merged sketch overestimates the
count of a window and never underestimates it. Its width grows with the number of windows, and
it is never in one place: each batch gets back one bit for each of its own cells. Windows with a
cell of count 1 occur once and are done with.

The second pass sends the other windows, once per batch, as 128 bits of hash with id, row and
start, to the block of their hash. There they are grouped exactly, and all that have a smaller id
elsewhere go back to their batch by row and start, which removes the words that they cover. The
id decides the order alone, so rows that share an id are never taken for each other. A window
that a block marks for nothing costs a few bytes; none is lost.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .batches import Batch, answered, batches, rows_of
from .common import written
from .packed import pack, pack_bits, pack_sorted, to_unsigned, unpack, unpack_bits, unpack_sorted

#: Rows of the sketch, cells per window in each, and windows that one block of cells is made for.
DEPTH = 2
WIDTH = 4
BLOCK_WINDOWS = 2_000_000

_M = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_FINISH = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def _powers(m: int, n: int) -> np.ndarray:
    out = np.full(n, m, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _rolling(words: np.ndarray, window: int, m: int) -> np.ndarray:
    """Polynomial hash, modulo 2^64, of each run of `window` word hashes."""
    n = len(words) - window + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(m, len(words)), dtype=np.uint64)])
    h = (sums[window:] - sums[:n]) * _powers(pow(m, -1, 1 << 64), n)
    for f in _FINISH:
        h = (h ^ (h >> np.uint64(33))) * np.uint64(f)
    return h ^ (h >> np.uint64(33))


class Windows:
    """All windows of a batch: document (row in the batch), start word and hashes."""

    def __init__(self, batch: Batch, window: int):
        hashes, sizes = [], []
        for raw in batch.texts():
            words = raw.split()
            sizes.append(len(words))
            if len(words) >= window:
                hashes.append(np.frombuffer(b"".join(map(xxh3_128_digest, words)), "<u8").reshape(-1, 2))
        size = np.array(sizes, np.int64)
        long = np.flatnonzero(size >= window)
        flat = np.concatenate(hashes) if hashes else np.zeros((0, 2), np.uint64)
        first = np.cumsum(size[long]) - size[long]
        count = size[long] - window + 1
        self.doc = np.repeat(long, count)
        self.start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(first, count) + self.start
        self.h1, self.h2 = (
            (_rolling(flat[:, k], window, _M[k])[at] if len(flat) else np.zeros(0, np.uint64)) for k in (0, 1)
        )

    def cells(self, row: int, bits: int) -> np.ndarray:
        mixed = self.h1 if row == 0 else (self.h1 ^ (self.h2 << np.uint64(1))) * np.uint64(_FINISH[0])
        return mixed >> np.uint64(64 - bits)


def _parts(sorted_values: np.ndarray, shift: int, n: int) -> np.ndarray:
    """Edges of the blocks in sorted values whose block is value >> shift."""
    return np.searchsorted(sorted_values, np.arange(n + 1, dtype=np.uint64) << np.uint64(shift))


def _sketch(table: DataFrame, window: int, bits: int, block_bits: int) -> DataFrame:
    """(block, batch, row, cells): cell in the block times 2, plus 1 if the count is over 1."""

    def run(parts):
        for row in rows_of(parts):
            batch = Batch(row)
            win = Windows(batch, window)
            out = {"block": [], "batch": [], "row": [], "cells": []}
            for r in range(DEPTH):
                cell, count = np.unique(win.cells(r, bits), return_counts=True)
                value = cell << np.uint64(1) | (count > 1).astype(np.uint64)
                shift = bits - block_bits + 1
                edges = _parts(value, shift, 1 << block_bits)
                for k in np.flatnonzero(np.diff(edges)).tolist():
                    part = value[edges[k] : edges[k + 1]] - (np.uint64(k) << np.uint64(shift))
                    out["block"].append(k)
                    out["batch"].append(batch.number)
                    out["row"].append(r)
                    out["cells"].append(pack_sorted(part))
            if out["block"]:
                yield pa.RecordBatch.from_pydict(out)

    return table.mapInArrow(run, "block long, batch long, row long, cells binary")


def _merge(sketches: DataFrame, cells: int) -> DataFrame:
    """(batch, row, block, over): for each cell that a batch sent, whether its merged count is over 1."""

    def run(group: pa.Table) -> pa.Table:
        out = {"batch": [], "row": [], "block": [], "over": []}
        count = np.zeros(cells, np.uint8)
        sent = [unpack_sorted(c.as_py()) for c in group.column("cells")]
        for s in sent:
            at = (s >> np.uint64(1)).astype(np.int64)
            count[at] = np.minimum(count[at] + 1 + (s & np.uint64(1)).astype(np.uint8), 2)
        for i, s in enumerate(sent):
            over = count[(s >> np.uint64(1)).astype(np.int64)] > 1
            if over.any():
                for name in ("batch", "row", "block"):
                    out[name].append(group.column(name)[i].as_py())
                out["over"].append(pack_bits(over))
        schema = pa.schema([("batch", pa.int64()), ("row", pa.int64()), ("block", pa.int64()), ("over", pa.binary())])
        return pa.table(out, schema=schema)

    return sketches.groupBy("block", F.col("row").alias("r")).applyInArrow(
        run, "batch long, row long, block long, over binary"
    )


def _estimated(win: Windows, answers: list[dict], bits: int, block_bits: int) -> np.ndarray:
    """Windows whose estimated count is over 1: all their cells have one."""
    repeated = np.ones(len(win.h1), bool)
    for r in range(DEPTH):
        cell, back = np.unique(win.cells(r, bits), return_inverse=True)
        edges = _parts(cell, bits - block_bits, 1 << block_bits)
        over = np.zeros(len(cell), bool)
        for a in answers:
            if a["row"] == r:
                over[edges[a["block"]] : edges[a["block"] + 1]] = unpack_bits(a["over"])
        repeated &= over[back]
    return repeated


_REPLY = "batch long, rows binary, starts binary"
_SENT = "block long, batch long, h1 binary, h2 binary, ids binary, rows binary, starts binary"


def _first_of(changed: np.ndarray) -> np.ndarray:
    """For sorted values, the index of the first of each run; `changed` marks the runs' first ones."""
    return np.flatnonzero(changed)[np.cumsum(changed) - 1]


def _starts(*sorted_keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in sorted_keys], axis=0)
    return new


def _candidates(table: DataFrame, window: int, bits: int, block_bits: int) -> DataFrame:
    """Windows estimated repeated, by block of their hash; and, in a block of its own below zero,
    the places that the batch itself knows to be later ones. Of each window a batch sends the
    places with its smallest id, one per row: a single one unless rows share an id."""

    def run(parts):
        for row in rows_of(parts):
            batch = Batch(row)
            win = Windows(batch, window)
            at = np.flatnonzero(_estimated(win, row["answers"] or [], bits, block_bits))
            doc, start = win.doc[at], win.start[at]
            ids = to_unsigned(batch.order_ids[doc])
            h1, h2 = win.h1[at], win.h2[at]
            order = np.lexsort((start, doc, ids, h2, h1))
            h1, h2, ids, doc, start = h1[order], h2[order], ids[order], doc[order], start[order]
            smallest = ids == ids[_first_of(_starts(h1, h2))] if len(ids) else np.zeros(0, bool)
            sent = smallest & _starts(h1, h2, ids, doc)
            out = {n.split()[0]: [] for n in _SENT.split(", ")}

            def send(block, cut, out=out, batch=batch, h1=h1, h2=h2, ids=ids, doc=doc, start=start):
                place = doc[cut].astype(np.uint64), start[cut].astype(np.uint64)
                values = (block, batch.number, pack_sorted(h1[cut]), pack(h2[cut]), pack(ids[cut]), *map(pack, place))
                for name, v in zip(out, values, strict=True):
                    out[name].append(v)

            known = np.flatnonzero(~sent)
            if len(known):
                known = known[np.lexsort((start[known], doc[known]))]
                h = np.zeros(len(ids), np.uint64)
                send(-1 - batch.number, known, h1=h, h2=h, ids=h)
            sent = np.flatnonzero(sent)
            edges = _parts(h1[sent], 64 - block_bits, 1 << block_bits) if block_bits else np.array([0, len(sent)])
            edges[-1] = len(sent)
            for k in np.flatnonzero(np.diff(edges)).tolist():
                send(k, sent[edges[k] : edges[k + 1]])
            if out["block"]:
                yield pa.RecordBatch.from_pydict(out)

    return table.mapInArrow(run, _SENT)


def _later(sent: DataFrame) -> DataFrame:
    """(batch, rows, starts) of the windows that start earlier elsewhere, grouped exactly."""

    def run(group: pa.Table) -> pa.Table:
        schema = pa.schema([("batch", pa.int64()), ("rows", pa.binary()), ("starts", pa.binary())])
        if group.column("block")[0].as_py() < 0:
            return group.select(["batch", "rows", "starts"]).cast(schema)
        get = lambda name, f: [f(x.as_py()) for x in group.column(name)]
        each = get("h1", unpack_sorted)
        size = [len(x) for x in each]
        h1 = np.concatenate(each)
        h2, ids, doc, start = (np.concatenate(get(n, unpack)) for n in ("h2", "ids", "rows", "starts"))
        source = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((ids, h2, h1))
        first = _first_of(_starts(h1[order], h2[order]))
        late = order[ids[order] != ids[order][first]]
        late = late[np.lexsort((start[late], doc[late], source[late]))]
        edges = np.searchsorted(source[late], np.arange(len(size) + 1))
        out = {"batch": [], "rows": [], "starts": []}
        for k in np.flatnonzero(np.diff(edges)).tolist():
            cut = late[edges[k] : edges[k + 1]]
            out["batch"].append(group.column("batch")[k].as_py())
            out["rows"].append(pack(doc[cut]))
            out["starts"].append(pack(start[cut]))
        return pa.table(out, schema=schema)

    return sent.groupBy("block").applyInArrow(run, _REPLY)


def _cut(table: DataFrame, window: int, with_text: bool) -> DataFrame:
    def run(parts):
        for row in rows_of(parts):
            batch = Batch(row)
            marks: dict[int, list[np.ndarray]] = {}
            for a in row["answers"] or []:
                # sorted by row
                doc, s = unpack(a["rows"]).astype(np.int64), unpack(a["starts"]).astype(np.int64)
                edges = np.searchsorted(doc, np.arange(len(batch.ids) + 1))
                for k in np.flatnonzero(np.diff(edges)).tolist():
                    marks.setdefault(k, []).append(s[edges[k] : edges[k + 1]])
            out = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": []} | ({"text": []} if with_text else {})
            held = 0
            for k, raw in enumerate(batch.texts()):
                words = raw.split()
                n = len(words)
                starts = marks.get(k)
                if starts:
                    s = np.concatenate(starts)
                    change = np.zeros(n + 1, np.int64)
                    np.add.at(change, s, 1)
                    np.add.at(change, s + window, -1)
                    gone = np.cumsum(change[:n]) > 0
                    words = [words[i] for i in np.flatnonzero(~gone).tolist()]
                kept = b" ".join(words)
                out["doc_id"].append(None if batch.null[k] else int(batch.ids[k]))
                out["n_words"].append(n)
                out["n_removed"].append(n - len(words))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    out["text"].append(kept.decode())
                held += len(kept)
                if held > 8_000_000:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)
                    out, held = {n: [] for n in out}, 0
            if out["doc_id"]:
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + ([("text", pa.string())] if with_text else []))
    text = ", text string" if with_text else ""
    return table.mapInArrow(run, f"doc_id long, n_words long, n_removed long, kept_sha256 string{text}")


def remove_repeats(
    docs: DataFrame,
    window: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and, if wanted, the kept
    words joined by one space (text).

    Words are runs between ASCII white space, unchanged. A word is removed if a window of
    `window` words that covers it also starts earlier: in a smaller doc_id, or earlier in the
    same document. Windows are judged on the input. Null texts have no words, texts shorter than
    the window lose none. A null id is larger than any other. Rows that share an id (or have none)
    are documents of their own, and none is earlier than another: a window that two of them have
    goes from both if a smaller id has it, and stays in both otherwise. An empty table gives an
    empty result; other columns are ignored.
    """
    table = batches(docs, id_col, text_col)
    # words are counted by their separators, which is an upper bound for the width of the sketch
    n = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()[0] // 5
    bits = max(12, int(n * WIDTH).bit_length())
    block_bits = min(bits - 8, max(2, int(n // BLOCK_WINDOWS).bit_length()))
    over = _merge(_sketch(table, window, bits, block_bits), 1 << (bits - block_bits))
    over = written(over, "sketch-answers")
    sent = _candidates(answered(table, over), window, bits, block_bits)
    return _cut(answered(table, _later(sent)), window, with_text)
