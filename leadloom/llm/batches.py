"""Documents in numbered batches, for operators that go over the corpus more than once.

The documents are written once, some thousand to a row, compressed together. A task handles a
row at a time and sends what it found in it, in packed arrays, to blocks of a hash space; what a
block answers is addressed to the row, which meets it in a join. So every exchange carries packed
arrays rather than single words, and a frequent word or passage is sent once per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import need_columns, written
from .packed import pack, unpack

#: Bytes of text in a batch, apart from a longer single document.
BATCH_BYTES = 6_000_000

SCHEMA = "batch long, n long, ids binary, nulls binary, sizes binary, text binary"


def batches(docs: DataFrame, id_col: str, text_col: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The documents (null texts as empty ones), written as batches."""
    need_columns(docs, id_col, text_col)

    def run(parts):
        first = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        size = count = 0
        zstd = zstandard.ZstdCompressor(level=3)

        def row():
            known = np.array([0 if i is None else i for i in ids], np.int64)
            return pa.RecordBatch.from_pydict(
                {
                    "batch": pa.array([first + count], pa.int64()),
                    "n": pa.array([len(ids)], pa.int64()),
                    "ids": pa.array([known.tobytes()], pa.binary()),
                    "nulls": pa.array([np.packbits([i is None for i in ids]).tobytes()], pa.binary()),
                    "sizes": pa.array([pack(np.fromiter(map(len, texts), np.uint64, len(texts)))], pa.binary()),
                    "text": pa.array([zstd.compress(b"".join(texts))], pa.binary()),
                }
            )

        for b in parts:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids.append(doc_id)
                texts.append((text.as_py() or "").encode())
                size += len(texts[-1])
                if size >= batch_bytes:
                    yield row()
                    ids, texts, size, count = [], [], 0, count + 1
        if ids:
            yield row()

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return written(src.mapInArrow(run, SCHEMA), "batches", codec="none")


class Batch:
    """One row: ids (null ids as the largest number) and raw texts."""

    def __init__(self, row: dict):
        self.number = row["batch"]
        n = row["n"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.null = np.unpackbits(np.frombuffer(row["nulls"], np.uint8), count=n).astype(bool)
        self.order_ids = np.where(self.null, np.iinfo(np.int64).max, self.ids)
        self._sizes = unpack(row["sizes"]).astype(np.int64)
        self._text = row["text"]

    def texts(self) -> Iterator[bytes]:
        total = int(self._sizes.sum())
        raw = zstandard.ZstdDecompressor().decompress(self._text, max_output_size=total) if total else b""
        end = np.cumsum(self._sizes)
        for a, b in zip((end - self._sizes).tolist(), end.tolist(), strict=True):
            yield raw[a:b]


def rows_of(parts) -> Iterator[dict]:
    """Rows of Arrow batches, one at a time."""
    for b in parts:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def answered(table: DataFrame, answers: DataFrame) -> DataFrame:
    """The batches with `answers`, the list of structs that blocks sent to each."""
    names = [c for c in answers.columns if c != "batch"]
    lists = answers.groupBy("batch").agg(F.collect_list(F.struct(*names)).alias("answers"))
    return table.join(lists, "batch", "left")
