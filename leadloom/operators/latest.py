"""The latest row per key, kept over many extracts."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadloom.commits import ConcurrentRefresh, commit_entry, committed, delete_entries
from leadloom.operators.dedup import dedup_latest
from leadloom.session import delete_folder

#: Buckets of the kept rows; an extract rewrites those of its keys.
BUCKETS = 256


class LatestRows:
    """The rows that ``dedup_latest`` gives over all extracts so far, in a folder.

    Rows lie in buckets by a hash of the key. A new extract is folded into the buckets that its
    keys fall into: those are read, deduplicated together with the extract and written to a new
    folder; all others stay where they are. A commit log entry names the folder of every bucket,
    so readers see the rows before the fold or after it, and of two folds at a time the loser
    starts again from the winner's rows. An extract may come late: order decides, not arrival.

    ``order_by`` must be a total order of the rows of a key for the result to be that of one run
    over all extracts.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str | Column],
        order_by: Sequence[Column],
        buckets: int = BUCKETS,
    ):
        self._spark, self._path, self._keys, self._order = spark, path.rstrip("/"), list(keys), list(order_by)
        self._buckets = buckets

    def _entry(self) -> tuple[int, dict]:
        entries = committed(self._spark, self._path)
        if not entries:
            return -1, {"number": -1, "buckets": self._buckets, "folder_of": {}}
        last = entries[-1]
        if last["buckets"] != self._buckets:
            raise ValueError(f"{self._path} has {last['buckets']} buckets, not {self._buckets}")
        return last["number"], last

    def _bucket(self) -> Column:
        keys = [F.col(k) if isinstance(k, str) else k for k in self._keys]
        return F.pmod(F.xxhash64(*keys), F.lit(self._buckets)).cast("int")

    def _read(self, folder_of: dict[str, str], schema) -> DataFrame | None:
        paths = [f"{self._path}/{folder}/__bucket={b}" for b, folder in sorted(folder_of.items())]
        return self._spark.read.schema(schema).parquet(*paths) if paths else None

    def read(self) -> DataFrame:
        """The latest row of every key."""
        number, entry = self._entry()
        if number < 0 or "schema" not in entry:
            raise ValueError(f"nothing was folded into {self._path}")
        schema = StructType.fromJson(entry["schema"])
        rows = self._read(entry["folder_of"], schema)
        return self._spark.createDataFrame([], schema) if rows is None else rows

    def fold(self, extract: DataFrame, retain_seconds: float = 86_400) -> list[int]:
        """Fold an extract in; returns the buckets that were rewritten. The columns must be those
        of the extracts before. The extract is read twice and must give the same rows. Rows replaced more than ``retain_seconds`` ago are deleted."""
        while True:
            try:
                return self._fold(extract, retain_seconds)
            except ConcurrentRefresh:
                continue

    def _fold(self, extract: DataFrame, retain_seconds: float) -> list[int]:
        number, entry = self._entry()
        schema = json.loads(extract.schema.json())
        fields = lambda s: [(f["name"], f["type"]) for f in s["fields"]]
        if "schema" in entry and fields(entry["schema"]) != fields(schema):
            raise ValueError(f"the columns of the extract differ from those of {self._path}")
        # one row per key of the extract; at most as many buckets as there are
        new = dedup_latest(extract, self._keys, self._order)
        touched = sorted(r[0] for r in extract.select(self._bucket().alias("b")).distinct().collect())
        held = {str(b): entry["folder_of"][str(b)] for b in touched if str(b) in entry["folder_of"]}
        kept = self._read(held, extract.schema)
        merged = new if kept is None else dedup_latest(kept.unionByName(new), self._keys, self._order)
        folder = f"rows-{uuid.uuid4().hex}"
        if touched:
            dealt = merged.withColumn("__bucket", self._bucket()).repartition(len(touched), "__bucket")
            dealt.write.partitionBy("__bucket").parquet(f"{self._path}/{folder}")
        content = {
            "number": number + 1,
            "buckets": self._buckets,
            "schema": schema,
            "at": time.time(),
            "folder_of": entry["folder_of"] | {str(b): folder for b in touched},
        }
        if not commit_entry(self._spark, self._path, number + 1, json.dumps(content)):
            delete_folder(self._spark, f"{self._path}/{folder}")
            raise ConcurrentRefresh(self._path)
        self._prune(retain_seconds)
        return touched

    def _prune(self, retain_seconds: float) -> None:
        entries = committed(self._spark, self._path)
        old = [a for a, b in zip(entries, entries[1:], strict=False) if time.time() - b["at"] > retain_seconds]
        used = {(b, f) for e in entries[len(old) :] for b, f in e["folder_of"].items()}
        gone = {(b, f) for e in old for b, f in e["folder_of"].items()} - used
        delete_entries(self._spark, self._path, [e["number"] for e in old])
        for bucket, folder in sorted(gone):
            delete_folder(self._spark, f"{self._path}/{folder}/__bucket={bucket}")
