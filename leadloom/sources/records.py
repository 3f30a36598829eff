"""Records of delimited text whose cells may hold line breaks, read by many tasks.

A file is read by Spark in splits that end at any line. Whether a line break ends a record depends
on all that is before it, so the scan has two phases. The first reads the lines once and stores
them as chunks, each with the state (outside or inside a quoted cell) that it ends in for either
state that it may begin in. From these few numbers a window over the chunks of a file tells the
state in which each of them really begins, and the number of its first record. Then every chunk is
cut into records on its own; a record that lies over a border is put together from its pieces,
which are grouped by its number.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadloom.session import shared_path

#: Characters of text in a chunk, apart from a longer single line.
CHUNK_CHARS = 1_000_000

_CHUNK = (
    "sheet string, file string, block long, seq long, text string, "
    "end_outside int, end_inside int, n_outside long, n_inside long"
)
_PIECE = "sheet string, file string, number long, block long, seq long, whole boolean, text string"


def _line_states(multi_line: bool) -> Callable[[str, int], int]:
    """State after a line, from the state before it: 1 inside a quoted cell, 0 outside.

    Quotes are doubled inside a quoted cell. A quote within a cell that does not begin with one is
    text, and what follows a closing quote belongs to the cell, up to the next comma.
    """
    import re

    cell = r'(?:"(?:[^"]|"")*+"(?!")[^,]*+|[^",][^,]*+|)'
    opens = re.compile(rf'(?:{cell},)*+"(?:[^"]|"")*+\Z')
    closes = re.compile(r'(?:[^"]|"")*+"(?!")[^,]*+(,|\Z)')

    def after(line: str, state: int) -> int:
        if not multi_line:
            return 0
        if '"' not in line:
            return state
        at = 0
        if state:
            end = closes.match(line)
            if end is None:
                return 1
            if not end[1]:
                return 0
            at = end.end()
        return int(opens.match(line, at) is not None)

    return after


# Functions that run in tasks are made inside others: they travel with the query by value, so
# executors do not need this package.


def _chunker(multi_line: bool, chunk_chars: int):
    after = _line_states(multi_line)

    def run(parts):
        import pyarrow as pa

        def chunk(key, seq, lines):
            ends, counts = [], []
            for state in (0, 1):
                n = 0
                for line in lines:
                    n += not state and line not in ("", "\r")
                    state = after(line, state)
                ends.append(state)
                counts.append(n)
            values = [*key, seq, "\n".join(lines), *ends, *counts]
            names = ["sheet", "file", "block", "seq", "text", "end_outside", "end_inside", "n_outside", "n_inside"]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([v], t)
                    for v, t in zip(
                        values,
                        [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()],
                        strict=True,
                    )
                ],
                names=names,
            )

        key, seq, lines, size = None, 0, [], 0
        for b in parts:
            columns = (b.column(i).to_pylist() for i in range(4))
            for sheet, file, block, line in zip(*columns, strict=True):
                at = (sheet, file, block)
                if lines and (at != key or size >= chunk_chars):
                    yield chunk(key, seq, lines)
                    seq, lines, size = (seq + 1 if at == key else 0), [], 0
                key = at
                lines.append(line)
                size += len(line) + 1
        if lines:
            yield chunk(key, seq, lines)

    return run


def _cutter(multi_line: bool):
    after = _line_states(multi_line)

    def run(parts):
        import pyarrow as pa

        names = ["sheet", "file", "number", "block", "seq", "whole", "text"]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        schema = pa.schema(list(zip(names, types, strict=True)))
        for b in parts:
            for row in b.to_pylist():
                out = {n: [] for n in names}
                state, number = row["start"], row["first"] - 1
                held, whole = [], not state

                def add(whole, row=row, out=out):
                    text = "\n".join(held)
                    values = (row["sheet"], row["file"], number, row["block"], row["seq"], whole, text)
                    for n, v in zip(names, values, strict=True):
                        out[n].append(v)

                for line in row["text"].split("\n"):
                    if not state and not held:
                        if line in ("", "\r"):
                            continue
                        number += 1
                    held.append(line)
                    state = after(line, state)
                    if not state:
                        add(whole)
                        held, whole = [], True
                if held:
                    add(False)
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def _text_lines(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    parts = [
        spark.read.text(path, lineSep="\n").select(
            F.lit(name).alias("sheet"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").alias("line"),
        )
        for name, path in paths.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


class Records:
    """The records of named files or folders: `chunks` as stored, `starts` with the state and the
    first record number of each chunk."""

    def __init__(self, spark: SparkSession, paths: Mapping[str, str], multi_line: bool, chunk_chars: int):
        path = shared_path(spark, "chunks")
        lines = _text_lines(spark, paths)
        lines.mapInArrow(_chunker(multi_line, chunk_chars), _CHUNK).write.option("compression", "zstd").parquet(path)
        self.chunks = spark.read.schema(_CHUNK).parquet(path)
        self.starts = _starts(self.chunks.drop("text"))
        self._multi_line = multi_line

    def files(self) -> DataFrame:
        """(sheet, file, n, unclosed): records of each file, and whether it ends inside a cell."""
        last = F.max_by("end", F.struct("block", "seq")) == 1
        return self.starts.groupBy("sheet", "file").agg(F.sum("n").alias("n"), last.alias("unclosed"))

    def numbered(self, number: int | None = None, after: int | None = None) -> DataFrame:
        """(sheet, file, number, text) of all records, of those after a number, or of one number
        in each file. Chunks that hold none of them are not read."""
        starts = self.starts
        first = F.col("first") - (F.col("start") == 1).cast("int")
        if number is not None:
            starts = starts.where((first <= number) & (F.col("first") + F.col("n") > number))
        if after is not None:
            starts = starts.where(F.col("first") + F.col("n") > after + 1)
        on = ["sheet", "file", "block", "seq"]
        begun = self.chunks.select(*on, "text").join(starts.select(*on, "start", "first"), on)
        pieces = begun.mapInArrow(_cutter(self._multi_line), _PIECE)
        if number is not None:
            pieces = pieces.where(F.col("number") == number)
        if after is not None:
            pieces = pieces.where(F.col("number") > after)
        names = ["sheet", "file", "number"]
        place = F.struct("block", "seq", "text")
        joined = pieces.where("not whole").groupBy(*names).agg(F.sort_array(F.collect_list(place)).alias("p"))
        text = F.array_join("p.text", "\n").alias("text")
        out = pieces.where("whole").select(*names, "text").unionAll(joined.select(*names, text))
        return out.withColumn("text", F.regexp_replace("text", "\r$", ""))


def _starts(chunks: DataFrame) -> DataFrame:
    """Adds `start`, the state in which a chunk begins, `end`, `first`, the number of the first
    record that begins in it, and `n`, how many do.

    A chunk swaps the state, keeps it, or ends in one state whatever it begins in. So the state is
    the last one fixed before, swapped as often as chunks since then swap it; swaps are counted
    from the start of the file, and a fixed state is noted as if it held there.
    """
    up_to = Window.partitionBy("file").orderBy("block", "seq")
    before = up_to.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("end_outside") == F.col("end_inside")
    swaps = (~fixed & (F.col("end_outside") == 1)).cast("int")
    counted = chunks.select("*", F.sum(swaps).over(up_to).alias("swaps"), swaps.alias("swap"))
    noted = F.when(fixed, _odd(F.col("end_outside") + F.col("swaps")))
    last = F.coalesce(F.last(noted, ignorenulls=True).over(before), F.lit(0))
    begun = counted.withColumn("start", _odd(last + F.col("swaps") - F.col("swap")))
    inside = F.col("start") == 1
    ended = begun.select(
        "*",
        F.when(inside, F.col("end_inside")).otherwise(F.col("end_outside")).alias("end"),
        F.when(inside, F.col("n_inside")).otherwise(F.col("n_outside")).alias("n"),
    )
    return ended.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _odd(n: Column) -> Column:
    return F.pmod(n, F.lit(2)).cast("int")
