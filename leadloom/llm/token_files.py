"""Token ids in seekable files: independent zstandard frames, checked one by one.

A shard holds the documents of one range of ids, in ascending order:

    frame 0 | frame 1 | ... | index frame | seek table

Each frame is a complete zstandard frame of little-endian unsigned 32-bit ids, a document's ids
never being split between frames. The seek table is the public seekable format: a skippable
frame (magic 0x184D2A5E) with compressed size, content size and the low 32 bits of the XXH64 of
the content per frame, then the footer (number of frames, descriptor 0x80, magic 0x8F92EAB1).
The index frame is skippable too (magic 0x184D2A50): a zstandard frame with doc_id, frame,
first id in the frame and number of ids of each document, then its length in 4 bytes. A reader
takes the tables from the end of the file and then only the frames that it needs.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from leadloom.session import ensure_checkpoint_dir, shared_path

from .common import need_columns

_INDEX_MAGIC, _SEEK_MAGIC, _FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("frame", "<u4"), ("first", "<u8"), ("n", "<u8")])

#: Ids per frame, apart from a longer last document.
FRAME_IDS = 65_536
#: Characters that are encoded at once, apart from a longer last text: some 50 MB in a worker.
PART_CHARS = 4_000_000
#: Distinct words whose ids a worker remembers at most, once a part is done; some 40 bytes each.
CACHE_WORDS = 600_000
#: Runs of signs whose ids a worker remembers.
CACHE_SIGNS = 10_000


class Encoder:
    """The tokenizers library with a memory of words.

    A byte-level vocabulary never joins across the space before a word, so a text without
    doubled white space is encoded word by word, and each distinct word of a part once. What was
    found is remembered in Arrow arrays, which take a fraction of what Python objects would; when
    they are full, the words that were used last stay. Most words are
    letters, perhaps with signs after them or a line break between two of them; the letters and
    the signs are units of the vocabulary's own splitting, and the letters go straight to the
    library's merges. All other words, and all other texts, go through the library's whole encoding. Vocabularies
    for which this does not hold are recognised and used without it. tests/llm compare both ways.
    """

    _double = re.compile(r"\s\s")
    #: Letters that every version of Unicode has, and signs after them, but for the apostrophe.
    _simple = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.used = np.zeros(0, np.int64)  # the part in which each word was met last
        self.part = 0
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        others = [b for b in range(256) if b not in plain]
        self.table = {b: 256 + i for i, b in enumerate(others)}  # the byte-level alphabet
        self.space = chr(self.table[32])
        self.signs = lru_cache(CACHE_SIGNS)(lambda x: self._encode(x).tobytes() if x else b"")
        probe = " Word, über zwei.\nThree x1 don't é."
        self.by_word = len(self.signs("\n")) == 4 and self._by_words([probe])[0] == self._encode(probe).tobytes()

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _letters(self, letters: str, space: str) -> bytes:
        """Ids of letters, with or without a space before them."""
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.table)
        return array("I", [t.id for t in self.tokenize(self.space + letters if space else letters)]).tobytes()

    def _word(self, word: str, known: dict[str, bytes]) -> bytes:
        """Ids of a word and the space before it; known: those of other words."""
        if word.isascii() and word.isalpha():
            return array("I", [t.id for t in self.tokenize(self.space + word)]).tobytes()
        return self._line(word, " ", known)

    def _line(self, word: str, space: str, known: dict[str, bytes]) -> bytes:
        found = self._simple(word)
        if found is not None:
            letters, signs = found.groups()
            if not signs:
                return self._letters(letters, space)
            same = known.get(letters) if space else None  # the same letters without signs
            return (same or self._letters(letters, space)) + self.signs(signs)
        head, line, tail = word.partition("\n")
        if not (head and line):
            return self._encode(space + word).tobytes()
        rest = self._line(tail, "", known) if tail else b""
        return self._line(head, space, known) + self.signs("\n") + rest

    def _found(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of distinct words and the space before each, remembered or computed."""
        self.part += 1
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null())
        known: dict[str, bytes] = {}
        for w in new.to_pylist():
            known[w] = self._word(w, known)
        at = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.used[at[at >= 0]] = self.part
        at[at < 0] = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, new])
        self.ids = pa.concat_arrays([self.ids, pa.array(list(known.values()), pa.large_binary())])
        self.used = np.concatenate([self.used, np.full(len(new), self.part)])
        found = self.ids.take(pa.array(at))
        if len(self.words) > CACHE_WORDS:
            last = pa.array(np.argsort(-self.used, kind="stable")[: CACHE_WORDS // 2])
            self.words, self.ids, self.used = self.words.take(last), self.ids.take(last), self.used[last]
        return found

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Ids of texts: their distinct words are looked up once, and Arrow puts the ids in place."""
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        words = lists.values.dictionary_encode()
        edges = lists.offsets.to_numpy()
        first = [t.partition(" ")[0] for t in texts]  # a first word has no space before it
        alone = pa.array([self._line(w, "", {}) if w else b"" for w in first], pa.large_binary())
        place = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        place[edges[:-1]] = len(words.dictionary) + np.arange(len(texts))
        joined = pa.concat_arrays([self._found(words.dictionary), alone]).take(pa.array(place))
        _, starts, ids = joined.buffers()
        cut = np.frombuffer(starts, np.int64)[edges]
        content = memoryview(ids or b"")
        return [content[i:j].tobytes() for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        plain = [self.by_word and not self._double.search(t) for t in texts]
        found = iter(self._by_words([t for t, p in zip(texts, plain, strict=True) if p]) if any(plain) else ())
        return [next(found) if p else self._encode(t).tobytes() for t, p in zip(texts, plain, strict=True)]

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class ShardWriter:
    """Writes documents to an open file and closes it with index and seek table."""

    def __init__(self, out, frame_ids: int = FRAME_IDS):
        self.out, self.frame_ids = out, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=1)
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple] = []
        self.held: list[bytes] = []
        self.held_ids = self.total = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        if self.held_ids and self.held_ids + n > self.frame_ids:
            self._flush()
        self.docs.append((doc_id or 0, doc_id is None, len(self.frames), self.held_ids, n))
        self.held.append(ids)
        self.held_ids += n
        self.total += n

    def _flush(self) -> None:
        content = b"".join(self.held)
        packed = self.zstd.compress(content)
        self.out.write(packed)
        self.frames.append((len(packed), len(content), xxh64_intdigest(content) & 0xFFFFFFFF))
        self.held, self.held_ids = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        index = self.zstd.compress(np.array(self.docs, _DOC).tobytes())
        self.out.write(struct.pack("<II", _INDEX_MAGIC, len(index) + 4) + index + struct.pack("<I", len(index)))
        table = np.array(self.frames, _ENTRY).tobytes()
        self.out.write(struct.pack("<II", _SEEK_MAGIC, len(table) + 9) + table)
        self.out.write(struct.pack("<IBI", len(self.frames), 0x80, _FOOTER_MAGIC))


class ShardReader:
    """Reads the tables of a shard, and frames on request."""

    def __init__(self, source, size: int):
        self.source = source
        self.zstd = zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != _FOOTER_MAGIC or flags != 0x80:
            raise ValueError("no seek table at the end of the file")
        table = size - 9 - n * _ENTRY.itemsize
        self.frames = np.frombuffer(self._at(table, n * _ENTRY.itemsize), _ENTRY)
        end = table - 8
        (length,) = struct.unpack("<I", self._at(end - 4, 4))
        head = struct.unpack("<II", self._at(end - 12 - length, 8))
        if head != (_INDEX_MAGIC, length + 4):
            raise ValueError("no index frame before the seek table")
        self.docs = np.frombuffer(self.zstd.decompress(self._at(end - 4 - length, length)), _DOC)
        self.starts = np.concatenate([[0], np.cumsum(self.frames["packed"], dtype=np.int64)])

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def frame(self, k: int) -> bytes:
        f = self.frames[k]
        content = self.zstd.decompress(self._at(int(self.starts[k]), int(f["packed"])), max_output_size=int(f["size"]))
        if len(content) != f["size"] or xxh64_intdigest(content) & 0xFFFFFFFF != f["check"]:
            raise ValueError(f"frame {k} is damaged")
        return content

    def read(self, rows: Iterable[int]) -> Iterator[tuple[int, bytes]]:
        """(row of the index, ids) for ascending rows; each frame is decompressed once."""
        held, content = -1, b""
        for i in rows:
            _, _, k, first, n = self.docs[i].tolist()
            if k != held:
                held, content = k, self.frame(k)
            yield i, content[4 * first : 4 * (first + n)]


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a place in the shared folder."""
    uri = re.sub(r"^file:/+", "file:///", path)
    return pafs.FileSystem.from_uri(uri)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, as a full address."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    full = spark.sparkContext.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]
    path = shared_path(spark, name)
    return full + path.removeprefix(base)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of a batch, some at a time."""
    ids: list[int | None] = []
    texts: list[str] = []
    size = 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        ids.append(doc_id)
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size > PART_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    frame_ids: int = FRAME_IDS,
    shards: int | None = None,
) -> DataFrame:
    """Writes the documents, ascending by id, to shards in folder; returns one row per shard:
    shard, path, bytes, docs, n_tokens, start (ids in all shards before it).

    A null text is empty and has the end id only. Rows with a null id come first; rows that
    repeat an id stand next to each other, by a hash of the text and then the text, and may lie in
    several shards. An empty table writes no shard. Every attempt of a task writes a file of its
    own, and the rows name the files of the attempts that Spark took; files of lost attempts may
    stay in the folder and are read by nobody.
    """
    need_columns(docs, id_col, text_col)
    spark = docs.sparkSession
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        task = TaskContext.get()
        writer = stream = None
        files, base = opened(folder)
        name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.zst"
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                files.create_dir(base, recursive=True)
                stream = files.open_output_stream(f"{base}/{name}", compression=None)
                writer = ShardWriter(stream, frame_ids)
            encode = encoder(tokenizer_path)
            for ids, texts in _parts(b):
                for doc_id, found in zip(ids, encode.many(texts), strict=True):
                    writer.add(doc_id, found + end)
        if writer is not None:
            writer.close()
            stream.close()
            row = {
                "shard": [task.partitionId()],
                "path": [f"{folder}/{name}"],
                "bytes": [files.get_file_info(f"{base}/{name}").size],
                "docs": [len(writer.docs)],
                "n_tokens": [writer.total],
            }
            yield pa.RecordBatch.from_pydict(row)

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    done = (
        src.withColumn("hash", F.xxhash64("text"))
        .repartitionByRange(n, "doc_id", "hash")
        .sortWithinPartitions("doc_id", "hash", "text")
        .drop("hash")
        .mapInArrow(run, "shard long, path string, bytes long, docs long, n_tokens long")
        .collect()
    )
    rows, start = [], 0
    for r in sorted(done):
        rows.append((*r, start))
        start += r["n_tokens"]
    schema = "shard long, path string, bytes long, docs long, n_tokens long, start long"
    return spark.createDataFrame(rows, schema)


def read_tokens(shards: DataFrame, with_ids: bool = True) -> DataFrame:
    """One row per document of the shards: doc_id, start, n_tokens, ids_crc32 and, if wanted,
    ids (binary, little-endian unsigned 32-bit)."""
    kind = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        + ([("ids", pa.binary())] if with_ids else [])
    )

    def run(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), strict=True):
                files, place = opened(path)
                with files.open_input_file(place) as source:
                    reader = ShardReader(source, source.size())
                    out = [[] for _ in kind]
                    for i, ids in reader.read(range(len(reader.docs))):
                        doc = reader.docs[i]
                        row = [None if doc["null"] else int(doc["doc_id"]), start, len(ids) // 4, zlib.crc32(ids), ids]
                        start += row[2]
                        for column, value in zip(out, row):
                            column.append(value)
                        if len(out[0]) == 2000:
                            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, kind, strict=True)], schema=kind)
                            out = [[] for _ in kind]
                    if out[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, kind, strict=True)], schema=kind)

    ids = ", ids binary" if with_ids else ""
    spread = shards.select("path", "start").repartition(max(1, shards.count()))
    return spread.mapInArrow(run, f"doc_id long, start long, n_tokens long, ids_crc32 long{ids}")


def fetch(path: str, doc_ids: Iterable[int]) -> dict[int, bytes]:
    """The ids of some documents of one shard; other frames are not read. Of rows that repeat
    an id, the last one is returned; ids that the shard lacks are left out."""
    files, place = opened(path)
    with files.open_input_file(place) as source:
        reader = ShardReader(source, source.size())
        rows = np.flatnonzero(np.isin(reader.docs["doc_id"], list(doc_ids)) & (reader.docs["null"] == 0))
        return {int(reader.docs[i]["doc_id"]): ids for i, ids in reader.read(rows.tolist())}
