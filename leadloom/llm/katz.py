"""A Katz backoff language model over word pairs, and the score of every document under it.

Tokens are the lower-cased (A-Z) words of a document and one end. A pair's probability is its
Good-Turing discounted share of its history's count; pairs that training has not seen share what
the discounts of their history left, in proportion to the words' own probabilities, which are
discounted in the same way and leave the rest to unknown words:

    P(w|h) = d(c(h,w)) c(h,w) / c(h)      if the pair was seen
    P(w|h) = a(h) P(w)                    if not;  a(h) = left(h) / (1 - sum of P(w) seen after h)
    P(w|h) = P(w)                         if h was not seen
    P(w)   = d(c(w)) c(w) / N, and the rest for an unknown word

so that the probabilities after any history sum to one. Where a history has only counts that are
not discounted, its total is raised by one, which leaves something for other words.

The counts never leave the executors. Batches of documents send their distinct words, and then
their distinct pairs, to blocks of the model; a block adds up counts, keeps its part of the table
(written, partitioned by kind of row) and answers each batch for what it sent. Pairs go to the
block of their history, so its leftover is found in one place; a history that fills more than a
block by itself is split by the second word, and the sums of its pieces, few as such histories
are, are added up on the driver.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_digest

from leadloom.session import shared_path

from .batches import Batch, answered, batches, rows_of
from .packed import pack, pack_sorted, unpack, unpack_sorted

#: Counts up to this are discounted.
CUT = 5
#: Words of training text per block of words, and pairs per block of pairs.
BLOCK = 2_000_000

_END = np.uint64(1)
_UNKNOWN = (1 << 32) - 1
_LOW = np.uint64(_UNKNOWN)
_32 = np.uint64(32)


def discounts(n: np.ndarray) -> np.ndarray:
    """d[r] for counts r = 0..CUT (1 beyond) from n[r], the number of types that occur r times.

    The largest cut up to CUT is taken for which all discounts lie between 0 and 1; if there is
    none, single occurrences keep half.
    """
    for cut in range(CUT, 0, -1):
        if (n[1 : cut + 2] <= 0).any():
            continue
        r = np.arange(1, cut + 1)
        common = (cut + 1) * n[cut + 1] / n[1]
        if common >= 1:
            continue
        d = ((r + 1) * n[2 : cut + 2] / (r * n[1 : cut + 1]) - common) / (1 - common)
        if (d > 0).all() and (d < 1).all():
            return np.concatenate([[1.0], d, np.ones(CUT - cut)])
    return np.concatenate([[1.0, 0.5], np.ones(CUT - 1)])


@dataclass
class Words:
    """What all tasks need to know of single words: totals, discounts, first id of each block."""

    n: int
    types: int
    d: np.ndarray
    first: np.ndarray
    rest: float
    total: float  # n, or n + 1 if no count is discounted

    @classmethod
    def of(cls, n: int, sizes: list[int], n_r: np.ndarray) -> Words:
        d = discounts(n_r)
        left = float(((1 - d) * np.arange(CUT + 1) * n_r[: CUT + 1])[1:].sum())
        total = float(n if left > 0 else n + 1)
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        if first[-1] >= _UNKNOWN:
            raise OverflowError("more distinct words than the 32 bits of a word's number can tell apart")
        return cls(n, int(sum(sizes)), d, first, left / total if left > 0 else 1 / total, total)

    def prob(self, count: np.ndarray) -> np.ndarray:
        seen = self.d[np.minimum(count, CUT + 1).clip(max=CUT)] * (count <= CUT) + (count > CUT)
        return np.where(count > 0, seen * count / self.total, self.rest)


class Tokens:
    """The tokens of a batch: hashes of its distinct words, the number of each token's word, the
    documents' sizes, and which of them train."""

    def __init__(self, batch: Batch, mod: int):
        hashes, sizes = [], []
        for raw in batch.texts():
            words = raw.lower().split()
            hashes.append(np.frombuffer(b"".join(map(xxh3_64_digest, words)), ">u8").astype(np.uint64))
            hashes.append(np.array([_END]))
            sizes.append(len(words) + 1)
        self.size = np.array(sizes, np.int64)
        self.end = np.cumsum(self.size)
        self.words, self.token = np.unique(np.concatenate(hashes), return_inverse=True)
        names = [b"" if null else str(i).encode() for i, null in zip(batch.ids.tolist(), batch.null.tolist(), strict=True)]
        self.held = np.array([zlib.crc32(x) % mod == 0 for x in names], bool)
        self.train = np.repeat(~self.held, self.size)


def _edges(blocks: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(blocks, np.arange(n + 1))


def _rows(out: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(out, schema=schema)


_SENT_WORDS = pa.schema([("block", pa.int64()), ("batch", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])


def _send_words(table: DataFrame, mod: int, bits: int) -> DataFrame:
    def run(parts):
        for row in rows_of(parts):
            batch = Batch(row)
            tokens = Tokens(batch, mod)
            count = np.bincount(tokens.token, tokens.train, len(tokens.words)).astype(np.uint64)
            edges = _edges((tokens.words >> np.uint64(64 - bits)).astype(np.int64), 1 << bits)
            out = {n: [] for n in _SENT_WORDS.names}
            for k in np.flatnonzero(np.diff(edges)).tolist():
                cut = slice(edges[k], edges[k + 1])
                out["block"].append(k)
                out["batch"].append(batch.number)
                out["words"].append(pack_sorted(tokens.words[cut]))
                out["counts"].append(pack(count[cut]))
            yield _rows(out, _SENT_WORDS)

    return table.mapInArrow(run, "block long, batch long, words binary, counts binary")


_FIELDS = [
    ("kind", pa.string()),
    ("block", pa.int64()),
    ("batch", pa.int64()),
    ("keys", pa.binary()),
    ("counts", pa.binary()),
    ("flags", pa.binary()),
    ("stats", pa.binary()),
    ("n", pa.int64()),
    ("n_r", pa.list_(pa.int64())),
]
_MODEL = pa.schema(_FIELDS)
_MODEL_SQL = (
    "kind string, block long, batch long, keys binary, counts binary, flags binary, stats binary, n long, n_r array<long>"
)


def _add(out: dict[str, list], **values) -> None:
    for name in _MODEL.names:
        out[name].append(values.get(name))


def _count_of_counts(count: np.ndarray) -> list[int]:
    return np.bincount(count[count <= CUT + 1], minlength=CUT + 2)[: CUT + 2].tolist()


def _add_words(sent: DataFrame) -> DataFrame:
    """The words of each block with their counts (kind `table`), and for each batch the rank in
    the block, from 1, and the count of each word that it sent (0: not in training)."""

    def run(group: pa.Table) -> pa.Table:
        each = [unpack_sorted(x.as_py()) for x in group.column("words")]
        words, back = np.unique(np.concatenate(each), return_inverse=True)
        sent_counts = np.concatenate([unpack(x.as_py()) for x in group.column("counts")])
        count = np.bincount(back, sent_counts, len(words)).astype(np.int64)
        rank = np.cumsum(count > 0) * (count > 0)
        out = {n: [] for n in _MODEL.names}
        block = group.column("block")[0].as_py()
        seen = count > 0
        _add(
            out,
            kind="table",
            block=block,
            keys=pack_sorted(words[seen]),
            counts=pack(count[seen].astype(np.uint64)),
            n=int(seen.sum()),
            n_r=[*_count_of_counts(count), int(count.sum())],
        )
        at = 0
        for batch, x in zip(group.column("batch").to_pylist(), each, strict=True):
            mine = back[at : at + len(x)]
            at += len(x)
            _add(
                out,
                kind="answer",
                block=block,
                batch=batch,
                keys=pack(rank[mine].astype(np.uint64)),
                counts=pack(count[mine].astype(np.uint64)),
            )
        return pa.table(out, schema=_MODEL)

    return sent.groupBy("block").applyInArrow(run, _MODEL_SQL)


def _known(tokens: Tokens, answers: list[dict], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Id (-1: not in training) and count of each distinct word of a batch."""
    ids = np.full(len(tokens.words), -1, np.int64)
    count = np.zeros(len(tokens.words), np.int64)
    bits = (len(words.first) - 1).bit_length() - 1
    edges = _edges((tokens.words >> np.uint64(64 - bits)).astype(np.int64), 1 << bits)
    for a in answers:
        cut = slice(edges[a["block"]], edges[a["block"] + 1])
        rank = unpack(a["keys"]).astype(np.int64)
        ids[cut] = np.where(rank > 0, words.first[a["block"]] + rank - 1, -1)
        count[cut] = unpack(a["counts"]).astype(np.int64)
    return ids, count


class Pairs:
    """The distinct pairs of a batch that a block must answer for, in order of block and pair."""

    def __init__(self, tokens: Tokens, ids: np.ndarray, count: np.ndarray, words: Words, n_docs: int, blocks: int, limit: float):
        token = tokens.token
        first = tokens.end - tokens.size
        self.w_id, self.w_count = ids[token], count[token]
        before = np.empty(len(token), np.int64)
        h_count = np.empty(len(token), np.int64)
        before[1:], h_count[1:] = self.w_id[:-1], self.w_count[:-1]
        before[first], h_count[first] = words.types, n_docs  # the start of a document
        self.h_count = np.where(before >= 0, h_count, 0)
        if n_docs == 0:
            self.h_count[first] = 0
        self.asked = self.h_count > 0
        key = before[self.asked].astype(np.uint64) << _32
        key |= np.where(self.w_id >= 0, self.w_id, _UNKNOWN)[self.asked].astype(np.uint64)
        del before, h_count
        key, back = np.unique(key, return_inverse=True)
        train = np.bincount(back, tokens.train[self.asked], len(key))
        own = np.zeros(len(key), np.int64)
        own[back] = self.h_count[self.asked]
        second = np.zeros(len(key), np.int64)
        second[back] = self.w_count[self.asked]
        pieces = np.maximum(1, np.ceil(own / limit)).astype(np.uint64)
        hot = pieces > 1
        mix = (key >> _32) * np.uint64(0x9E3779B97F4A7C15)
        mix = mix + np.where(hot, ((key & _LOW) * np.uint64(0xC2B2AE3D27D4EB4F) >> _32) % pieces, np.uint64(0)) * np.uint64(
            0x165667B19E3779F9
        )
        mix = (mix ^ (mix >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
        block = ((mix >> _32) % np.uint64(blocks)).astype(np.int64) + blocks * hot
        order = np.argsort(block, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.key, self.train, self.second = key[order], train[order].astype(np.uint64), second[order].astype(np.uint64)
        self.hot = hot[order]
        self.back = rank[back]
        self.edges = _edges(block[order], 2 * blocks)


_SENT_PAIRS = pa.schema(
    [("block", pa.int64()), ("batch", pa.int64())] + [(n, pa.binary()) for n in ("h", "w", "counts", "seconds")]
)


def _send_pairs(table: DataFrame, mod: int, words: Words, n_docs: int, blocks: int, limit: float) -> DataFrame:
    def run(parts):
        for row in rows_of(parts):
            batch = Batch(row)
            tokens = Tokens(batch, mod)
            ids, count = _known(tokens, row["answers"] or [], words)
            pairs = Pairs(tokens, ids, count, words, n_docs, blocks, limit)
            out = {n: [] for n in _SENT_PAIRS.names}
            for k in np.flatnonzero(np.diff(pairs.edges)).tolist():
                cut = slice(pairs.edges[k], pairs.edges[k + 1])
                out["block"].append(k)
                out["batch"].append(batch.number)
                out["h"].append(pack_sorted(pairs.key[cut] >> _32))
                out["w"].append(pack(pairs.key[cut] & _LOW))
                out["counts"].append(pack(pairs.train[cut]))
                out["seconds"].append(pack(pairs.second[cut]))
            yield _rows(out, _SENT_PAIRS)

    return table.mapInArrow(run, "block long, batch long, h binary, w binary, counts binary, seconds binary")


def _add_pairs(sent: DataFrame, words: Words, blocks: int) -> DataFrame:
    """Per block: its pairs with counts (kind `table`); sums of histories that are split (kind
    `split`); and for each batch the count of each pair that it sent, which low counts its history
    has, and for pairs not seen the sums of their history.

    The sums of a history are, per count r up to CUT, how many of its pairs occur r times, and
    the probability of the words seen after it."""

    def run(group: pa.Table) -> pa.Table:
        get = lambda name, f: [f(x.as_py()) for x in group.column(name)]
        h = get("h", unpack_sorted)
        size = [len(x) for x in h]
        key, back = np.unique((np.concatenate(h) << _32) | np.concatenate(get("w", unpack)), return_inverse=True)
        count = np.bincount(back, np.concatenate(get("counts", unpack)), len(key)).astype(np.int64)
        second = np.zeros(len(key), np.int64)
        second[back] = np.concatenate(get("seconds", unpack)).astype(np.int64)
        history, of = np.unique(key >> _32, return_inverse=True)
        low = np.zeros((CUT, len(history)), np.int64)
        for r in range(1, CUT + 1):
            low[r - 1] = np.bincount(of, count == r, len(history))
        mass = np.bincount(of, np.where(count > 0, words.prob(second), 0.0), len(history))
        which = (1 << np.arange(CUT)) @ (low > 0)  # bit r-1: some pair occurs r times
        out = {n: [] for n in _MODEL.names}
        block = group.column("block")[0].as_py()
        seen = count > 0
        _add(
            out,
            kind="table",
            block=block,
            keys=pack_sorted(key[seen]),
            counts=pack(count[seen].astype(np.uint64)),
            n=int(seen.sum()),
            n_r=_count_of_counts(count),
        )
        if block >= blocks:
            _add(out, kind="split", block=block, keys=pack_sorted(history), counts=pack(low.ravel().astype(np.uint64)), stats=mass.tobytes())
        at = 0
        for batch, n in zip(group.column("batch").to_pylist(), size, strict=True):
            mine = back[at : at + n]
            at += n
            c = count[mine]
            asked = np.unique(of[mine[c == 0]])
            _add(
                out,
                kind="answer",
                block=block,
                batch=batch,
                counts=pack(c.astype(np.uint64)),
                flags=pack(which[of[mine]].astype(np.uint64)),
                keys=pack(low[:, asked].ravel().astype(np.uint64)),
                stats=mass[asked].tobytes(),
            )
        return pa.table(out, schema=_MODEL)

    return sent.groupBy("block").applyInArrow(run, _MODEL_SQL)


def _left(low: np.ndarray, d: np.ndarray) -> np.ndarray:
    """What the discounts of a history take from its count."""
    return ((1 - d[1:]) * np.arange(1, CUT + 1)) @ low


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_())]
    + [(n, pa.int64()) for n in ("n_tokens", "n_known", "train_tokens")]
    + [("base_score", pa.float64()), ("score", pa.float64())]
)


def _score(table: DataFrame, mod: int, words: Words, n_docs: int, blocks: int, limit: float, d: np.ndarray, split: dict) -> DataFrame:
    """table: batches with `answers` on words and `pairs` on pairs."""

    def run(parts):
        for row in rows_of(parts):
            batch = Batch(row)
            tokens = Tokens(batch, mod)
            ids, count = _known(tokens, row["answers"] or [], words)
            p = Pairs(tokens, ids, count, words, n_docs, blocks, limit)
            c = np.zeros(len(p.key), np.int64)
            which = np.zeros(len(p.key), np.int64)
            low = np.zeros((CUT, len(p.key)))
            mass = np.zeros(len(p.key))
            for a in row["pairs"] or []:
                cut = slice(p.edges[a["block"]], p.edges[a["block"] + 1])
                c[cut] = unpack(a["counts"]).astype(np.int64)
                which[cut] = unpack(a["flags"]).astype(np.int64)
                none = np.flatnonzero(c[cut] == 0) + cut.start
                if len(none):
                    _, of = np.unique(p.key[none] >> _32, return_inverse=True)
                    low[:, none] = unpack(a["keys"]).reshape(CUT, -1)[:, of]
                    mass[none] = np.frombuffer(a["stats"])[of]
            for k in np.flatnonzero(p.hot).tolist():
                which[k], low[:, k], mass[k] = split[int(p.key[k] >> _32)]
            plain = which & ((1 << np.arange(CUT)) @ (d[1:] < 1)) == 0  # nothing is discounted
            log_word = np.log10(words.prob(p.w_count))
            log = log_word.copy()
            h = p.h_count[p.asked]
            back = p.back
            total = h + plain[back]
            seen = c[back]
            left = np.where(plain, 1.0, _left(low, d))[back] / total
            with np.errstate(divide="ignore"):
                pair = np.log10(np.where(seen <= CUT, d[np.minimum(seen, CUT)], 1.0) * seen / total)
                back_off = np.log10(left / (1 - mass[back]))
            log[p.asked] = np.where(seen > 0, pair, back_off + log_word[p.asked])
            base = np.log10((p.w_count + 0.1) / (words.n + 0.1 * (words.types + 1)))
            first = tokens.end - tokens.size
            n = len(tokens.size)
            yield _rows(
                {
                    "doc_id": [None if null else i for i, null in zip(batch.ids.tolist(), batch.null.tolist(), strict=True)],
                    "held_out": tokens.held,
                    "n_tokens": tokens.size,
                    "n_known": np.add.reduceat((p.w_count > 0).astype(np.int64), first),
                    "train_tokens": np.full(n, words.n),
                    "base_score": np.add.reduceat(base, first),
                    "score": np.add.reduceat(log, first),
                },
                _RESULT,
            )

    return table.mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _model_table(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """df, written partitioned by kind: (rows of the table and its sums, answers)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.partitionBy("kind").option("compression", "none").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return back.where("kind <> 'answer'"), back.where("kind = 'answer'")


def katz_scores(docs: DataFrame, held_out_mod: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add
    0.1 smoothed single words) and score (log10 probability of the text under the model).

    Documents whose crc32(doc_id as text) mod held_out_mod is 0 are scored but train nothing; a
    null id counts as empty text there. Null texts are empty: their only token is the end.
    Repeated rows count as often as they occur. If nothing trains, every token is the unknown word
    with probability 1. An empty table gives an empty result; other columns are ignored.
    """
    table = batches(docs, id_col, text_col)
    n = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()[0] // 5
    bits = max(3, int(n // BLOCK).bit_length())
    rows, word_answers = _model_table(_add_words(_send_words(table, held_out_mod, bits)), "katz-words")
    stats = {r["block"]: (r["n"], r["n_r"]) for r in rows.select("block", "n", "n_r").collect()}
    sizes = [stats[k][0] if k in stats else 0 for k in range(1 << bits)]
    sums = np.array([x for _, x in stats.values()] or [[0] * (CUT + 3)], np.int64).sum(axis=0)
    words = Words.of(int(sums[-1]), sizes, sums[:-1])
    held = (F.crc32(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).cast("binary")) % held_out_mod) == 0
    n_docs = docs.where(~held).count()
    blocks = 1 << bits
    limit = max(1.0, words.n / blocks)
    asked = answered(table, word_answers.select("batch", "block", "keys", "counts"))
    rows, pair_answers = _model_table(
        _add_pairs(_send_pairs(asked, held_out_mod, words, n_docs, blocks, limit), words, blocks), "katz-pairs"
    )
    sums = np.array([r[0] for r in rows.where("kind = 'table'").select("n_r").collect()] or [[0] * (CUT + 2)]).sum(axis=0)
    split: dict[int, list] = {}
    for r in rows.where("kind = 'split'").select("keys", "counts", "stats").collect():
        keys = unpack_sorted(r["keys"]).tolist()
        low = unpack(r["counts"]).reshape(CUT, -1).astype(np.float64)
        for i, (key, mass) in enumerate(zip(keys, np.frombuffer(r["stats"]).tolist(), strict=True)):
            old = split.setdefault(key, [0, np.zeros(CUT), 0.0])
            old[1], old[2] = old[1] + low[:, i], old[2] + mass
            old[0] = int((1 << np.arange(CUT)) @ (old[1] > 0))
    pairs = pair_answers.groupBy("batch").agg(
        F.collect_list(F.struct("block", "counts", "flags", "keys", "stats")).alias("pairs")
    )
    full = asked.join(pairs, "batch", "left")
    return _score(full, held_out_mod, words, n_docs, blocks, limit, discounts(sums), split)
