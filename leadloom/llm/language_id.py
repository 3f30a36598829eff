"""Language identification by unigrams over all segmentations of a word.

A fixed public vocabulary of byte sequences gives the pieces. Per language each piece has a
probability, and the probability of a word is the sum, over all ways to cut it into pieces, of
the product of their probabilities: a forward algorithm over byte positions. Texts are lower-
cased and cut at ASCII white space; each word carries a leading space. All pieces of the vocabulary
count, and words are summed whole: those of up to `SHORT` bytes in plain numbers, which cannot
underflow so soon, longer ones in logarithms.

Probabilities start from how often a piece occurs anywhere in a language's words and are then
re-estimated by expectation-maximisation, with expected counts from forward and backward sums.
The counts are sums per language and piece, so what reaches the driver is bounded by the
vocabulary times the number of languages. A language with more than `TRAIN_DOCS` training
documents is learned from about that many, those with the smallest hash of id and text; every
text is scored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_bucket, need_columns

#: Bytes of a word, its space included, up to which its sums are plain numbers: 24 factors of at
#: least 10^-12 stay above the smallest double.
SHORT = 24
#: Cells of a table of sums that are in memory at once, a single long word apart.
CELLS = 4_000_000
#: Expected count that every piece has besides what was counted.
SMOOTH = 0.01
#: Training documents per language, about, at most.
TRAIN_DOCS = 10_000
#: Words that are segmented at once.
BATCH = 16_384
#: Texts whose words are counted together.
TEXTS = 10_000


class Pieces:
    """The vocabulary as a trie: states, and the piece that ends in a state (-1: none)."""

    def __init__(self, path: str):
        pieces = [base64.b64decode(line.split()[0]) for line in open(path, "rb") if line.strip()]
        pieces += [bytes([b]) for b in range(256) if bytes([b]) not in set(pieces)]
        self.n = len(pieces)
        self.longest = max(map(len, pieces))
        state = {b"": 0}
        for p in pieces:
            for k in range(1, len(p) + 1):
                state.setdefault(p[:k], len(state))
        self.ends = np.full(len(state) + 1, -1, np.int32)
        for i, p in enumerate(pieces):
            self.ends[state[p]] = i
        keys = sorted((state[p[:-1]] << 8 | p[-1], s) for p, s in state.items() if p)
        # an open-addressing table of (state, byte) -> next state
        bits = int(np.ceil(np.log2(len(keys) * 4)))
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.key = np.full(1 << bits, -1, np.int64)
        self.value = np.full(1 << bits, len(state), np.int32)  # the last state is a dead end
        slots = self._slot(np.array([k for k, _ in keys], np.int64))
        for (k, s), at in zip(keys, slots.tolist(), strict=True):
            while self.key[at] >= 0:
                at = (at + 1) & self.mask
            self.key[at], self.value[at] = k, s
        self.dead = len(state)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The states after a byte each."""
        key = state.astype(np.int64) << 8 | byte
        at = self._slot(key)
        out = np.full(len(key), self.dead, np.int32)
        left = np.arange(len(key))
        while len(left):
            there = self.key[at]
            good = there == key
            out[left[good]] = self.value[at[good]]
            more = ~good & (there >= 0)
            left, key, at = left[more], key[more], (at[more] + 1) & self.mask
        return out

    def spans(self, words: list[bytes]):
        """Occurrences of pieces in words: for each length k, (word, start, piece) arrays."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        word = np.repeat(np.arange(len(words)), size)
        at = np.arange(len(flat)) - start[word]
        state = np.zeros(len(flat), np.int32)
        place = np.arange(len(flat))
        out = []
        for k in range(1, self.longest + 1):
            inside = at[place] + k <= size[word[place]]
            place, state = place[inside], state[inside]
            state = self.step(state, flat[place + k - 1])
            alive = state != self.dead
            place, state = place[alive], state[alive]
            if not len(place):
                break
            piece = self.ends[state]
            ok = piece >= 0
            out.append((k, word[place[ok]], at[place[ok]], piece[ok]))
        return size, out


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def _grouped(size: np.ndarray, spans, by_start: bool = False):
    """The spans ordered by where they end (or start), and the edges of each position."""
    k = np.concatenate([np.full(len(w), k, np.int64) for k, w, _, _ in spans])
    word, at, piece = (np.concatenate([s[i] for s in spans]) for i in (1, 2, 3))
    end = at + k
    key = at if by_start else end
    if int(size.max()) < 128:
        key = key.astype(np.int8)  # sorted by counting
    order = np.argsort(key, kind="stable")
    edges = np.searchsorted(key[order], np.arange(int(size.max()) + 2))
    return word[order], at[order], piece[order], end[order], edges


def forward(size: np.ndarray, grouped, prob: np.ndarray) -> np.ndarray:
    """Forward sums, positions x languages x words; prob is languages x pieces."""
    word, at, piece, _, edges = grouped
    table = np.zeros((int(size.max()) + 1, len(prob), len(size)))
    table[0] = 1.0
    for j in range(1, len(table)):
        cut = slice(edges[j], edges[j + 1])
        w, a, p = word[cut], at[cut], piece[cut]
        for k in range(len(prob)):
            table[j, k] = np.bincount(w, table[a, k, w] * prob[k][p], len(size))
    return table


def backward(size: np.ndarray, grouped, prob: np.ndarray) -> np.ndarray:
    """Backward sums in the same form, from spans ordered by start."""
    word, _, piece, end, edges = grouped
    words = np.arange(len(size))
    table = np.zeros((int(size.max()) + 1, len(prob), len(size)))
    for k in range(len(prob)):
        table[size, k, words] = 1.0
    for j in range(len(table) - 2, -1, -1):
        cut = slice(edges[j], edges[j + 1])
        w, e, p = word[cut], end[cut], piece[cut]
        for k in range(len(prob)):
            table[j, k] += np.bincount(w, table[e, k, w] * prob[k][p], len(size))
    return table


def _log_sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Logarithms of the sums of exponentials of runs of rows."""
    most = np.maximum.reduceat(values, edges)
    run = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(values))))
    return most + np.log(np.add.reduceat(np.exp(values - most[run]), edges))


def _log_steps(size: np.ndarray, spans, by_start: bool):
    """Per position, in the order of the algorithm: the position, the words (one per run of spans),
    the runs' edges, and for each span the word, the position it comes from and its piece."""
    word, at, piece, end, edges = _grouped(size, spans, by_start)
    here, there = (at, end) if by_start else (end, at)
    places = range(len(edges) - 3, -1, -1) if by_start else range(1, len(edges) - 1)
    for j in places:
        cut = np.arange(edges[j], edges[j + 1])
        cut = cut[np.argsort(word[cut], kind="stable")]
        w = word[cut]
        first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else w
        if len(w):
            yield j, w[first], first, w, there[cut], piece[cut]


def log_forward(size: np.ndarray, spans, log_prob: np.ndarray, rows: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of forward sums, positions x words x languages, and those of whole words. With
    `rows`, at least one more than the longest piece, only so many positions are kept."""
    n = int(size.max()) + 1 if rows is None else rows
    table = np.zeros((n, len(size), len(log_prob)))
    whole = np.zeros((len(size), len(log_prob)))
    for j, words, first, w, start, piece in _log_steps(size, spans, False):
        new = _log_sums(table[start % n, w] + log_prob.T[piece], first)
        table[j % n, words] = new
        done = size[words] == j
        whole[words[done]] = new[done]
    return table, whole


def log_backward(size: np.ndarray, spans, log_prob: np.ndarray) -> np.ndarray:
    table = np.zeros((int(size.max()) + 1, len(size), len(log_prob)))
    for j, words, first, w, end, piece in _log_steps(size, spans, True):
        table[j, words] = _log_sums(table[end, w] + log_prob.T[piece], first)
    return table


def _batches_of(words: list[bytes], n_langs: int):
    """Numbers of the words in batches, short ones first, each with whether it is of short ones.
    Words of like length are together; a batch's full table has CELLS cells or one word."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    short = np.flatnonzero(size <= SHORT)
    for i in range(0, len(short), BATCH):
        yield short[i : i + BATCH], True
    long = np.flatnonzero(size > SHORT)
    long = long[np.argsort(size[long], kind="stable")]
    i = 0
    while i < len(long):
        # words ascend in length, so the last one of a batch decides the table's height
        cells = (size[long[i : i + BATCH]] + 1) * n_langs * np.arange(1, min(BATCH, len(long) - i) + 1)
        n = max(1, int(np.searchsorted(cells, CELLS, side="right")))
        yield long[i : i + n], False
        i += n


def expected(pieces: Pieces, words: list[bytes], counts: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Expected counts of pieces (languages x pieces) for words that occur counts times."""
    out = np.zeros(prob.shape)
    log_prob = np.log(prob)
    for some, short in _batches_of(words, len(prob)):
        size, spans = pieces.spans([words[i] for i in some.tolist()])
        times = counts[:, some]
        if short:
            ahead = forward(size, _grouped(size, spans), prob)
            by_start = _grouped(size, spans, by_start=True)
            behind = backward(size, by_start, prob)
            word, at, piece, end, _ = by_start
            for k in range(len(prob)):
                scale = times[k] / behind[0, k]
                weight = ahead[at, k, word] * behind[end, k, word] * prob[k][piece] * scale[word]
                out[k] += np.bincount(piece, weight, pieces.n)
            continue
        ahead, whole = log_forward(size, spans, log_prob)
        behind = log_backward(size, spans, log_prob)
        word, at, piece, end, _ = _grouped(size, spans)
        for k in range(len(prob)):
            share = np.exp(ahead[at, word, k] + behind[end, word, k] + log_prob[k][piece] - whole[word, k])
            out[k] += np.bincount(piece, share * times[k][word], pieces.n)
    return out


def word_scores(pieces: Pieces, words: list[bytes], prob: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language (words x languages)."""
    out = np.empty((len(words), len(prob)))
    log_prob = np.log(prob)
    for some, short in _batches_of(words, len(prob)):
        size, spans = pieces.spans([words[i] for i in some.tolist()])
        if short:
            table = forward(size, _grouped(size, spans), prob)
            out[some] = np.log(table[size, :, np.arange(len(size))])
        else:
            out[some] = log_forward(size, spans, log_prob, pieces.longest + 1)[1]
    return out


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words."""
    return (text or "").lower().encode().split()


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _numbered(texts: list[str | None]) -> tuple[list[bytes], list[np.ndarray]]:
    """Distinct words of a batch, each with its space, and the word numbers of each text."""
    known: dict[bytes, int] = {}
    out = []
    for t in texts:
        words = words_of(t)
        for w in set(words).difference(known):
            known[w] = len(known)
        out.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    return [b" " + w for w in known], out


def _counts(rows: DataFrame, langs: list[str], path: str, prob: np.ndarray | None) -> np.ndarray:
    """Piece counts (languages x pieces) over the training rows (text, lang)."""
    index = {x: i for i, x in enumerate(langs)}

    def run(batches):
        pieces = pieces_of(path)
        total = np.zeros((len(langs), pieces.n))
        for b in batches:
            lang = b.column("lang").to_pylist()
            for start in range(0, b.num_rows, TEXTS):
                words, numbers = _numbered(b.column("text").slice(start, TEXTS).to_pylist())
                if not words:
                    continue
                count = np.zeros((len(langs), len(words)))
                for x, at in zip(lang[start:], numbers):
                    count[index[x]] += np.bincount(at, minlength=len(words)) if len(at) else 0
                if prob is None:
                    for some, _ in _batches_of(words, len(langs)):
                        _, spans = pieces.spans([words[i] for i in some.tolist()])
                        for _, w, _, piece in spans:
                            for k in range(len(langs)):
                                total[k] += np.bincount(piece, count[k, some[w]], pieces.n)
                else:
                    total += expected(pieces, words, count, prob)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["cell", "n"])

    sums = rows.mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(pieces_of(path).n * len(langs))
    out[sums["cell"].to_numpy(np.int64)] = sums["n"]
    return out.reshape(len(langs), -1)


def train(rows: DataFrame, path: str, rounds: int = 1, train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities from rows (text, lang and, if they have ids, doc_id: copies
    of a text are then sampled one by one); a null lang does not train."""
    rows = rows.where("lang is not null and text is not null")
    seed = F.xxhash64("doc_id", "text") if "doc_id" in rows.columns else F.xxhash64("text")
    counts = dict(rows.groupBy("lang").count().collect())
    langs = sorted(counts)
    if not langs:
        return [], np.zeros((0, 0))
    share = F.lit(1.0)
    for lang, n in counts.items():
        if n > train_docs:
            share = F.when(F.col("lang") == lang, train_docs / n).otherwise(share)
    rows = rows.where(F.pmod(seed, F.lit(1 << 30)) < share * (1 << 30)).select("text", "lang")
    prob = None
    for _ in range(rounds + 1):
        count = _counts(rows, langs, path, prob) + SMOOTH
        prob = count / count.sum(axis=1, keepdims=True)
    return langs, prob


def identify(
    docs: DataFrame, path: str, langs: list[str], prob: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, lang_pred, score) per row; score is the posterior of the predicted language
    under equal priors. Texts that are null or without letters, and all texts if nothing was
    learned, are `und` with score 0. Ties go to the first language in order."""
    need_columns(docs, id_col, text_col)

    def run(batches):
        pieces = pieces_of(path)
        for b in batches:
            for start in range(0, b.num_rows, TEXTS):
                part = b.slice(start, TEXTS)
                texts = part.column(1).to_pylist()
                words, numbers = _numbered(texts)
                score = word_scores(pieces, words, prob) if words and langs else None
                pred, sure = [], []
                for t, at in zip(texts, numbers, strict=True):
                    if not langs or not has_letter(t):
                        pred.append("und")
                        sure.append(0.0)
                        continue
                    total = score[at].sum(axis=0)
                    best = int(total.argmax())
                    pred.append(langs[best])
                    sure.append(float(1 / np.exp(np.maximum(total - total[best], -700)).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(pred), pa.array(sure, pa.float64())], ["doc_id", "lang_pred", "score"]
                )

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(
    docs: DataFrame,
    path: str,
    rounds: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train_docs: int = TRAIN_DOCS,
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row. Rows with a null language or whose
    crc32(doc_id) mod 3 is 1 (held out) train nothing; of the others, about `train_docs` per
    language do. Repeated rows count as often as they occur. An empty table gives an empty result."""
    need_columns(docs, lang_col)
    held = id_bucket(docs[id_col], 3) == 1
    rows = docs.where(~held).select(
        docs[id_col].cast("string").alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang")
    )
    langs, prob = train(rows, path, rounds, train_docs)
    out = identify(docs, path, langs, prob, id_col, text_col)
    return out.select("doc_id", (id_bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
