"""Toxicity by bags of subwords: averaged embeddings into a linear softmax.

A word is its own hashed bucket and those of its character n-grams, so a misspelling shares
most buckets with the word it comes from. A run without separators is one word, hashed in full
however long it is. A passage is the mean of its distinct words' embeddings, and a
softmax over it gives the class; embeddings and softmax are trained together, by stochastic
gradient descent in numpy, on a bounded sample of labelled documents.

A label belongs to a whole document, while the words that earn it may stand in one place of a
long one. So documents are cut into passages of at most `PASSAGE` words, which overlap by half, a
document scores as its most suspicious passage does, and that passage also stands for it in each
round of training.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_bucket, need_columns

#: Labelled documents that train the model, at most: those with the smallest seeded hash.
TRAIN_DOCS = 4_000
#: Bytes of words that a training document has at most; longer ones train nothing. With TRAIN_DOCS
#: this bounds what the driver gets.
TRAIN_BYTES = 50_000
BUCKETS = 1 << 17
DIM = 8
#: What the sum of squared steps of a bucket starts from: rare buckets move little at first.
START = 1e-4
GRAMS = (3, 4, 5, 6, 7)
PASSAGE = 100
TEXTS = 2_000
#: Bytes of words whose subwords are hashed at once; a longer word is hashed in several turns.
BYTES = 200_000
#: Words without meaning that are added to each passage, so that a few words repeated do not pass for many.
PAD = 10

_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").lower().encode())


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(40)) & np.uint64(BUCKETS - 1)).astype(np.int32)


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word, one word after another, and how many each word has."""
    buckets, counts = [np.zeros(0, np.int32)], np.zeros(len(words), np.int64)
    for at, b, n in subword_runs(words):
        buckets.append(b)
        counts[at : at + len(n)] += n
    return np.concatenate(buckets), counts


def subword_runs(words: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of about BYTES bytes as (first word, buckets, buckets of each word); a word that is
    longer makes several runs."""
    first = size = 0
    for i, w in enumerate(words):
        if i > first and size + len(w) + 2 > BYTES:
            yield first, *_subwords(words[first:i])
            first, size = i, 0
        size += len(w) + 2
        if size > BYTES and i == first:
            for b in _long_word(w):
                yield i, b, np.array([len(b)])
            first, size = i + 1, 0
    if first < len(words):
        yield first, *_subwords(words[first:])


def _grams(flat: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The hash of the k bytes from each place on, for each k of GRAMS; the last k - 1 are not valid."""
    m = np.uint64(0x100000001B3)
    h = np.zeros(len(flat), np.uint64)
    for k in range(1, min(max(GRAMS), len(flat)) + 1):
        h[: len(flat) - k + 1] = h[: len(flat) - k + 1] * m + flat[k - 1 :] + np.uint64(1)
        if k in GRAMS:
            yield k, h


def _long_word(w: bytes) -> Iterator[np.ndarray]:
    """What _subwords finds in one word, from overlapping parts of it."""
    marked = np.frombuffer(b"<" + w + b">", np.uint8)
    m = 0x100000001B3
    power = np.cumprod(np.full(BYTES, m, np.uint64))
    whole = 0
    for s in range(0, len(marked), BYTES):
        flat = marked[s : s + BYTES + max(GRAMS) - 1].astype(np.uint64)
        own = flat[:BYTES]
        whole += int((own * power[: len(own)]).sum()) * pow(m, s, 1 << 64)
        for k, h in _grams(flat):
            yield _mix(h[: min(BYTES, len(flat) - k + 1)] + np.uint64(k << 56))
    yield _mix(np.array([whole % (1 << 64)], np.uint64) + np.uint64(255 << 56))


def _subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    marked = [b"<" + w + b">" for w in words]  # the whole word is one of the buckets, too
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    flat = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    start = np.cumsum(size) - size
    word = np.repeat(np.arange(len(marked), dtype=np.int32), size)
    at = np.arange(len(flat)) - start[word]
    power = np.cumprod(np.full(size.max(), 0x100000001B3, np.uint64))
    out_w = [np.arange(len(marked), dtype=np.int32)]
    out_b = [_mix(np.add.reduceat(flat * power[at], start) + np.uint64(255 << 56))]
    for k, h in _grams(flat):
        ok = np.flatnonzero(at + k <= size[word])
        out_w.append(word[ok])
        out_b.append(_mix(h[ok] + np.uint64(k << 56)))
    word = np.concatenate(out_w)
    return np.concatenate(out_b)[np.argsort(word, kind="stable")], np.bincount(word)


@dataclass
class Model:
    embed: np.ndarray  # buckets x dim
    out: np.ndarray  # dim: weight of class 1 less that of class 0
    bias: float

    def word_logits(self, words: list[bytes]) -> np.ndarray:
        """What a word adds to the logit of its passage: the model is linear after the mean."""
        value = self.embed @ self.out
        total, size = np.zeros(len(words)), np.zeros(len(words))
        for at, bucket, n in subword_runs(words):
            total[at : at + len(n)] += np.add.reduceat(value[bucket], np.cumsum(n) - n)
            size[at : at + len(n)] += n
        return total / size


def passages(at: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (passage, word) pairs of a text. Passages are of even size, PASSAGE at most, and
    overlap by half, so that a run of words on the border of one lies inside another."""
    n = len(at)
    k = -(-n // PASSAGE)
    if k > 1:
        # a passage is two neighbouring halves
        half = np.arange(n) * 2 * k // n
        pairs = np.concatenate([(half * n_words + at)[half < 2 * k - 1], ((half - 1) * n_words + at)[half > 0]])
    else:
        pairs = at
    pairs = np.unique(pairs)
    return pairs // n_words, pairs % n_words


def passage_logits(value: np.ndarray, passage: np.ndarray, word: np.ndarray) -> np.ndarray:
    return np.bincount(passage, value[word]) / (np.bincount(passage) + PAD)


def train(rows: list[tuple[str | None, int]], epochs: int = 12, rate: float = 0.5, seed: int = 1) -> Model:
    """The model from (text, label) rows; without both labels it knows only the base rate."""
    return train_words([(words_of(t), y) for t, y in rows], epochs, rate, seed)


def train_words(rows: list[tuple[list[bytes], int]], epochs: int = 12, rate: float = 0.5, seed: int = 1) -> Model:
    """The same from the words of the texts."""
    rng = np.random.default_rng(seed)
    label = np.array([y for _, y in rows], np.float64)
    model = Model(rng.normal(0, 0.1, (BUCKETS, DIM)), rng.normal(0, 0.1, DIM), 0.0)
    share = (label.sum() + 1) / (len(label) + 2)
    model.bias = float(np.log(share / (1 - share)))
    known: dict[bytes, int] = {}
    docs = []
    for words, _ in rows:
        for w in set(words).difference(known):
            known[w] = len(known)
        docs.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    filled = np.flatnonzero([len(x) > 0 for x in docs])
    label, docs = label[filled], [passages(docs[i], len(known)) for i in filled]
    if len(set(label.tolist())) < 2:
        model.out[:] = 0
        return model
    bucket, grams = subwords(list(known))
    known.clear()
    first = np.cumsum(grams) - grams
    squares, squares_out = np.full(BUCKETS, START), 1e-8
    for _ in range(epochs):
        value = (model.embed @ model.out)[bucket]
        value = np.add.reduceat(value, first) / grams
        parts = [w[p == passage_logits(value, p, w).argmax()] for p, w in docs]
        for chosen in np.array_split(rng.permutation(len(parts)), max(1, len(parts) // 48)):
            n_words = np.array([len(parts[i]) for i in chosen])
            size = n_words + PAD
            some, back = np.unique(np.concatenate([parts[i] for i in chosen]), return_inverse=True)
            doc = np.repeat(np.arange(len(chosen)), n_words)
            n = grams[some]
            b = bucket[np.repeat(first[some] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            w = np.repeat(np.arange(len(some)), n)
            mean = np.empty((len(chosen), DIM))
            for k in range(DIM):
                vector = np.bincount(w, model.embed[b, k], len(some)) / n
                mean[:, k] = np.bincount(doc, vector[back], len(chosen)) / size
            p = 1 / (1 + np.exp(-np.clip(mean @ model.out + model.bias, -30, 30)))
            error = p - label[chosen]
            per_word = np.bincount(back, (error / size)[doc], len(some)) / n
            pull = np.bincount(b, per_word[w], BUCKETS)
            used = np.flatnonzero(pull)
            # steps by accumulated squares, per bucket and for the softmax
            grad = pull[used, None] * model.out
            squares[used] += (grad**2).mean(axis=1)
            g_out = error @ mean
            model.embed[used] -= rate * grad / np.sqrt(squares[used])[:, None]
            squares_out += float((g_out**2).mean())
            model.out -= rate * g_out / np.sqrt(squares_out)
            model.bias -= 0.02 * float(error.sum()) / len(chosen) ** 0.5
    return model


def score_texts(model: Model, texts: list[str | None]) -> np.ndarray:
    known: dict[bytes, int] = {}
    docs = []
    for t in texts:
        words = words_of(t)
        for w in set(words).difference(known):
            known[w] = len(known)
        docs.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    value = model.word_logits(list(known)) if known else np.zeros(0)
    out = np.empty(len(texts))
    for i, at in enumerate(docs):
        if not len(at):
            out[i] = model.bias
            continue
        out[i] = model.bias + passage_logits(value, *passages(at, len(known))).max()
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _sample(src: DataFrame, ids: list[int]) -> DataFrame:
    """(doc_id, words) of the training documents, one row per id, at most TRAIN_BYTES each."""

    def run(batches):
        for b in batches:
            words = [b" ".join(words_of(t.as_py())) for t in b.column(1)]
            short = [w if 0 < len(w) <= TRAIN_BYTES else None for w in words]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(short, pa.binary())], ["doc_id", "words"])

    some = src.where(F.col("doc_id").isin(ids) if ids else F.lit(False))
    found = some.mapInArrow(run, "doc_id long, words binary").where("words is not null")
    return found.groupBy("doc_id").agg(F.min("words").alias("words")).orderBy("doc_id")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = 0.3,
    train_docs: int = TRAIN_DOCS,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs.

    Labelled rows whose crc32(doc_id) mod 4 is 2 (held out) train nothing; of the others the
    `train_docs` with the smallest seeded hash do, half of them of each label if there are
    enough, and the base rate is put right afterwards. Null texts and texts without words score
    the base rate, as do all texts where the labels show but one class. Rows with a null label or
    without a text train nothing, nor do texts of more than TRAIN_BYTES of words. An id counts
    once: its label is 1 if any of its label rows says so, and of several texts the one whose
    words come first trains.
    """
    need_columns(docs, id_col, text_col)
    marked = labels.select(labels[id_col].cast("long").alias("_id"), labels[label_col].cast("int").alias("_y"))
    marked = marked.where("_id is not null and _y in (0, 1)").groupBy("_id").agg(F.max("_y").alias("_y"))
    marked = marked.where(id_bucket(F.col("_id"), 4) != 2)
    counts = dict(marked.groupBy("_y").count().collect())
    order = F.xxhash64(F.lit(17), "_id")
    chosen = None
    for y in (0, 1):
        some = marked.where(F.col("_y") == y).orderBy(order, "_id").limit(train_docs // 2)
        chosen = some if chosen is None else chosen.union(some)
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    ids = {r[0]: r[1] for r in chosen.collect()}
    rows = [(bytes(r[1]).split(), ids[r[0]]) for r in _sample(src, list(ids)).collect()]
    model = train_words(rows)
    if rows and len(counts) == 2:
        # the classes were drawn evenly; the base rate of all labels is put back
        drawn = sum(y for _, y in rows) / len(rows)
        share = counts[1] / (counts[0] + counts[1])
        if 0 < drawn < 1:
            model.bias += float(np.log(share / (1 - share)) - np.log(drawn / (1 - drawn)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for start in range(0, b.num_rows, TEXTS):
                part = b.slice(start, TEXTS)
                score = score_texts(shared.value, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], ["doc_id", "score"])

    out = src.mapInArrow(run, "doc_id long, score double")
    return out.select(
        "doc_id",
        (id_bucket(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
