"""Document quality from weak labels.

Seven heuristics vote good, bad or nothing on each document. Expectation-maximisation over how
often each pattern of votes occurs estimates how each heuristic votes on good and on bad
documents, without any true label, and so the probability that a document is good given its
votes. Those probabilities train a logistic scorer over hashed features (shapes of words, of
pairs of neighbouring words, repetition), which then scores every document.

The pattern counts cover all documents; their number is at most 3 to the number of heuristics.
The scorer is fitted on a bounded sample, the `TRAIN_DOCS` documents with the smallest hash of
the text, so copies do not crowd it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from .common import need_columns, with_python, written

GOOD, BAD, NONE = 1, 0, 2
TRAIN_DOCS = 20_000
BUCKETS = 1 << 14
#: Documents of fewer words get no vote on repetition.
FEW = 20

_LETTERS = re.compile(r"[^\W\d_]+")
_SYMBOL = re.compile(r"[^\w\s.,]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")


@dataclass
class Figures:
    words: int
    symbols: float  # share of characters
    capitals: float  # share of letters
    repeats: float  # share of words equal to the word before
    top: float  # share of the commonest word
    variety: float  # share of distinct words
    lines: float  # share of lines that repeat another line
    n_lines: int
    length: float  # mean word length


def figures(text: str | None) -> Figures:
    text = text or ""
    words = text.split()
    n = max(len(words), 1)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = text.split("\n")
    letters = sum(map(len, _LETTERS.findall(text)))
    return Figures(
        len(words),
        len(_SYMBOL.findall(text)) / max(len(text), 1),
        sum(map(len, _UPPER.findall(text))) / max(letters, 1),
        sum(a == b for a, b in zip(words, words[1:])) / n,
        max(counts.values(), default=0) / n,
        len(counts) / n,
        1 - len(set(lines)) / len(lines),
        len(lines),
        sum(map(len, words)) / n,
    )


def _between(good: bool, bad: bool, applies: bool = True) -> int:
    return NONE if not applies else BAD if bad else GOOD if good else NONE


#: The heuristics. Each votes on what it can see and abstains between its limits.
HEURISTICS = {
    "symbols": lambda f: _between(f.symbols < 0.02, f.symbols > 0.05, f.words >= FEW),
    "capitals": lambda f: _between(f.capitals < 0.1, f.capitals > 0.3, f.words >= FEW),
    "repeats": lambda f: _between(f.repeats < 0.05, f.repeats > 0.15, f.words >= FEW),
    "top word": lambda f: _between(f.top < 0.12, f.top > 0.25, f.words >= FEW),
    "variety": lambda f: _between(f.variety > 0.5, f.variety < 0.3, f.words >= FEW),
    "lines": lambda f: _between(f.lines < 0.2, f.lines > 0.4, f.n_lines >= 3),
    "word length": lambda f: _between(4 <= f.length <= 6, f.length > 7.2 or f.length < 2.5, f.words >= FEW),
}


def votes(text: str | None) -> str:
    f = figures(text)
    return "".join(str(h(f)) for h in HEURISTICS.values())


@dataclass
class LabelModel:
    """share: of good documents; table: heuristics x class x vote, class 1 being good."""

    share: float
    table: np.ndarray

    def posterior(self, patterns: list[str]) -> np.ndarray:
        at = np.array([[int(c) for c in p] for p in patterns], np.int64).reshape(len(patterns), -1)
        log = np.log([[1 - self.share], [self.share]])
        each = np.log(self.table)
        total = log + sum(each[k][:, at[:, k]] for k in range(at.shape[1]))
        return 1 / (1 + np.exp(np.clip(total[0] - total[1], -700, 700)))


def fit_labels(counts: dict[str, int], rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over pattern counts, from the majority of the votes. Votes of
    nothing carry no information about the class by themselves: they weigh the same in both."""
    patterns = list(counts)
    n = np.array([counts[p] for p in patterns], np.float64)
    k = len(HEURISTICS)
    at = np.array([[int(c) for c in p] for p in patterns], np.int64).reshape(len(patterns), k)
    good, bad = (at == GOOD).sum(1), (at == BAD).sum(1)
    p = np.where(good + bad > 0, (good + 1) / (good + bad + 2), 0.75)
    model = LabelModel(0.75, np.full((k, 2, 3), 1 / 3))
    for _ in range(rounds):
        share = float(((n * p).sum() + 1) / (n.sum() + 2))
        table = np.empty((k, 2, 3))
        for h in range(k):
            for c, weight in ((0, n * (1 - p)), (1, n * p)):
                cast = np.bincount(at[:, h], weight, 3)[:2] + 0.5
                table[h, c, :2] = cast / cast.sum()
            table[h, :, NONE] = 1.0
        model = LabelModel(min(max(share, 1e-6), 1 - 1e-6), table)
        new = model.posterior(patterns) if patterns else p
        if np.abs(new - p).max(initial=0) < 1e-6:
            break
        p = new
    return model


_SHAPE = [
    (re.compile(r"[^\W\d_a-zà-öø-þß-ÿ]{2,}"), "A"),
    (re.compile(r"[a-zà-öø-þß-ÿ]+"), "a"),
    (re.compile(r"\d+"), "0"),
]
_RUN = re.compile(r"([^\w\s])\1+")


def shape(word: str) -> str:
    """Runs of capitals, small letters and digits as A, a, 0; repeated signs as two."""
    for pattern, to in _SHAPE:
        word = pattern.sub(to, word)
    return _RUN.sub(r"\1\1", word)


def features(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features (buckets, values) of each text; values are shares of its words."""
    known: dict[str, int] = {}
    out = []
    for t in texts:
        words = (t or "").split()
        for w in set(words).difference(known):
            known[w] = xxh32_intdigest(f"{shape(w)} {len(w)}")
        h = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        n = max(len(h), 1)
        pairs = (h[1:] * 31 + h[:-1]) % 1_000_003
        same = h[1:][np.array([a == b for a, b in zip(words, words[1:])], bool)] if n > 1 else h[:0]
        distinct = int(20 * len(set(words)) / n)
        every = np.concatenate([h, pairs, np.full(len(same), 7), np.full(n, 100 + distinct), np.full(n, 200 + min(n.bit_length(), 12))])
        bucket, count = np.unique(every % BUCKETS, return_counts=True)
        out.append((bucket, count / n))
    return out


@dataclass
class Scorer:
    weight: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        logit = [self.bias + float(self.weight[b] @ v) for b, v in features(texts)]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 15, seed: int = 1) -> Scorer:
    """Logistic regression on soft labels, by steps scaled with accumulated squares."""
    rng = np.random.default_rng(seed)
    share = min(max(float(target.mean()) if len(target) else 0.5, 1e-3), 1 - 1e-3)
    model = Scorer(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    squares = np.full(BUCKETS, 1e-2)
    for _ in range(epochs):
        for chosen in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)) if rows else ():
            size = [len(rows[i][0]) for i in chosen]
            bucket = np.concatenate([rows[i][0] for i in chosen])
            value = np.concatenate([rows[i][1] for i in chosen])
            doc = np.repeat(np.arange(len(chosen)), size)
            logit = np.bincount(doc, model.weight[bucket] * value, len(chosen)) + model.bias
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target[chosen]
            grad = np.bincount(bucket, error[doc] * value, BUCKETS) + 1e-4 * model.weight
            squares += grad**2
            model.weight -= 0.5 * grad / np.sqrt(squares)
            model.bias -= 0.05 * float(error.mean())
    return model


def fit(docs: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS) -> tuple[LabelModel, Scorer]:
    """The label model over all documents and the scorer over a bounded sample of them."""
    need_columns(docs, text_col)
    texts = docs.select(docs[text_col].alias("text"))
    voted = written(_voted(texts), "quality-votes")
    counts = dict(voted.groupBy("votes").count().collect())
    labels = fit_labels(counts)
    last = voted.select("h").distinct().orderBy("h").limit(train_docs).agg(F.max("h")).first()[0]
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    target: list[float] = []
    if last is not None:
        some = texts.where(F.xxhash64("text") <= last).dropDuplicates(["text"]).orderBy(F.xxhash64("text"), "text")
        schema = "votes string, bucket array<int>, value array<float>"

        def run(batches):
            for b in batches:
                part = b.column(0).to_pylist()
                found = features(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([votes(t) for t in part]),
                        pa.array([x.astype(np.int32) for x, _ in found], pa.list_(pa.int32())),
                        pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32())),
                    ],
                    ["votes", "bucket", "value"],
                )

        sample = some.mapInArrow(run, schema).toArrow()
        target = labels.posterior(sample.column("votes").to_pylist())
        rows = [
            (b.values.to_numpy(), v.values.to_numpy())
            for b, v in zip(sample.column("bucket"), sample.column("value"), strict=True)
        ]
    return labels, fit_scorer(rows, np.asarray(target, np.float64))


def _voted(texts: DataFrame) -> DataFrame:
    src = texts.select(F.xxhash64("text").alias("h"), "text")

    def run(batches):
        for b in batches:
            cast = pa.array([votes(t) for t in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), cast], ["h", "votes"])

    return src.mapInArrow(run, "h long, votes string")


def scored(docs: DataFrame, scorer: Scorer, text_col: str = "text") -> DataFrame:
    """(row, score): the documents, each as one struct, with the probability that it is good."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def func(columns):
        texts = columns[0].to_pylist()
        parts = [shared.value.score(texts[i : i + 1000]) for i in range(0, len(texts), 1000)]
        return [pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())]

    return with_python(docs, [text_col], func, "score double")


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, train_docs: int = TRAIN_DOCS
) -> DataFrame:
    """doc_id, score (the probability of good) and accepted for every row.

    Null texts and texts without words get no votes and the score of an empty text. Repeated
    rows count as often as they occur in the label model, once in the scorer. An empty table
    gives an empty result.
    """
    need_columns(docs, id_col, text_col)
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    _, scorer = fit(src, "text", train_docs)
    out = scored(src, scorer, "text")
    return out.select("row.doc_id", "score", (F.col("score") >= threshold).alias("accepted"))


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The documents, with all columns, that score at least the threshold."""
    _, scorer = fit(docs, text_col, train_docs)
    return scored(docs, scorer, text_col).where(F.col("score") >= threshold).select("row.*")
