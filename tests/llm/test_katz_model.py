"""The table model against brute force at several orders, and against the pair operator."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadloom.llm import katz, katz_model
from leadloom.llm.katz import CUT, discounts

S, E = "<s>", "</s>"


class Brute:
    def __init__(self, texts, order):
        self.order = order
        self.counts = [Counter() for _ in range(order + 1)]
        for t in texts:
            p = [S] * (order - 1) + t.lower().split() + [E]
            for i in range(order - 1, len(p)):
                for n in range(1, order + 1):
                    self.counts[n][tuple(p[i - n + 1 : i + 1])] += 1
        self.d = [None]
        for n in range(1, order + 1):
            n_r = np.zeros(CUT + 2, np.int64)
            for c in self.counts[n].values():
                if c <= CUT + 1:
                    n_r[c] += 1
            self.d.append(discounts(n_r))
        self.after = [None] + [{} for _ in range(order)]
        for n in range(1, order + 1):
            for g, c in self.counts[n].items():
                self.after[n].setdefault(g[:-1], {})[g[-1]] = c

    def kept(self, n, c):
        return c * (self.d[n][c] if c <= CUT else 1.0)

    def p(self, h, w):
        n = len(h) + 1
        seen = self.after[n].get(h)
        if seen is None:
            return self.p(h[1:], w) if n > 1 else 1.0
        low = any(c <= CUT and self.d[n][c] < 1 for c in seen.values())
        total = sum(seen.values()) + (not low)
        if w in seen:
            return self.kept(n, seen[w]) / total
        left = 1 / total if not low else 1 - sum(self.kept(n, c) for c in seen.values()) / total
        if n == 1:
            return left
        return left / (1 - sum(self.p(h[1:], x) for x in seen)) * self.p(h[1:], w)

    def score(self, text):
        p = [S] * (self.order - 1) + text.lower().split() + [E]
        return sum(math.log10(self.p(tuple(p[i - self.order + 1 : i]), p[i])) for i in range(self.order - 1, len(p)))


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    words = [f"W{i}" for i in range(12)]
    weight = 1 / np.arange(1, 13)
    return [" ".join(rng.choice(words, int(rng.integers(0, 12)), p=weight / weight.sum())) for _ in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_brute_force(spark, tmp_path, order):
    texts, other = corpus(60, 1), [*corpus(20, 2), "w0 unknown w1", "", "a b c d"]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(n) for n in ("h", "w", "n", "digest", "p")})
    model = katz_model.fit(frame(list(enumerate(texts))).repartition(3), str(tmp_path / "m"), order)
    rows = [*enumerate(other), (7, other[0]), (None, None)]
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["n_tokens"], r["score"]) for r in model.score(frame(rows)).collect())
    brute = Brute(texts, order)
    want = sorted((-1 if i is None else i, len((t or "").split()) + 1, brute.score(t or "")) for i, t in rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want])
    # another session of the same tables gives the same
    again = katz_model.KatzModel(spark, str(tmp_path / "m"), order)
    assert again.score(frame(rows)).agg(F.sum("score")).first()[0] == pytest.approx(sum(w[2] for w in want))


def test_probabilities_after_a_history_sum_to_one(spark, tmp_path):
    texts = corpus(60, 1)
    model = katz_model.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), str(tmp_path / "m"), 3)
    words = [f"w{i}" for i in range(12)] + ["", "unknown"]
    histories = ["w0 w1", "w3 w0", "\t \t", "\t w2", "w11 w11", "unknown w0"]
    grams = spark.createDataFrame([(h, w) for h in histories for w in words], "h string, w string")
    sums = {}
    for r in model.log_probabilities(grams).collect():
        sums[r["h"]] = sums.get(r["h"], 0) + 10 ** r["log_p"]
    assert all(abs(sums[h] - 1) < 1e-9 for h in histories)


def test_order_two_is_the_pair_operator(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus(80, 3))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in katz.katz_scores(docs).collect()}
    train = docs.where(F.col("doc_id").isin([i for i, r in got.items() if not r["held_out"]]))
    model = katz_model.fit(train, str(tmp_path / "m"), 2)
    for r in model.score(docs).collect():
        assert r["n_tokens"] == got[r["doc_id"]]["n_tokens"]
        assert r["score"] == pytest.approx(got[r["doc_id"]]["score"])


def test_nothing_to_learn_from(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = katz_model.fit(docs.where("false"), str(tmp_path / "m"), 3)
    assert {r["score"] for r in model.score(docs).collect()} == {0.0}
    assert model.score(docs.where("false")).collect() == []


def test_a_higher_order_predicts_held_out_text_better(spark, tmp_path):
    rng = np.random.default_rng(4)
    # the next word depends on the two before it
    def text():
        w = [int(x) for x in rng.integers(0, 6, 2)]
        for _ in range(30):
            w.append((w[-1] * 2 + w[-2] * 3 + int(rng.random() < 0.1)) % 6)
        return " ".join(f"t{x}" for x in w)

    docs = spark.createDataFrame([(i, text()) for i in range(120)], "doc_id long, text string")
    total = {}
    for order in (2, 3):
        model = katz_model.fit(docs.where("doc_id < 100"), str(tmp_path / f"m{order}"), order)
        total[order] = model.score(docs.where("doc_id >= 100")).agg(F.sum("score")).first()[0]
    assert total[3] > total[2] * 0.7  # log probabilities are negative
