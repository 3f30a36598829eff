"""What the trained operators reach on documents that train nothing."""

import collections
import math
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from leadloom.llm import katz, queries

SF = "/root/testdata/sf0.001"


def brute(docs, mod=10):
    """Scores under the model, written with dictionaries, and the sums of all distributions."""
    tokens = {d["doc_id"]: [*(d["text"] or "").encode().lower().split(), None] for d in docs}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % mod]
    one = collections.Counter(w for i in train for w in tokens[i])
    two, after = collections.Counter(), collections.defaultdict(set)
    for i in train:
        for h, w in zip(["<s>", *tokens[i][:-1]], tokens[i], strict=True):
            two[h, w] += 1
            after[h].add(w)
    n_r = lambda c: np.array([sum(1 for v in c.values() if v == r) for r in range(katz.CUT + 2)])
    d1, d2 = katz.discounts(n_r(one)), katz.discounts(n_r(two))
    cut = lambda d, c: d[c] if c <= katz.CUT else 1.0
    n = sum(one.values())
    unknown = 1 - sum(cut(d1, c) * c / n for c in one.values())
    word = lambda w: cut(d1, one[w]) * one[w] / n if w in one else unknown
    history = {}
    for h, ws in after.items():
        total = sum(two[h, w] for w in ws)
        total += all(cut(d2, two[h, w]) == 1 for w in ws)
        seen = {w: cut(d2, two[h, w]) * two[h, w] / total for w in ws}
        history[h] = seen, (1 - sum(seen.values())) / (1 - sum(map(word, ws)))

    def prob(h, w):
        if h not in history:
            return word(w)
        seen, alpha = history[h]
        return seen[w] if w in seen else alpha * word(w)

    scores = {
        i: sum(math.log10(prob(h, w)) for h, w in zip(["<s>", *t[:-1]], t, strict=True)) for i, t in tokens.items()
    }
    sums = [sum(prob(h, w) for w in one) + prob(h, b"\0none") for h in list(history)[:40]]
    return scores, sums


@pytest.mark.parametrize("block", [2_000_000, 3_000])
def test_katz(spark, monkeypatch, block):
    """In one block, and with histories split over many."""
    monkeypatch.setattr(katz, "BLOCK", block)
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    want, sums = brute(docs)
    assert np.allclose(sums, 1)
    df = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    got = {r["doc_id"]: r for r in katz.katz_scores(df).collect()}
    assert len(got) == len(docs)
    for i, s in want.items():
        assert got[i]["score"] == pytest.approx(s, rel=1e-9)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_toxicity_on_held_out_documents(spark):
    """The area under the curve at sf0.1, where some 330 labelled toxic documents train."""
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_toxicity"](spark, sf).collect()}
    labels = pq.read_table(f"{sf}/labels.parquet").to_pylist()
    held = [(got[r["doc_id"]]["score"], r["toxic"]) for r in labels if got[r["doc_id"]]["held_out"]]
    good = [s for s, y in held if not y]
    bad = [s for s, y in held if y]
    area = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert area > 0.85
