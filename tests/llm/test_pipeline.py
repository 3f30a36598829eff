"""The pipeline, and the operators that SQL expresses, against brute force and SQL."""

import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

import corpus_pipeline
from check_oracle import TABLES, compare
from leadloom.llm import quality, queries, token_files

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    text, ok = compare(spark, con, SF, name)
    assert ok, text


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    k = min(4, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)] if k else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def one_per_group(docs):
    fps = {d["doc_id"]: fingerprint(d["text"]) for d in docs}
    group = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i, f in fps.items():
            low = min(group[j] for j, g in fps.items() if (f ^ g).bit_count() <= 4)
            changed |= low < group[i]
            group[i] = low
    return [d for d in docs if group[d["doc_id"]] == d["doc_id"]]


def clean(docs):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    windows = set()
    for item in pq.read_table(f"{SF}/benchmark.parquet").to_pylist():
        w = words(item["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def hit(d):
        w = words(d["text"])
        return any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    return [d for d in docs if not hit(d)]


def fill(children, budget):
    """children: key -> (weight, cap); each gets its share, shortages go to the others."""
    given, rest = {}, dict(children)
    while rest:
        left = budget - sum(given.values())
        total = sum(w for w, _ in rest.values())
        short = {k: c for k, (w, c) in rest.items() if c <= left * w / total + 1e-9}
        if not short:
            return given | {k: left * w / total for k, (w, _) in rest.items()}
        first = min(short, key=lambda k: rest[k][1] / rest[k][0])
        given[first] = rest.pop(first)[1]
    return given


def mixed(docs):
    def path(d):
        n = int(re.search(r"([0-9]+)$", d["source"])[1])
        return "web" if n < 9 else "books" if n < 15 else "forum", d["lang"], d["source"]

    def key(d):
        import hashlib

        return hashlib.md5(f"{queries.MIX_SEED}:0:{d['doc_id']}".encode()).hexdigest()

    size = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"])) for d in docs}
    leaves = {}
    for d in docs:
        leaves.setdefault(path(d), []).append(d)
    cap = lambda p: sum(size[d["doc_id"]] for q, ds in leaves.items() if q[: len(p)] == p for d in ds)
    weight = lambda p: queries.MIX_WEIGHTS.get(p, 1.0)
    budgets = {(): float(int(cap(()) * corpus_pipeline.MIX_BUDGET))}
    for depth in (1, 2, 3):
        for parent in [p for p in budgets if len(p) == depth - 1]:
            kids = {q[:depth] for q in leaves if q[: depth - 1] == parent}
            budgets |= fill({k: (weight(k), cap(k)) for k in kids}, budgets[parent])
    out = []
    for p, ds in leaves.items():
        used, target = 0, int(round(budgets[p], 6))
        for d in sorted(ds, key=key):
            used += size[d["doc_id"]]
            if used > target:
                break
            out.append(d)
    return out


def test_pipeline_stage_by_stage(spark):
    """Each stage on what its predecessor kept, against brute force; then the whole."""
    from tokenizers import Tokenizer

    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    ids = lambda rows: sorted(r["doc_id"] for r in rows)
    stages = dict(corpus_pipeline.STAGES)

    def run(name, rows):
        df = spark.createDataFrame([tuple(d[f.name] for f in schema) for d in rows], schema)
        out = stages[name](spark, df, SF)
        assert out.columns == schema.names or name == "token files"
        return out.collect()

    _, scorer = quality.fit(spark.createDataFrame([tuple(d[f.name] for f in schema) for d in docs], schema))
    good = [d for d, s in zip(docs, scorer.score([d["text"] for d in docs]), strict=True) if s >= 0.5]
    assert ids(run("quality classifier", docs)) == ids(good)
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    kept = set(ids(good))
    assert sum(i in kept for i, q in labels.items() if q) >= 0.97 * sum(labels.values())

    alone = one_per_group(good)
    assert ids(run("SimHash near-dedup", good)) == ids(alone) and len(alone) < len(good)
    untouched = clean(alone)
    assert ids(run("benchmark decontamination", alone)) == ids(untouched) and len(untouched) < len(alone)
    mix = mixed(untouched)
    assert ids(run("mixing sources", untouched)) == ids(mix) and len(mix) < len(untouched)

    tok = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    want, start = [], 0
    for d in sorted(mix, key=lambda d: d["doc_id"]):
        t = np.array([*tok.encode(d["text"], add_special_tokens=False).ids, 2], "<u4")
        want.append((d["doc_id"], start, len(t), zlib.crc32(t.tobytes())))
        start += len(t)
    assert sorted(tuple(r) for r in run("token files", mix)) == want
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == want


def test_texts_travel_once_and_are_encoded_in_small_parts(spark):
    """Workers and Arrow buffers of all stages share an executor's memory."""
    docs = spark.createDataFrame([(1, "Some words here.", "en"), (2, None, None), (3, "", "de")], "doc_id long, text string, lang string")
    out = quality.scored(docs, quality.fit_scorer([], np.zeros(0)))
    sent = out._jdf.queryExecution().analyzed().children().head().output()
    assert sent.length() == 1  # the row, and no second copy of its text
    want = [float(quality.fit_scorer([], np.zeros(0)).score([t])[0]) for t in ("Some words here.", None, "")]
    assert [tuple(r.row) for r in out.collect()] == [tuple(r) for r in docs.collect()]
    assert [r.score for r in out.collect()] == want
    batch = pa.record_batch([pa.array(range(100)), pa.array(["word " * 20_000] * 100)], ["doc_id", "text"])
    parts = list(token_files._parts(batch))
    assert [i for ids, _ in parts for i in ids] == list(range(100))
    assert max(sum(map(len, texts)) for _, texts in parts) <= 4_200_000


def test_remembered_words_take_little_memory(monkeypatch):
    """Two workers remember words beside an executor's heap, on text that hardly repeats them as well."""
    encode = token_files.Encoder(queries.tokenizer_path("byte_bpe_50k.json"))
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghij"))
    words = sorted({"".join(w) for w in letters[rng.integers(0, 10, (30_000, 9))]})
    tracemalloc.start()
    try:
        before, arrow = tracemalloc.get_traced_memory()[0], pa.total_allocated_bytes()
        for i in range(0, len(words), 5000):
            encode.many(["first " + " ".join(words[i : i + 5000])])
        grown = tracemalloc.get_traced_memory()[0] - before + pa.total_allocated_bytes() - arrow
    finally:
        tracemalloc.stop()
    assert grown < 80 * len(words)
    # what is forgotten is computed again
    monkeypatch.setattr(token_files, "CACHE_WORDS", 1000)
    odd = ["", " ", "a", "two  spaces", "it's don't,\nand so", "x1 é, naïve. ends\n", "\n", "word. word, word! word"]
    for i in range(0, 6000, 500):
        texts = [*odd, "first " + " ".join(words[i : i + 500] + words[:50]), " ".join(f"{w}," for w in words[i : i + 50])]
        assert encode.many(texts) == [encode._encode(t).tobytes() for t in texts]
        assert len(encode.words) == len(encode.ids) == len(encode.used) <= 1000
    assert len(set(encode.words.to_pylist())) == len(encode.words)
