"""The registered queries on the small tables, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from leadloom.llm import queries

SF = "/root/testdata/sf0.001"
SPACE = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


def rows(spark, name):
    return {r["doc_id"]: r.asDict() for r in queries.QUERIES[name](spark, SF).collect()}


def test_simhash(spark, documents):
    got = rows(spark, "op4_simhash_near_dedup")
    fps = {}
    for d in documents:
        words = re.findall(SPACE, "".join(c.lower() if "A" <= c <= "Z" else c for c in d["text"] or ""))
        k = min(4, len(words))
        hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)] if k else []
        fps[d["doc_id"]] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    group = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i, f in fps.items():
            low = min(group[j] for j, g in fps.items() if (f ^ g).bit_count() <= 4)
            if low < group[i]:
                group[i], changed = low, True
    assert {i: r["component_id"] for i, r in got.items()} == group


def test_token_files(spark, documents):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    got = rows(spark, "op5_token_files")
    start = 0
    for d in sorted(documents, key=lambda d: d["doc_id"]):
        ids = [*tok.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        r = got[d["doc_id"]]
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == len(documents)


def test_exact_dedup(spark, documents):
    got = rows(spark, "op6_exact_dedup")
    groups = {}
    for d in documents:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", d["text"] or ""), []).append((-len(d["text"] or ""), d["doc_id"]))
    for norm, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            want = (keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest())
            assert tuple(got[i][k] for k in ("keep_id", "group_size", "kept", "text_sha256")) == want


def test_decontamination(spark, documents):
    got = rows(spark, "op10_benchmark_decontamination")

    def words(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    windows = {}
    for item in pq.read_table(f"{SF}/benchmark.parquet").to_pylist():
        w = words(item["text"])
        for i in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item["item_id"])
    sizes = {len(w) for w in windows}
    assert any(r["contaminated"] for r in got.values())
    for d in documents:
        w = words(d["text"])
        hit, items = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    items |= found
        r = got[d["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(w), len(hit), len(items))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def test_language(spark, documents):
    got = rows(spark, "op3_language_id")
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [d for d in documents if got[d["doc_id"]]["held_out"]]
    right = sum(got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert right >= 0.97 * len(held)


def test_quality_agrees_with_labels(spark):
    got = rows(spark, "op2_quality_classifier")
    labels = pq.read_table(f"{SF}/labels.parquet").to_pylist()
    right = sum(got[r["doc_id"]]["accepted"] == bool(r["quality"]) for r in labels)
    assert right >= 0.95 * len(labels)


def test_toxicity_shape(spark, documents):
    got = rows(spark, "op8_toxicity")
    assert set(got) == {d["doc_id"] for d in documents}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
