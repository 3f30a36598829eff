"""Exact top-k search, source divergence and filter audit against brute force and on odd rows."""

import itertools
import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from leadloom.llm import divergence, filter_audit, queries, topk
from leadloom.llm.divergence import Block, merged, probability

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


def brute_top_k(rows, k, every):
    whole = [
        (i, v and [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (q, v) in enumerate(whole):
        if q is None or q % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w, strict=False)), math.inf if i is None else i)
            for m, (i, w) in enumerate(whole)
            if m != n
        ]
        out += [(q, r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df, **options):
    return sorted((tuple(r) for r in topk.top_k(df, **options).collect()), key=str)


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25, 0.0]),
        (0, [0.5, -0.25, 0.0]),
        (0, [1.0]),
        (None, [0.5, -0.25, 0.0]),
        (5, []),
        (10, None),
        (10, [0.1, None]),
        (15, [nan, 1.0]),
        (20, [inf, 1.0]),
        (-5, [0.5, 0.0, 0.0, 0.0, -3.0]),
        (7, [-0.001, -0.001, 2.5]),
        (25, [1e5, -1e5]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {n: F.lit(n) for n in ("lane", "piece", "at", "rank", "score", "id", "v", "query_id")}
    )
    assert found(df.repartition(3), k=4, every=5) == brute_top_k(rows, 4, 5)
    assert found(df.repartition(1), k=40, every=5) == brute_top_k(rows, 40, 5)
    assert found(df.where("vec_id = 7"), k=4, every=7) == []
    assert found(df.where("false"), k=4, every=5) == []


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e11])
def test_top_k_random_blocks(spark, monkeypatch, scale):
    """Several lanes, blocks and query sets; scores in 32 and 64 bits and beyond; a third of the rows equal."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "LANE_QUERIES", 10)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        v = rng.normal(size=6) * (rng.random(6) < 0.6) * scale
        if scale == 1e11:
            v = np.sign(v) * rng.integers(0, 3, 6) * 2.0**21
        rows.append((i, [0.25, 0.0, -1.0] if i % 3 == 0 else v.tolist()))
    if scale == 1e11:  # meets no query, but the sums could be beyond 64 bits
        rows.append((1001, [0.0] * 6 + [2.0**50]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert found(df, k=5, every=4) == brute_top_k(rows, 5, 4)


def test_scores_beyond_64_bits():
    huge = np.array([2**62, 2**62, -5], object)
    assert topk.best(huge * 4, 2).tolist() == [0, 1]


def test_too_large_component(spark):
    df = spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.top_k(df).collect()


ODD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, "Aa aA éÉ aa1aa b-b", "en", "a"),
    (4, "aa bb cc", "en", "b"),
    (4, "aa bb cc", "en", "b"),
    (None, "aa cc CC ßß", "en", "c"),
    (5, "aa", "", ""),
    (6, LONG, "de", "x"),
    (7, LONG.upper(), "de", "y"),
    (8, "one two", "fr", "only"),
    (9, "日本語 日本語", "de", "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def with_clashes(df):
    names = ("n", "v", "p", "q", "e", "item", "value", "part", "rank", "total", "lane", "tile", "digest", "mask", "cell", "step")
    return df.withColumns({n: F.lit(n) for n in names})


def on_duckdb(name, **tables):
    con = duckdb.connect()
    for t, df in tables.items():
        con.register(t, df.toArrow())
    rel = con.sql(queries.SQL[name])
    return rel.columns, rel.fetchall()


def brute_divergence(rows, min_docs, top):
    docs = [(t or "", x or "", s or "") for _, t, x, s in rows]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t, _, _ in docs]
    out = []
    for lang in {x for _, x, _ in docs}:
        mine = [(w, s) for w, (_, x, s) in zip(words, docs, strict=True) if x == lang]
        kept = {t for w, _ in mine for t in w}
        kept = {t for t in kept if sum(t in w for w, _ in mine) >= min_docs}
        sources = {s for _, s in mine}
        count = {s: {t: sum(w.count(t) for w, z in mine if z == s) for t in kept} for s in sources}
        whole = {t: sum(count[s][t] for s in sources) for t in kept}
        p = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        for s in sources:
            pairs = [(-sum(abs(p(count[s], t) - p(count[o], t)) for t in kept), o) for o in sources - {s}]
            over = [(p(whole, t) - p(count[s], t), t) for t in kept if count[s][t] and p(count[s], t) > p(whole, t)]
            for part, found, last in (("pair", pairs, len(pairs)), ("term", over, top)):
                ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))[:last]
                out += [(lang, s, part, i, -v, r) for r, (v, i) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 4])
@pytest.mark.parametrize("limits", [(1, 50), (2, 2), (99, 50)])
def test_divergence_odd_rows(spark, parts, limits):
    df = with_clashes(spark.createDataFrame(ODD, SCHEMA).repartition(parts)).drop("rank")
    short = [r for r in ODD if r[1] is None or len(r[1]) < 1000]
    assert rows_of(df.where("length(text) < 1000 or text is null"), *limits) == brute_divergence(short, *limits)
    got = divergence.divergence(df, *limits).where("lang = 'fr' and part = 'pair'").collect()
    assert got == []


def rows_of(df, min_docs, top):
    out = divergence.divergence(df, min_docs, top)
    return sorted(tuple(r) for r in out.select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence_spills_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 2_000)
    monkeypatch.setattr(divergence, "PIECE_ENTRIES", 7)
    monkeypatch.setattr(divergence, "LANE_ENTRIES", 40)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 3)
    rng = np.random.default_rng(1)
    letters = [chr(97 + i) * (1 + i % 3) for i in range(26)]
    rows = [
        (i, " ".join(rng.choice(letters, rng.integers(0, 30))), "xy"[i % 2], f"s{rng.integers(0, 9) if i % 3 else 0}") for i in range(300)
    ]
    assert rows_of(spark.createDataFrame(rows, SCHEMA).repartition(6), 20, 5) == brute_divergence(rows, 20, 5)


def test_divergence_empty(spark):
    assert divergence.divergence(spark.createDataFrame([], SCHEMA)).collect() == []


def test_runs_merge_into_counts():
    blocks = [Block() for _ in range(3)]
    for n, b in enumerate(blocks):
        for i in range(40):
            b.add("en", f"s{i % 2}", " ".join("abcdefgh"[k % 8] * (1 + k % 5) for k in range(n, i)).encode())
    shards = {}
    for b in blocks:
        for p in b.runs(3):
            shards.setdefault(p["shard"], []).append(p)
    got = {}
    for pieces in shards.values():
        terms = [t for t in merged(iter(sorted(pieces, key=lambda p: p["first"])))]
        assert [t for t, *_ in terms] == sorted(t for t, *_ in terms)
        got |= {t: (d, c) for t, d, c in terms}
    for t, (d, c) in got.items():
        assert d == sum(b.docs["en"][t] for b in blocks)
        assert c == {s: n for s in ("s0", "s1") if (n := sum(b.count["en", s][t] for b in blocks))}
    assert set(got) == set().union(*(b.docs["en"] for b in blocks))


def test_probability_is_exact():
    count, total = np.array([0, 7, 10**13, 123_456_789_012]), np.array([11, 13, 3 * 10**13 + 7, 999_999_999_989])
    want = [1 + 10**9 * (int(c) + 5) // int(t) for c, t in zip(count, total, strict=True)]
    assert probability(count, total).tolist() == want


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, *_ in docs:
        i = math.inf if i is None else i
        least[t or ""] = min(least.get(t or "", math.inf), i)
    judged = []
    for i, t, lang, *_ in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            x
            for x, bad in {
                "A": len(w) < 100,
                "B": 100 * len(set(w)) < 80 * len(w),
                "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                "D": bool(re.search("[#$%&*|]", t)),
                "E": (math.inf if i is None else i) > least[t],
            }.items()
            if bad
        }
        judged.append((lang or "", fails, i in good, i in toxic))
    out = {}
    for part in {j[0] for j in judged}:
        mine = [j[1:] for j in judged if j[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for k, x in enumerate(order):
                alive = [j for j in mine if not j[0] & set(order[:k])]
                gone = [j for j in alive if x in j[0]]
                failing = [j for j in mine if x in j[0]]
                shapley[x] += len(gone)
                out[part, "".join(order), k + 1] = (
                    len(alive) - len(gone),
                    len(gone),
                    len(failing) - len(gone),
                    sum(j[0] == {x} for j in mine),
                    sum(j[1] for j in gone),
                    sum(j[2] for j in gone),
                )
        for key in [k for k in out if k[0] == part]:
            out[key] += (shapley[key[1][key[2] - 1]],)
    return out


AUDITED = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \t\n", "en", "a"),
    (4, "SHOUT # now", "en", "a"),
    (4, "SHOUT # now", "de", "a"),
    (5, "SHOUT # now", "en", "b"),
    (None, "SHOUT # now", "en", "b"),
    (None, "no id", "de", "b"),
    (None, "no id", "de", "b"),
    (6, LONG, "de", "x"),
    (7, LONG, "de", "y"),
    (8, " ".join(f"Ünïq{i}" for i in range(100)), "fr", "z"),
    (9, " ".join(f"A{i}" for i in range(120)), "fr", "z"),
]
LABELLED = [(1, 1, 0), (4, 0, 1), (4, 1, None), (5, None, 1), (7, 1, 1), (9, 0, 0), (None, 1, 1), (99, 1, 1)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.mark.parametrize("parts", [1, 4])
def test_audit_odd_rows(spark, parts):
    docs = with_clashes(spark.createDataFrame(AUDITED, SCHEMA).repartition(parts)).drop("part")
    labels = spark.createDataFrame(LABELLED, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    got = filter_audit.filter_audit(docs, labels)
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COUNTS) for r in got.collect()}
    assert found == brute_audit(AUDITED, LABELLED)
    assert got.count() == 600 * 4
    names, want = on_duckdb("op13_filter_audit", documents=docs.select("doc_id", "text", "lang"), labels=labels)
    assert sorted(want) == sorted(tuple(r[n] for n in names) for r in got.collect())


def test_audit_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(spark.createDataFrame([], SCHEMA), labels).collect() == []
    one = spark.createDataFrame([(1, "x", "en", "a")], SCHEMA)
    got = filter_audit.filter_audit(one, labels).collect()
    assert len(got) == 600 and {r["removed"] for r in got} == {0, 1} and {r["shapley"] for r in got} == {0, 120}
