"""Null, empty, very long, tied and repeated rows, empty tables, columns with clashing names."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leadloom.llm import (
    decontaminate,
    exact_dedup,
    katz,
    language_id,
    mixing,
    quality,
    queries,
    simhash,
    substring_dedup,
    token_files,
    toxicity,
)

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = queries.tokenizer_path("byte_bpe_50k.tiktoken")
TOKENIZER = queries.tokenizer_path("byte_bpe_50k.json")

ROWS = [
    (1, None, "en", "src1", 0),
    (2, "", None, None, 0),
    (3, " \t\n", "en", "src2", 3),
    (4, "the quick brown fox jumps over the lazy dog again", "en", "src1", 1),
    (5, "the quick brown  fox jumps over the lazy dog again", "en", "src3", 1),
    (6, "der schnelle braune Fuchs springt über den faulen Hund", "de", "src10", 1),
    (6, "der schnelle braune Fuchs springt über den faulen Hund", "de", "src10", 1),
    (None, "der schnelle braune Fuchs springt über den faulen Hund", "de", "odd", 1),
    (7, LONG, "en", "src16", len(LONG)),
    (8, LONG + " tail", "en", "src16", None),
    (9, "12345 67890 !!", "de", "src4", 1),
    (10, "日本語のテキスト 🙂 éà", "de", "src4", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    clash = (
        *("score", "fp", "batch", "rank", "tokens", "cut", "n_words", "key", "digest", "kept", "p", "_x"),
        *("_key", "_root", "root", "_quality", "_in0", "in0", "row", "least", "_text", "_n_words", "_spans", "_items"),
        *("spans", "items", "_p0", "p0", "_full", "_cut", "full_epochs", "copies", "id", "_id", "_y", "hash", "domain"),
    )
    return df.withColumns({n: F.lit(n) for n in clash})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r.asDict())
    assert sum(map(len, out.values())) == len(ROWS)
    return out


def test_substrings(docs, empty):
    got = by_id(substring_dedup.remove_repeats(docs, window=4))
    words = {i: (t or "").split() for i, t, *_ in ROWS}
    assert got[7][0]["n_words"] == 60_000 and got[1][0]["n_words"] == 0
    assert got[8][0]["n_words"] == 60_001 and got[8][0]["text"].split()[-1] == "tail"
    assert got[8][0]["n_removed"] == 60_000
    assert got[5][0]["n_removed"] == len(words[5]) and got[4][0]["n_removed"] == 0
    assert [r["n_removed"] for r in got[6]] == [0, 0] and got[None][0]["n_removed"] == 9
    assert got[2][0]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert substring_dedup.remove_repeats(empty).collect() == []


def test_substrings_random(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), " ".join(rng.choice(list("abcd"), rng.integers(0, 60)))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in substring_dedup.remove_repeats(df, window=5).collect()}
    first, words = {}, {i: t.split() for i, t in rows}
    for i in sorted(words):
        for k in range(len(words[i]) - 4):
            first.setdefault(tuple(words[i][k : k + 5]), (i, k))
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - 4) if first[tuple(w[k : k + 5])] != (i, k) for j in range(5)}
        assert got[i] == (len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))


@pytest.mark.parametrize("parts", [1, 4])
@pytest.mark.parametrize("shared", [5, None])
def test_substrings_of_rows_that_share_an_id(spark, parts, shared):
    p = " ".join(f"p{i}" for i in range(25))
    x = " ".join(f"x{i}" for i in range(30))
    twice = f"{x} {x}"
    rows = [(1, p), (shared, p), (shared, x), (shared, x), (shared, twice), (9 if shared else None, x)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = sorted((r["text"] == "", r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeats(df).collect())
    # the repeat inside the long row goes; of the rows with x only the one with the larger id
    last = (True, 30, 30) if shared else (False, 30, 0)
    assert got == sorted([(False, 25, 0), (True, 25, 25), (False, 30, 0), (False, 30, 0), (False, 60, 30), last])


def test_quality(docs, empty):
    got = by_id(quality.quality(docs))
    assert all(0 <= r["score"] <= 1 for rows in got.values() for r in rows)
    assert quality.quality(empty).collect() == []
    assert quality.keep_good(docs).columns == docs.columns


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.8
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.85, 0.75, 0.6]
    counts = {}
    for y in good:
        p = "".join("2" if rng.random() < 0.2 else str(int(y if rng.random() < a else not y)) for a in accuracy)
        counts[p] = counts.get(p, 0) + 1
    model = quality.fit_labels(counts)
    assert abs(model.share - 0.8) < 0.02
    for h, a in enumerate(accuracy):
        assert abs(model.table[h, 1, 1] - a) < 0.04 and abs(model.table[h, 0, 0] - a) < 0.06


def test_shapes_of_long_words_differ():
    a, b = ("x1" * 8 + end for end in ("!!", "2y"))
    (one, _), (other, _) = quality.features([a, b])
    assert set(one.tolist()) != set(other.tolist()) and quality.shape(a) != quality.shape(b)


def test_language(docs, empty):
    got = by_id(language_id.language_id(docs, VOCABULARY))
    assert [got[i][0]["lang_pred"] for i in (1, 2, 3, 9)] == ["und"] * 4
    assert got[10][0]["lang_pred"] in {"en", "de"} and 0 <= got[7][0]["score"] <= 1
    assert language_id.language_id(empty, VOCABULARY).collect() == []
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.language_id(none, VOCABULARY).collect()} == {"und"}


def log_of(x):
    """Logarithm of a fraction of any size."""
    shift = x.denominator.bit_length() - x.numerator.bit_length()
    return math.log(x * 2**shift) - shift * math.log(2)


def test_long_words_are_learned_and_scored_whole(monkeypatch):
    """Logarithms and plain sums give the same, and batches of words do not matter."""
    pieces = language_id.Pieces(VOCABULARY)
    rng = np.random.default_rng(2)
    prob = rng.random((2, pieces.n)) + 0.01
    prob /= prob.sum(axis=1, keepdims=True)
    words = [b" " + bytes(rng.choice(list(b"abenort-"), int(n))) for n in rng.integers(1, 23, 60)]
    count = rng.integers(0, 4, (2, len(words))).astype(float)
    plain = language_id.word_scores(pieces, words, prob), language_id.expected(pieces, words, count, prob)
    monkeypatch.setattr(language_id, "SHORT", 3)
    monkeypatch.setattr(language_id, "CELLS", 200)
    logs = language_id.word_scores(pieces, words, prob), language_id.expected(pieces, words, count, prob)
    assert np.allclose(plain[0], logs[0]) and np.allclose(plain[1], logs[1])


def test_copies_of_a_text_train_a_language(spark):
    rows = [(i, "le chat dort sur le tapis", "fr") for i in range(300)] + [(1000 + i, f"the cat sleeps {i}", "en") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.language_id(df, VOCABULARY, train_docs=100)
    assert {r["lang_pred"] for r in got.where("doc_id < 1000").collect()} == {"fr"}


def test_forward_sums_all_segmentations():
    pieces = language_id.Pieces(VOCABULARY)
    rng = np.random.default_rng(0)
    prob = rng.random((2, pieces.n))
    prob /= prob.sum(axis=1, keepdims=True)
    # the last ones are longer than plain sums can be, and hold pieces of more than 10 bytes
    words = [b" the", b" a", b" xyzzy", " über".encode(), b" thereation", b" government"]
    words += [b" government-information-of-the-international", "  日本語のテキストは長い".encode()[1:] * 3, b" " + b"x" * 400]
    size, spans = pieces.spans(words)
    found = [{} for _ in words]
    for k, word, at, piece in spans:
        for w, a, p in zip(word.tolist(), at.tolist(), piece.tolist(), strict=True):
            found[w][a, a + k] = p

    assert any(k > 10 and len(word) for k, word, _, _ in spans) and pieces.longest > 10

    def total(w, lang):
        sums = [Fraction(0)] * len(words[w]) + [Fraction(1)]
        for (s, e), p in sorted(found[w].items(), reverse=True):
            sums[s] += Fraction(prob[lang, p]) * sums[e]
        return sums[0]

    got = language_id.word_scores(pieces, words, prob)
    want = [[log_of(total(w, lang)) for lang in (0, 1)] for w in range(len(words))]
    assert np.allclose(got, want)
    # expected counts add up to the number of bytes when weighted with the pieces' lengths
    count = language_id.expected(pieces, words, np.ones((2, len(words))), prob)
    length = np.zeros(pieces.n)
    for k, _, _, piece in spans:
        length[piece] = k
    assert np.allclose(count @ length, sum(map(len, words)))


def test_simhash(docs, empty):
    got = by_id(simhash.simhash_components(docs))
    assert {got[i][0]["fingerprint"] for i in (1, 2, 3)} == {"0" * 16}
    assert {got[i][0]["component_id"] for i in (1, 2, 3)} == {1}
    assert got[5][0]["component_id"] == 4 and got[8][0]["component_id"] == 7
    assert got[None][0]["component_id"] == 6 == got[6][1]["component_id"]
    assert simhash.simhash_components(empty).collect() == []
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 6, 7, 9, 10]


def test_one_document_of_each_group_whatever_its_id(spark):
    rng = np.random.default_rng(11)
    a, b, c, d, e, f = (" ".join(f"w{x}" for x in rng.integers(0, 10_000, 60)) for _ in range(6))
    rows = [(None, a), (None, b), (None, c), (3, c), (5, d), (5, e), (5, e), (7, e), (None, None), (8, f), (8, None)]
    df = spark.createDataFrame([(i, k, t) for k, (i, t) in enumerate(rows)], "doc_id long, _x int, text string").repartition(3)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(None, a), (None, b), (3, c), (5, d), (5, e), (8, f), (8, None)], key=str)


@pytest.mark.parametrize("task_size", [4, 64, 10_000])
def test_trie_join_against_all_pairs(spark, task_size):
    rng = np.random.default_rng(task_size)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64) << np.uint64(1)
    fp = base[rng.integers(0, 30, 400)]
    for _ in range(4):
        fp = fp ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    fp = np.unique(fp)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
    label = np.arange(len(fp))
    while True:
        new = np.where(near, label[None, :], len(fp)).min(axis=1)
        if (new == label).all():
            break
        label = new
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    found = simhash.linked_fingerprints(df, 4, task_size=task_size).collect()
    root = {r["node"]: r["root"] for r in found}
    groups = {}
    for x, g in zip(fp.view(np.int64).tolist(), label.tolist(), strict=True):
        groups.setdefault(g, set()).add(root.get(x, x))
    assert all(len(x) == 1 for x in groups.values())
    assert len({min(x) for x in groups.values()}) == len(groups)


def test_token_files(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    shards = token_files.write_tokens(docs, str(tmp_path / "t"), TOKENIZER, shards=4, frame_ids=500)
    tok = Tokenizer.from_file(TOKENIZER)
    want = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for i, t, *_ in ROWS}
    rows = sorted(token_files.read_tokens(shards).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((i for i, *_ in ROWS), key=lambda i: -1 if i is None else i)
    start = 0
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == want[r["doc_id"]] and r["start"] == start
        start += len(ids)
    path = next(s["path"] for s in shards.collect() if 7 in token_files.fetch(s["path"], [7]))
    assert np.frombuffer(token_files.fetch(path, [7])[7], "<u4").tolist() == want[7]
    assert token_files.fetch(path, [12345]) == {}
    none = token_files.write_tokens(empty, str(tmp_path / "e"), TOKENIZER)
    assert token_files.read_tokens(none).collect() == []


def test_token_file_is_plain_zstandard_and_checked(tmp_path):
    import io

    import zstandard

    out = io.BytesIO()
    writer = token_files.ShardWriter(out, frame_ids=3)
    for i in range(5):
        writer.add(i, np.arange(i, dtype="<u4").tobytes())
    writer.close()
    raw = out.getvalue()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert np.frombuffer(plain, "<u4").tolist() == [0, 0, 1, 0, 1, 2, 0, 1, 2, 3]
    reader = token_files.ShardReader(io.BytesIO(raw), len(raw))
    assert [len(x) // 4 for _, x in reader.read(range(5))] == [0, 1, 2, 3, 4]
    damaged = bytearray(raw)
    damaged[8] ^= 0xFF
    bad = token_files.ShardReader(io.BytesIO(bytes(damaged)), len(raw))
    with pytest.raises(Exception):  # noqa: B017
        bad.frame(0)


@pytest.mark.parametrize(
    "text",
    ["", " ", "a b", " a", "a ", "\n", "a\n", "a\nb", "a \nb", "x\n\ny", "é\xa0b c", "it's don't", "a!! b%%% c.,; d_e f\"g x's! y.'", "a.b c-d", "<|endoftext|> a", "end<|endoftext|>", "a\x1cb \x1c c", "1 2,3 $$", "日本 語x", "\t a", "a\x85 b", "a  b"],
)
def test_encoder_equals_library(text):
    e = token_files.encoder(TOKENIZER)
    want = e.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(e(text), "<u4").tolist() == want


def test_exact_dedup(docs, empty):
    got = by_id(exact_dedup.exact_dedup(docs))
    assert {got[i][0]["keep_id"] for i in (1, 2, 3)} == {3} and got[1][0]["group_size"] == 3
    assert [r["kept"] for r in got[4] + got[5]] == [False, True]
    assert [r["kept"] for r in got[6]] == [True, True] and not got[None][0]["kept"]
    assert got[None][0]["group_size"] == 3 and got[7][0]["kept"] and got[8][0]["kept"]
    assert exact_dedup.exact_dedup(empty).collect() == []


def test_katz(docs, empty):
    got = by_id(katz.katz_scores(docs))
    assert got[1][0]["n_tokens"] == 1 and got[7][0]["n_tokens"] == 60_001
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for rows in got.values() for r in rows)
    assert got[None][0]["held_out"]
    assert katz.katz_scores(empty).collect() == []
    alone = katz.katz_scores(docs.where("doc_id is null")).first()
    assert (alone["train_tokens"], alone["n_known"], alone["score"], alone["base_score"]) == (0, 0, 0.0, 0.0)


def test_toxicity(spark, docs, empty):
    marks = [(i, 1, int(i in (4, 6))) for i in range(1, 11)] + [(None, 1, 1), (4, 1, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = by_id(toxicity.toxicity(docs, labels))
    assert all(0 <= r["score"] <= 1 for rows in got.values() for r in rows)
    assert got[1][0]["score"] == got[2][0]["score"] == got[3][0]["score"]
    assert toxicity.toxicity(empty, labels).collect() == []
    assert len(toxicity.toxicity(docs, labels.where("false")).collect()) == len(ROWS)


def test_conflicting_labels_have_a_rule(spark):
    """Whatever the order of the label rows, an id is toxic if any of them says so."""
    docs = spark.createDataFrame([(i, "bad vile words" if i % 2 else "good kind words") for i in range(80)], "doc_id long, text string")
    pairs = [(i, y) for i in range(80) for y in ((0, 1) if i % 2 else (0, 0))]
    scores = []
    for rows in (pairs, pairs[::-1]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int").coalesce(1)
        scores.append({r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()})
    assert scores[0] == scores[1] and min(scores[0][i] for i in range(1, 80, 2)) > 0.9


def test_a_long_repeated_id_trains_once(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 100)
    rows = [(1, "b b"), (1, "a a"), (1, None), (4, LONG), (5, "c")]
    got = toxicity._sample(spark.createDataFrame(rows, "doc_id long, text string"), [1, 4, 5]).collect()
    assert [(r[0], bytes(r[1])) for r in got] == [(1, b"a a"), (5, b"c")]


def test_passages_overlap_by_half():
    at = np.arange(1000)
    passage, word = toxicity.passages(at, 1000)
    sets = [set(word[passage == k].tolist()) for k in range(passage.max() + 1)]
    assert max(map(len, sets)) <= toxicity.PASSAGE and set().union(*sets) == set(range(1000))
    # any run of half a passage lies in one
    assert all(any(set(range(i, i + 49)) <= s for s in sets) for i in range(950))
    assert toxicity.passages(at[:100], 1000)[0].max() == 0


def test_misspelt_words_share_vectors():
    rng = np.random.default_rng(5)
    plain = ["".join(rng.choice(list("bdfgklnprstv"), 6)) for _ in range(300)]
    bad = ["zyxomuj", "qwyzzah", "juxquop"]
    rows = []
    for i in range(400):
        words = list(rng.choice(plain, 80))
        if i % 2:
            words[int(rng.integers(0, 80))] = bad[i // 2 % 3]
            words[int(rng.integers(0, 80))] = bad[i // 2 % 3]
        rows.append((" ".join(words), i % 2))
    model = toxicity.train(rows)
    logit = model.word_logits([b"zyxomujj", b"qwyzah", plain[0].encode()])
    assert min(logit[:2]) > 3 * abs(logit[2])


def test_toxic_word_at_the_end_of_a_long_run(monkeypatch):
    rng = np.random.default_rng(7)
    plain = ["".join(rng.choice(list("bdfgklnprstv"), 6)) for _ in range(300)]
    rows = [(" ".join([*rng.choice(plain, 40), *["zyxomuj"] * (i % 2)]), i % 2) for i in range(400)]
    model = toxicity.train(rows)
    for run in ("bdfg" * 17, "日本語" * 8, "bdfg" * 3000):
        end, clean = toxicity.score_texts(model, [run + "zyxomuj", run + plain[0]])
        assert end > clean
    words = [("bdfg" * 17 + "zyxomuj").encode(), b"ab", "日本語".encode() * 50, b"x" * 500, b"y" * 79, b"c"]
    bucket, n = toxicity.subwords(words)
    size = np.array([len(w) + 2 for w in words])
    assert n.tolist() == [1 + sum(max(0, s - k + 1) for k in toxicity.GRAMS) for s in size]
    logits = model.word_logits(words)
    monkeypatch.setattr(toxicity, "BYTES", 40)  # all the same in several turns
    more, again = toxicity.subwords(words)
    assert again.tolist() == n.tolist() and np.allclose(model.word_logits(words), logits)
    for a, b in zip(np.split(bucket, np.cumsum(n)), np.split(more, np.cumsum(n)), strict=True):
        assert sorted(a.tolist()) == sorted(b.tolist())


def test_mixing(spark, docs, empty):
    path = queries.mix_path(docs)
    plan = mixing.mix_plan(docs, path, queries.MIX_WEIGHTS, budget=0.5, max_epochs=2)
    out = mixing.mix(docs, path, plan)
    assert out.count() == len(ROWS)
    assert set(out.columns) == {*docs.columns, "_copies"}
    none = mixing.mix_plan(empty, queries.mix_path(empty), {}, budget=0.5)
    assert mixing.mix(empty, queries.mix_path(empty), none).collect() == []


def test_mixing_budgets(spark):
    rows = [(i, "w " * 10, "en", s) for s, n in (("a", 10), ("b", 200), ("c", 200)) for i in range(n)]
    df = spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    path = {"top": F.when(F.col("source") == "c", "y").otherwise("x"), "lang": F.col("lang"), "leaf": F.col("source")}
    plan = {r["leaf"]: r for r in mixing.mix_plan(df, path, {("x",): 1.0, ("y",): 1.0}, budget=2000).collect()}
    # x gets 1000; its leaf a has but 100 tokens, and what it lacks goes to b, not to c
    assert (plan["a"]["given"], plan["b"]["given"], plan["c"]["given"]) == (100, 900, 1000)
    # a whole subtree that is short passes the rest on
    plan = {r["leaf"]: r for r in mixing.mix_plan(df, path, {}, budget=3900).collect()}
    assert (plan["a"]["given"], plan["b"]["given"], plan["c"]["given"]) == (100, 1850, 1950)
    plan = {r["leaf"]: r for r in mixing.mix_plan(df, path, {("y",): 0.0}, budget=3900, max_epochs=1).collect()}
    assert (plan["a"]["given"], plan["b"]["given"], plan["c"]["given"]) == (100, 2000, 0)


def test_decontamination(spark, docs, empty):
    items = [(1, "Quick brown FOX, jumps over the lazy"), (2, None), (3, "..."), (4, "dog again"), (None, "the quick")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    hits = {r["doc_id"]: r for r in decontaminate.benchmark_hits(docs, benchmark, window=3).collect()}
    text = "the quick brown  fox jumps over the lazy dog again"
    spans = hits[5]["spans"]
    assert [text[s["start"] : s["end"]] for s in spans] == ["quick brown  fox jumps over the lazy dog again"]
    assert hits[5]["items"] == [1, 4] and hits[7]["items"] == [] and hits[1]["n_words"] == 0
    split = decontaminate.benchmark_hits(docs, benchmark, window=3, max_bytes=10)
    assert {r["doc_id"]: r for r in split.collect()}[5] == hits[5]
    assert decontaminate.benchmark_hits(empty, benchmark).collect() == []
    clean = decontaminate.decontaminate(docs, benchmark.where("false"))
    assert clean.count() == len(ROWS) and clean.columns == docs.columns
    accents = spark.createDataFrame([(1, "é Über x y z")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, "Über X")], "item_id long, text string")
    (only,) = decontaminate.benchmark_hits(accents, marks).first()["spans"]
    assert (only["start"], only["end"]) == (2, 8)


def test_benchmark_items_without_an_id(spark):
    import duckdb
    import pyarrow as pa

    text = [" ".join(f"{c}{i}" for i in range(14)) for c in "abcd"]
    docs = [(1, text[0]), (2, f"{text[1]} {text[2]}"), (3, text[3]), (4, f"{text[0]} {text[1]}"), (5, None)]
    items = [(None, text[0]), (None, text[2]), (7, text[1]), (12, text[1]), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [i for i, _ in docs], "text": [t for _, t in docs]}))
    con.register("benchmark", pa.table({"item_id": [i for i, _ in items], "text": [t for _, t in items]}))
    want = sorted(con.execute(queries.SQL["op10_benchmark_decontamination"]).fetchall())
    assert sorted(tuple(r) for r in decontaminate.contamination_report(df, benchmark).collect()) == want
    assert [r[3] for r in want] == [1, 3, 0, 3, 0]
    split = decontaminate.benchmark_hits(df, benchmark, null_ids=True, max_bytes=60).collect()
    assert {r["doc_id"]: r["items"] for r in split} == {1: [None], 2: [7, 12, None], 3: [], 4: [7, 12, None], 5: []}
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(df, benchmark).collect()) == [3, 5]


def test_pipeline_edges(spark, docs, empty, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, "nothing of this occurs anywhere")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for table in (docs, empty):
        now = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, folder)
            assert now.columns == table.columns
            now = spark.createDataFrame(now.collect(), table.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, now, folder).count() == now.count()


def test_word_signs_are_distinct_and_aligned():
    signs = [decontaminate._sign(n) for n in (*range(20_500), 1_000_000, 10**6 + 100, 5 * 10**6)]
    assert len(set(signs)) == len(signs) and {len(x) for x in signs} == {decontaminate.DIGITS}
    places = [{x[k] for x in signs} | {decontaminate._NO_SIGN[0]} for k in range(decontaminate.DIGITS)]
    assert places[0] & places[1] == places[1] & places[2] == {decontaminate._NO_SIGN[0]}
