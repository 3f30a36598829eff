from __future__ import annotations

import datetime as dt
import os
import random
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadloom import operators as ops
from leadloom.functions import json_text
from tests.helpers import final_plan, first_plan, rows

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# --- latest row per key ------------------------------------------------------------


def latest(df):
    return ops.dedup_latest(df, ["k"], [F.col("t").desc_nulls_last()], [F.col("id").asc()])


def test_dedup_order(spark):
    data = [("a", None, 1), ("a", "", 2), ("a", "2024-01", 3), ("a", "2024-02", 4), ("b", "x", 6), ("b", "x", 5), (None, None, 7)]
    df = spark.createDataFrame(data, "k string, t string, id int")
    assert rows(latest(df)) == [(None, None, 7), ("a", "2024-02", 4), ("b", "x", 5)]


@SLOW
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 3))), max_size=40), st.randoms())
def test_dedup_independent_of_order(spark, pairs, rnd):
    data = [(k, t, i) for i, (k, t) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k string, t int, id int")
    got = rows(latest(df))
    assert len({r[0] for r in got}) == len(got) == len({k for k, _ in pairs})
    assert set(got) <= set(data)
    shuffled = data[:]
    rnd.shuffle(shuffled)
    again = spark.createDataFrame(shuffled, "k string, t int, id int").repartition(3)
    assert rows(latest(again)) == got


def test_dedup_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), "id")
    plan = first_plan(latest(df))
    assert plan.count("WindowGroupLimit") == 2


def keeper(spark, path, buckets=8):
    return ops.LatestRows(spark, path, ["k"], [F.col("t").desc_nulls_last(), F.col("id").asc()], buckets)


@settings(SLOW, max_examples=4)
@given(st.lists(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abcdef")), st.one_of(st.none(), st.integers(0, 3))), max_size=8), min_size=1, max_size=3))
def test_folding_extracts_equals_one_run(spark, tmp_path_factory, extracts):
    kept, n, all_rows = keeper(spark, str(tmp_path_factory.mktemp("latest"))), 0, []
    for extract in extracts:
        data = [(k, t, n + i) for i, (k, t) in enumerate(extract)]
        n += len(data)
        all_rows += data
        kept.fold(spark.createDataFrame(data, "k string, t int, id int"))
        assert rows(kept.read()) == rows(latest(spark.createDataFrame(all_rows, "k string, t int, id int")))


def test_a_fold_touches_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "latest")
    kept = keeper(spark, path)
    schema = "k string, t int, id int"
    first = kept.fold(spark.createDataFrame([(f"k{i}", 1, i) for i in range(100)], schema))
    assert first == list(range(8))
    begun = kept.read()
    touched = kept.fold(spark.createDataFrame([("k1", 2, 1000), ("k1", 0, 1001), ("k2", 0, 1002)], schema))
    assert len(touched) <= 2
    assert {r.id for r in kept.read().where("k in ('k1', 'k2')").collect()} == {1000, 2}
    assert kept.read().count() == 100 and begun.where("t = 2").count() == 0
    with pytest.raises(ValueError, match="columns of the extract"):
        kept.fold(spark.range(1))
    with pytest.raises(ValueError, match="has 8 buckets"):
        keeper(spark, path, 4).read()
    # replaced rows go with their time
    kept.fold(spark.createDataFrame([("k3", 9, 9)], schema), retain_seconds=0)
    assert kept.read().where("t = 9").count() == 1 and kept.read().count() == 100
    with pytest.raises(Exception):
        begun.count()


def test_racing_folds_are_all_kept(spark, tmp_path):
    kept = keeper(spark, str(tmp_path / "latest"))
    parts = [spark.createDataFrame([(f"k{i}", p, i) for i in range(5)], "k string, t int, id int") for p in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(kept.fold, parts))
    assert {r.t for r in kept.read().collect()} == {3} and kept.read().count() == 5


# --- aggregates ----------------------------------------------------------------------


def test_value_of_latest(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    df = spark.createDataFrame([(day(1), "x"), (None, "y"), (day(3), "z")], "paid timestamp_ntz, name string")
    first = ops.value_of_latest(F.col("name"), F.col("paid"), nulls="first")
    last = ops.value_of_latest(F.col("name"), F.col("paid"), nulls="last")
    only = ops.value_of_latest(F.col("name"), F.col("paid"), nulls="first", only=F.col("name") != "y")
    assert tuple(df.agg(first, last, only).collect()[0]) == ("y", "z", "z")


def test_value_of_latest_may_be_null(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "t int, name string")
    assert df.agg(ops.value_of_latest(F.col("name"), F.col("t"), nulls="last")).collect()[0][0] is None


def test_value_of_latest_rejects_unknown_order():
    with pytest.raises(ValueError):
        ops.value_of_latest(None, None, nulls="middle")


def test_reached_after(spark):
    t0 = dt.datetime(2024, 1, 1)
    data = [
        ("exactly", t0, t0 + dt.timedelta(days=7)),
        ("below", t0, t0 + dt.timedelta(days=6, hours=23)),
        ("no user", None, t0),
        ("one null", t0, None),
        ("one null", t0, t0 + dt.timedelta(days=8)),
    ]
    df = spark.createDataFrame(data, "k string, t0 timestamp_ntz, t timestamp_ntz")
    got = dict(rows(ops.aggregate(df, ["k"], {"r": ops.reached_after(F.col("t"), F.col("t0"), 7)})))
    assert got == {"exactly": 1, "below": 0, "no user": None, "one null": 1}


def test_category_counts_and_filtered_count(spark):
    df = spark.createDataFrame([("a", True), ("a", None), (None, False)], "s string, f boolean")
    assert rows(ops.category_counts(df, "s")) == [("UNKNOWN", 1), ("a", 2)]
    assert df.agg(ops.count_where(F.col("f"))).collect()[0][0] == 1


def test_hot_group_is_combined_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 1).alias("k"), (F.col("id") % 5).alias("v"))
    plan = first_plan(ops.aggregate(df, ["k"], {"n": F.count("*"), "d": F.count_distinct("v")}))
    assert "partial_count(1)" in plan
    # the distinct values spread a hot key over the first shuffle
    assert re.search(r"hashpartitioning\(k#\w+, v#\w+, ", plan)


# --- joins ------------------------------------------------------------------------------


def full_join_model(key_rows):
    """Chain of full outer joins, by hand: per key the cross product."""
    by_key = [defaultdict(list) for _ in key_rows]
    out = []
    for i, table in enumerate(key_rows):
        for k, v in table:
            if k is None:
                row = [None] * (len(key_rows) + 1)
                row[i + 1] = v
                out.append(tuple(row))
            else:
                by_key[i][k].append(v)
    for k in set().union(*by_key):
        for combo in product(*[t.get(k, [None]) for t in by_key]):
            out.append((k, *combo))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


KEYS = st.one_of(st.none(), st.sampled_from("abcdef"))


@SLOW
@given(
    st.lists(KEYS, max_size=12),
    st.lists(KEYS, max_size=8),
    st.sets(st.sampled_from("abcdefg")),
    st.sets(st.sampled_from("abcdefg")),
)
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_full_outer_on(spark, conf, broadcast, leads, accounts, purchases, enrollments):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    tables = [
        [(k, f"l{i}") for i, k in enumerate(leads)],
        [(k, f"a{i}") for i, k in enumerate(accounts)],
        [(k, f"p{k}") for k in purchases],
        [(k, f"e{k}") for k in enrollments],
    ]
    dfs = [spark.createDataFrame(t, f"email string, {n} string") for t, n in zip(tables, "lape")]
    repeated = [ops.Repeated.split(df, "email") for df in dfs[:2]]
    expected = full_join_model(tables)
    for heavy_rows in (1000, 1):
        got = ops.full_outer_on("email", repeated, dfs[2:], heavy_rows).select("email", *"lape")
        assert rows(got) == expected


def test_full_outer_on_integer_key_and_equivalent_chain(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (3, "q")], "k int, b string")
    keyed = ops.Repeated(a.where("k is not null"), keys=a, unkeyed=a.where("k is null"))
    got = ops.full_outer_on("k", [keyed], [b]).select("k", "a", "b")
    assert rows(got) == rows(a.join(b, on="k", how="full").select("k", "a", "b"))


@SLOW
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), KEYS), max_size=15),
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), KEYS), max_size=15),
)
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("heavy_rows", [1000, 1])
def test_left_join_fanout(spark, conf, broadcast, heavy_rows, left, right):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    fact = spark.createDataFrame([(*k, i) for i, k in enumerate(left)], "c int, e string, x int")
    other = spark.createDataFrame([(*k, i) for i, k in enumerate(right)], "c int, e string, y int")
    got = ops.left_join_fanout(fact, other, ["c", "e"], heavy_rows).select("c", "e", "x", "y")
    expected = fact.join(other, on=["c", "e"], how="left").select("c", "e", "x", "y")
    assert rows(got) == rows(expected)


@pytest.fixture
def skewed(spark, conf):
    """Large joins in miniature: no broadcast, low skew thresholds."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__shuffle__partitions="16",
    )
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 4000))
    return spark.range(0, 60000, 1, 8).select(hot.alias("email"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_full_outer_splits_a_hot_key(spark, conf, skewed):
    per_key = spark.range(0, 5000).select(F.concat(F.lit("u"), F.col("id")).alias("email"), F.col("id").alias("p"))
    accounts = spark.range(0, 3000).select(F.when(F.col("id") < 2500, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("email"), F.col("id").alias("a"))
    few = skewed.where("email != 'hot' or pad < '04'")
    got = ops.full_outer_on("email", [ops.Repeated(accounts), ops.Repeated(few)], [per_key], heavy_rows=100)
    # one shuffle of each table, no join
    plan = first_plan(got)
    assert plan.count("Exchange") == 1 and plan.count("Range (") == 3 and "Join" not in plan
    hot = few.where("email = 'hot'").count()
    assert hot > 250 and got.where("email = 'hot'").count() == hot * 2500
    keys = accounts.select("email").union(few.select("email")).union(per_key.select("email")).distinct().count()
    assert got.where("email != 'hot'").count() >= keys - 1
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < sum(sizes) / 4


@pytest.mark.parametrize("hot_side", ["fact", "other"])
def test_fanout_splits_a_hot_key_on_either_side(spark, conf, skewed, hot_side):
    small = spark.range(0, 3000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("email"),
        F.col("id").alias("y"),
    )
    fact, other = (skewed, small) if hot_side == "fact" else (small, skewed)
    fact = fact.select(F.concat("email", F.lit("")).alias("email"), *[F.col(c).alias(f"f_{c}") for c in fact.columns[1:]])
    got = ops.left_join_fanout(fact, other, ["email"], heavy_rows=1000)
    plan = final_plan(got)
    assert plan.count("SortMergeJoin") == 1 and plan.count("Range (") == 2
    if hot_side == "fact":
        assert "SortMergeJoin(skew=true)" in plan and "__salt" not in plan
    else:
        conf(spark__sql__adaptive__coalescePartitions__enabled="false")
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert "__salt" in plan and max(sizes) < sum(sizes) / 4
    assert got.count() == fact.join(other, on="email", how="left").count()


def test_heavy_keys(spark, skewed):
    keyed = skewed.withColumn("c", F.lit(1)).unionByName(spark.range(5000).select(F.lit(None).alias("email"), F.lit("").alias("pad"), F.lit(2).alias("c")))
    assert ops.heavy_keys(keyed, ["c", "email"], 1000) == {'{"k0":1,"k1":"hot"}': 20000}
    assert ops.heavy_keys(keyed, ["email"], 30000) == {} and ops.heavy_keys(keyed.where("false"), ["email"]) == {}


def test_left_join_broadcasts_a_small_lookup(spark):
    fact = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    dim = spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    got = ops.left_join(fact, dim, "k")
    assert "BroadcastHashJoin" in first_plan(got)
    assert got.count() == 1000


def test_drill_across_does_not_multiply(spark):
    a = spark.createDataFrame([(1, 10), (1, 20), (2, 5)], "k int, x int")
    b = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (3, 9)], "k int, y int")
    got = ops.drill_across(a, b, "k", {"x": F.sum("x")}, {"y": F.sum("y")})
    assert rows(got) == [(1, 30, 3), (2, 5, None), (3, None, 9)]


def test_drill_across_keeps_rows_without_a_key(spark):
    a = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, x int")
    b = spark.createDataFrame([(None, 7)], "k int, y int")
    aggs = {"x": F.sum("x")}, {"y": F.sum("y")}
    assert rows(ops.drill_across(a, b, "k", *aggs)) == [(None, 3, 7), (1, 3, None)]
    assert final_plan(ops.drill_across(a, b, "k", *aggs)).count("Scan ExistingRDD") == 2
    assert rows(ops.drill_across(a.where("k = 1"), b, "k", *aggs)) == [(None, None, 7), (1, 3, None)]


# --- unions, unnesting, attaching, keys -------------------------------------------------


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 7)], "k int, b int")
    empty = spark.createDataFrame([], "k int, c int")
    got = ops.union_by_name({"a": a, "b": b, "skip": a, "empty": empty}, "src", exclude=["skip"], skip_empty=True)
    assert got.columns == ["k", "a", "src", "b"]
    assert rows(got) == [(1, "x", "a", None), (2, None, "b", 7)]
    assert "c" in ops.union_by_name({"a": a, "empty": empty}).columns
    none = ops.union_by_name({})
    assert none.columns == [] and none.count() == 0


def test_unnest_drops_parents_without_members(spark):
    docs = ["[]", None, "null", '{"a":1}', '[{"q":"x"},{"q":null}]']
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string").select("id", F.parse_json("t").alias("v"))
    field = {"q": json_text(F.col("value"), "$.q")}
    assert rows(ops.unnest_array(df, F.col("v"), field, base=1).drop("v")) == [(4, 1, "x"), (4, 2, None)]
    assert rows(ops.unnest_array(df, F.col("v"), field).select("position")) == [(0,), (1,)]

    docs = ["{}", None, "null", "[1]", '{"7":{"q":"x"},"8":3}']
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string").select("id", F.parse_json("t").alias("v"))
    got = ops.unnest_object(df, F.col("v"), field, key="m", key_type="int").drop("v")
    assert rows(got) == [(4, 7, "x"), (4, 8, None)]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_attach_rows(spark, conf, broadcast):
    conf(spark__sql__autoBroadcastJoinThreshold=broadcast)
    parents = spark.createDataFrame([("a",), ("b",), ("none",)], "k string")
    data = [("a", i, f"m{i}") for i in range(1001)] + [("b", 0, "only")]
    random.Random(1).shuffle(data)
    children = spark.createDataFrame(data, "k string, pos int, text string").repartition(3)
    got = ops.attach_rows(parents, children, "k", "pos", ["text"], "n")
    by_key = defaultdict(list)
    for r in sorted(got.collect(), key=lambda r: (r.k, r.n or 0)):
        by_key[r.k].append((r.n, r.text))
    assert by_key == {"a": [(i + 1, f"m{i}") for i in range(1001)], "b": [(1, "only")], "none": [(None, None)]}
    assert ops.attach_rows(parents, children, "k", "pos", ["text"], "n", keep_childless=False).count() == 1002


def test_attach_rows_splits_a_hot_parent(spark, conf, skewed):
    """A third of the children belong to one parent."""
    children = skewed.withColumn("pos", F.monotonically_increasing_id())
    names = F.when(F.col("id") == 4000, "hot").otherwise(F.concat(F.lit("u"), F.col("id")))
    parents = spark.range(0, 4001).select(names.alias("email"))
    got = ops.attach_rows(parents, children, "email", "pos", ["pad"], "n", heavy_rows=1000)
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < sum(sizes) / 4
    assert got.where("n is not null").count() == 60000


def test_surrogate_key(spark):
    df = spark.range(0, 5000, 1, 7).select((4999 - F.col("id")).alias("id"), F.lit("x").alias("v"))
    got = ops.add_surrogate_key(df, order_by=[F.col("id").desc()])
    assert got.columns == ["id", "source_id", "v"]
    assert all(r.id == 5000 - r.source_id for r in got.collect())
    assert got.count() == 5000
    plain = ops.add_surrogate_key(df)
    assert plain.select("id").distinct().count() == 5000
    assert plain.columns == ["id", "source_id", "v"]


def numbers(df, keys, path, **options):
    got = {}
    for r in ops.stable_surrogate_key(df, keys, path, **options).collect():
        got.setdefault(tuple(r[k] for k in keys), []).append(r["id"])
    return {k: sorted(v) for k, v in got.items()}


@pytest.mark.parametrize("heavy_rows", [100_000, 3])
def test_keys_that_stay(spark, tmp_path, heavy_rows):
    path = str(tmp_path / "keys")
    table = lambda *v: spark.createDataFrame([(x, i) for i, x in enumerate(v)], "v string, at long").repartition(3)
    first = numbers(table(*"bcaaab", None, ""), ["v"], path, heavy_rows=heavy_rows)
    assert first == {(None,): [1], ("",): [2], ("a",): [3, 4, 5], ("b",): [6, 7], ("c",): [8]}
    # some rows gone, some new, some more often
    second = numbers(table(*"aaaaaabbd", None), ["v"], path, heavy_rows=heavy_rows)
    assert second == {(None,): [1], ("a",): [3, 4, 5, 9, 10, 11], ("b",): [6, 7], ("d",): [12]}
    assert numbers(table(*"dcca"), ["v"], path, heavy_rows=heavy_rows) == {("d",): [12], ("c",): [8, 13], ("a",): [3]}
    assert numbers(table(*"dcca"), ["v"], path, heavy_rows=heavy_rows) == {("d",): [12], ("c",): [8, 13], ("a",): [3]}
    assert numbers(table("x").where("false"), ["v"], path) == {}
    # three refreshes met new rows; nothing else was written beside the dictionary
    assert sum(n.startswith("segment-") for n in os.listdir(path)) == 3


def test_keys_of_several_columns_and_an_own_id(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 9), ("a", "b", 8), (None, "ab", 7)], "x string, y string, id long")
    got = ops.stable_surrogate_key(df, ["x", "y", "id"], str(tmp_path / "k"), start=0)
    assert got.columns == ["id", "x", "y", "source_id"]
    assert sorted((r.id, r.source_id) for r in got.collect()) == [(0, 7), (1, 9), (2, 8)]


def test_racing_refreshes_share_a_dictionary(spark, tmp_path):
    path = str(tmp_path / "keys")
    parts = [spark.range(k * 10, k * 10 + 20).withColumnRenamed("id", "v") for k in range(5)]
    with ThreadPoolExecutor(5) as pool:
        got = list(pool.map(lambda df: numbers(df, ["v"], path), parts))
    merged = {}
    for g in got:
        for k, v in g.items():
            assert merged.setdefault(k, v) == v
    assert sorted(n for v in merged.values() for n in v) == list(range(1, 61))


def test_surrogate_key_of_few_or_no_rows(spark):
    few = spark.createDataFrame([("b",), ("a",)], "v string")
    assert rows(ops.add_surrogate_key(few, [F.col("v")], name="n", start=0)) == [(0, "a"), (1, "b")]
    assert ops.add_surrogate_key(few.where("false"), [F.col("v")]).count() == 0


# --- projection and checks -----------------------------------------------------------------


def test_project_pads_with_types(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    got = ops.project(df, {"y": "b", "x": F.col("a") + 1}, pad={"z": "timestamp_ntz"}, order=["x", "z", "y"])
    assert got.dtypes == [("x", "int"), ("z", "timestamp_ntz"), ("y", "string")]
    assert rows(got) == [(2, None, "x")]


def test_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "a"), (None, "a"), (3, "long")], "k int, t string")
    assert rows(ops.violations_unique(df, ["k"])) == [(1, 2)]
    assert rows(ops.violations_unique(df, ["k", "t"])) == [(1, "a", 2)]
    nulls = ops.violations_null(df, ["k", "t"])
    assert sorted(r.violated for r in nulls.collect()) == [["k"], ["k"], ["t"]]
    assert [r.violated for r in ops.violations_length(df, {"t": 3}).collect()] == [["t"]]
    assert tuple(ops.row_audit(df, ["k"]).collect()[0]) == (6, 4, False)
    assert tuple(ops.row_audit(df.where("k > 1"), ["k"]).collect()[0]) == (2, 2, True)


def test_column_types(spark):
    df = spark.createDataFrame([], "a int, b timestamp_ntz, c decimal(10,2), d string")
    declared = {"a": "number", "b": "timestamp", "c": "number", "d": "boolean", "e": "string"}
    assert ops.column_type_mismatches(df, declared) == [("d", "boolean", "string"), ("e", "string", "missing")]


@SLOW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(-9, 25))), max_size=25), st.sampled_from([1, 4, 100]))
def test_runs_and_gaps(spark, values, bucket):
    df = spark.createDataFrame(values, "k string, v int")
    want_runs, want_gaps = [], []
    for k in "ab":
        mine = sorted({v for x, v in values if x == k and v is not None})
        cuts = [i for i in range(1, len(mine)) if mine[i] > mine[i - 1] + 1]
        for i, j in zip([0, *cuts], [*cuts, len(mine)], strict=True):
            want_runs += [(k, mine[i], mine[j - 1], mine[j - 1] - mine[i] + 1)] if mine else []
        want_gaps += [(k, mine[i - 1] + 1, mine[i] - 1, mine[i] - mine[i - 1] - 1) for i in cuts]
    assert sorted(map(tuple, ops.runs(df, ["k"], "v", bucket).collect())) == want_runs
    assert sorted(map(tuple, ops.gaps(df, ["k"], "v", bucket).collect())) == want_gaps


def test_extract_faults(spark):
    pages = [("a", 2, 9), ("a", 3, None), ("a", 3, 9), ("a", 6, 9), ("b", 1, None), ("b", 2, None), ("c", None, 1)]
    items = [("a", 2, 1), ("a", 3, 1), ("a", 3, 2), ("a", 3, 2), ("a", 6, 1), ("b", 1, 1), ("b", 2, None), ("b", 2, None)]
    got = ops.extract_faults(
        spark.createDataFrame(pages, "endpoint string, page long, total_pages long"),
        spark.createDataFrame(items, "endpoint string, page long, id long"),
    )
    assert sorted(map(tuple, got.collect())) == [
        ("a", "missing", 1, 1, 1),
        ("a", "missing", 4, 5, 2),
        ("a", "missing", 7, 9, 3),
        ("a", "overlap", 3, 3, 1),
        ("a", "overlap", 6, 6, 1),
        ("a", "repeated", 3, 3, 1),
    ]
    # landed twice with another missing: as many rows as pages, and yet not complete
    twice = spark.createDataFrame([("x", 1, 4, 2, 2), ("x", 1, 4, 2, 2)], "endpoint string, page long, reported long, total_pages long, item_count long")
    ids = spark.createDataFrame([("x", i) for i in range(4)], "endpoint string, id long")
    assert not ops.page_completeness(twice, ids, "id", limit=2).first().complete


def test_page_completeness(spark):
    pages = spark.createDataFrame(
        [
            # all there: two full pages and a short one, read in another order
            ("users", 3, 5, None, 1), ("users", 1, 5, None, 2), ("users", 2, 5, None, 2),
            # the server repeats its first page
            ("courses", 1, 4, None, 2), ("courses", 2, 4, None, 2), ("courses", 3, 4, None, 0),
            # last announced page not fetched
            ("talks", 1, 6, 3, 2), ("talks", 2, 6, 3, 2),
            ("empty", 1, 0, None, 0),
            # a short page in the middle is not the end
            ("gap", 1, 5, None, 2), ("gap", 2, 5, None, 1), ("gap", 3, 5, None, 2),
            # nothing reported: unknown if the end was reached, else not complete
            ("silent", 1, None, None, 1),
            ("cut", 1, None, None, 2),
        ],
        "endpoint string, page long, reported long, total_pages long, item_count long",
    )
    items = [("users", i) for i in range(5)] + [("courses", i % 2) for i in range(4)] + [("talks", i) for i in range(4)]
    items += [("gap", i) for i in range(5)] + [("silent", 0), ("cut", 0), ("cut", 1)]
    got = ops.page_completeness(pages, spark.createDataFrame(items, "endpoint string, id long"), "id", limit=2)
    assert {r.endpoint: (r.fetched, r.distinct_ids, r.complete) for r in got.collect()} == {
        "users": (5, 5, True),
        "courses": (4, 2, False),
        "talks": (4, 4, False),
        "empty": (0, 0, True),
        "gap": (5, 5, False),
        "silent": (1, 1, None),
        "cut": (2, 2, False),
    }
