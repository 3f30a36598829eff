"""Every registered query against its SQL, and against the plan it should have."""

from __future__ import annotations

import pathlib
import re

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import TABLES, compare
from leadloom import sources
from leadloom.bindings import CATALOG, derive, load
from tests.helpers import first_plan

NAMES = sorted(CATALOG.queries)


@pytest.fixture(scope="module")
def con(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_small}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.queries())
    assert set(CATALOG.sql) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, sf_small, name):
    text, ok = compare(spark, con, sf_small, name)
    assert ok, text


@pytest.mark.parametrize("name", NAMES)
def test_plan_is_native_and_distributed(spark, sf_small, name):
    df = contract.queries()[name](spark, sf_small)
    plan = first_plan(df)
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct"):
        assert operator not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["contact_key", "email", "phone_number"]
    assert not df.isEmpty()


def test_scans_read_only_what_they_need(spark, conf, sf_small):
    conf(spark__sql__maxMetadataStringLength="10000")
    queries = contract.queries()
    plan = first_plan(queries["scan_query"](spark, sf_small))
    assert "EqualTo(o_orderstatus,F)" in plan and "GreaterThan(o_totalprice,1000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
    plan = first_plan(queries["agg_distinct_days"](spark, sf_small))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_models_read_single_json_fields(spark, conf, sf_small):
    conf(spark__sql__maxMetadataStringLength="10000")
    plan = first_plan(contract.queries()["agg_enrollments"](spark, sf_small))
    # the scan returns the e-mail, not the user document
    assert "user_data:struct<0:string>" in plan


def test_lookups_are_broadcast(spark, sf_small):
    plan = first_plan(contract.queries()["mart_materials"](spark, sf_small))
    # only the course is looked up: the user's fields come with the material
    assert plan.count("BroadcastHashJoin") == 1
    assert "Exchange hashpartitioning" not in plan


def test_deduplications_limit_before_the_shuffle(spark, sf_small):
    plan = first_plan(contract.queries()["int_all_marketing_leads"](spark, sf_small))
    assert plan.count("WindowGroupLimit") == 6


def test_sheets_are_written_by_many_tasks(spark, conf, tmp_path, sf_small, monkeypatch):
    documents = [(i, f'line {i}\n"quoted", and more', None if i % 5 == 0 else "web") for i in range(40)]
    orders = [(i, f"{i % 3}-LOW") for i in range(40)]
    spark.createDataFrame(documents, "doc_id long, text string, source string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string").repartition(4).write.parquet(f"{tmp_path}/orders.parquet")
    conf(spark__sql__files__openCostInBytes="1000000000")  # a task per file
    read = []
    whole = sources.read_sheet
    monkeypatch.setattr(load.src, "read_sheet", lambda s, path, **k: read.append(path) or whole(s, path, **k))
    got = contract.queries()["scan_sheet_line_breaks"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted((str(i), t, s or "") for i, t, s in documents)
    got = contract.queries()["scan_sheet_header_row"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted((str(i), p) for i, p in orders)
    assert [len(list(pathlib.Path(p).glob("*.csv"))) for p in read] == [4, 4, 4]


def test_derived_tables_run_in_methods_that_are_compiled(spark, capsys, sf_small):
    """The JVM interprets methods of more than 8,000 bytes."""
    for name in ("eduqat_enrollments", "purchase_form_data"):
        capsys.readouterr()
        derive.raw_text(spark, sf_small, name).explain("codegen")
        derive.parsed(spark, sf_small, name).explain("codegen")
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)
        assert sizes and max(map(int, sizes)) < 8000
