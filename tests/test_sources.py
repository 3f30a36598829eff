from __future__ import annotations

import csv
import datetime as dt
import io
import json
import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadloom import plans, session
from leadloom import sources as src
from leadloom.bindings import derive
from leadloom.build import (
    ContractViolation,
    land_raw,
    load_ai_conversations,
    load_api_items,
    load_lead_sheets,
    load_source_table,
    raw_violations,
)
from leadloom.commits import _Folder
from leadloom.operators import split_rejects
from leadloom.schemas import RAW, item_fields, source_query
from leadloom.session import ensure_checkpoint_dir, shared_path
from leadloom.sources.api_pages import read_pages
from leadloom.sources.records import _line_states
from leadloom.sources.tables import jdbc_options
from tests.helpers import rows

BATCH = "2024-06-10 00:00:00"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


# --- sheets ------------------------------------------------------------------------


@pytest.mark.parametrize(
    "typed, name",
    [
        (" No. HP/Telp ", "no_hp_telp"),
        ("Full Name", "full_name"),
        ("__A--b!!c__", "a_b_c"),
        ("Pendapatan (per bulan)?", "pendapatan_per_bulan"),
        ("ÉMAIL", "mail"),
        ("x", "x"),
    ],
)
def test_normalize_headers(typed, name):
    assert src.normalize_headers([typed]) == [name]


def test_header_names_are_cut(spark):
    assert src.normalize_headers(["a" * 80], max_bytes=63) == ["a" * 63]


def test_read_sheet_pads_and_cuts(spark, tmp_path):
    path = put(tmp_path / "s.csv", 'Email ,No. HP/Telp,Note\na@b.c\nx,y,z,extra\n,"0812, 3","say ""hi"""\n')
    df = src.read_sheet(spark, path)
    assert df.columns == ["email", "no_hp_telp", "note"]
    assert rows(df) == [("", "0812, 3", 'say "hi"'), ("a@b.c", "", ""), ("x", "y", "z")]


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("split", ["128MB", "250B"])
def test_read_sheet_below_a_title(spark, conf, tmp_path, split, multi_line):
    conf(spark__sql__files__maxPartitionBytes=split)
    body = "".join(f"v{i},w{i}\n" for i in range(60))
    path = put(tmp_path / "s.csv", f"Report\nmade,today,by,us\nA,B\n{body}Report\n")
    df = src.read_sheet(spark, path, header_row=2, multi_line=multi_line)
    assert df.columns == ["a", "b"]
    # a later row that looks like the title stays
    assert rows(df) == sorted([(f"v{i}", f"w{i}") for i in range(60)] + [("Report", "")])


def test_read_sheet_of_several_files_below_a_title(spark, tmp_path):
    for n in range(3):
        put(tmp_path / "sheet" / f"{n}.csv", f"title\nA,B\n{n},x\n{n},y\n")
    df = src.read_sheet(spark, str(tmp_path / "sheet"), header_row=1)
    assert rows(df) == [(str(n), v) for n in range(3) for v in "xy"]


def test_read_sheet_with_line_breaks(spark, tmp_path):
    path = put(tmp_path / "s.csv", '"Bidang\nusaha",B\n"one\ntwo",x\n')
    df = src.read_sheet(spark, path)
    assert df.columns == ["bidang_usaha", "b"]
    assert rows(df) == [("one\ntwo", "x")]


def test_headers_of_any_height(spark, tmp_path):
    tall = '"Nama' + "\n" * 70 + 'lengkap",B,Provinsi\n1,2,3\n'
    df = src.read_sheet(spark, put(tmp_path / "a.csv", tall))
    assert df.columns == ["nama_lengkap", "b", "provinsi"] and rows(df) == [("1", "2", "3")]
    title = '"Judul' + "\n" * 700 + '",x\nA,B,C\n1,2,3\n'
    df = src.read_sheet(spark, put(tmp_path / "b.csv", title), header_row=1)
    assert df.columns == ["a", "b", "c"] and rows(df) == [("1", "2", "3")]
    with pytest.raises(ValueError, match="no readable header"):
        src.read_sheet(spark, put(tmp_path / "c.csv", "only a title\n"), header_row=1)
    with pytest.raises(ValueError, match="no readable header"):
        src.read_sheet(spark, put(tmp_path / "d.csv", '"never closed,B\n1,2\n'))


def by_machine(text):
    """Records of a text, character by character."""
    out, record, cell, state = [], [], "", "start"
    text = text + "\n" if text and not text.endswith("\n") else text
    for c in text:
        if state == "quoted":
            state = "closing" if c == '"' else state
            cell += "" if c == '"' else c
        elif state == "closing" and c == '"':
            cell, state = cell + '"', "quoted"
        elif c in ",\n":
            record.append(cell)
            if c == "\n":
                if record != [""] or state != "start":
                    out.append(record)
                record = []
            cell, state = "", "start"
        elif c == '"' and state == "start":
            state = "quoted"
        else:
            cell, state = cell + c, "plain"
    return out if state == "start" else None


@given(st.text(alphabet='a",\n', max_size=60))
def test_line_states(text):
    """The state after every line is that of a machine that reads characters."""
    after, state = _line_states(True), 0
    for line in text.split("\n"):
        state = after(line, state)
    # an open quote swallows the end
    assert (by_machine(text) is None) == bool(state)


def sheet_text(rng, rows):
    cell = lambda: "".join(rng.choice(list('ab"\n, é'), int(rng.integers(0, 9))))
    quoted = lambda c: '"' + c.replace('"', '""') + '"'
    plain = lambda c: c.replace(",", "").replace("\n", "").lstrip('"')
    lines = ['"Kolom\n""A""",B,C']
    for _ in range(rows):
        cells = [cell() for _ in range(3)]
        lines.append(",".join(quoted(c) if rng.random() < 0.7 else plain(c) or "x" for c in cells))
    return lines


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("chunk_chars", [1, 40, 10_000])
def test_cells_over_the_borders_of_chunks(spark, tmp_path, chunk_chars, end):
    rng = np.random.default_rng(chunk_chars)
    files = {n: end.join(sheet_text(rng, 40)) + end for n in "xyz"}
    for n, text in files.items():
        (tmp_path / "s").mkdir(exist_ok=True)
        (tmp_path / "s" / f"{n}.csv").write_bytes(text.encode())
    df = src.read_sheet(spark, str(tmp_path / "s"), chunk_chars=chunk_chars)
    want = []
    for text in files.values():
        # line ends inside quotes are data, those that end a record are not
        want += [tuple(c for c in r) for r in csv.reader(io.StringIO(text, newline=""))][1:]
    assert df.columns == ["kolom_a", "b", "c"]
    assert rows(df) == sorted(want, key=lambda r: [(True, v) for v in r])


def test_splits_of_one_file(spark, conf, tmp_path):
    """Spark cuts the file inside cells; text that looks like rows stays in its cell."""
    rng = np.random.default_rng(8)
    body = "".join(f'{i},"{"9,9" + chr(10)}{"x" * int(rng.integers(0, 50))}",end\n' for i in range(200))
    path = put(tmp_path / "s.csv", f"A,B,C\n{body}")
    conf(spark__sql__files__maxPartitionBytes="2KB", spark__sql__files__openCostInBytes="1")
    assert spark.read.text(path).rdd.getNumPartitions() > 3
    got = src.read_sheet(spark, path).collect()
    assert sorted(int(r.a) for r in got) == list(range(200)) and {r.c for r in got} == {"end"}
    assert all(r.b.startswith("9,9\n") for r in got)


def test_headers_must_agree(spark, tmp_path):
    put(tmp_path / "s" / "1.csv", "A,B\n1,2\n")
    put(tmp_path / "s" / "2.csv", "B,A\n1,2\n")
    put(tmp_path / "s" / "3.csv", "")
    with pytest.raises(ValueError, match="another header"):
        src.read_sheet(spark, str(tmp_path / "s"))


def test_unclosed_cell_far_from_the_header(spark, tmp_path):
    path = put(tmp_path / "s.csv", "A,B\n" + "1,2\n" * 500 + '1,"2\n' + "1,2\n" * 500)
    with pytest.raises(ValueError, match="never closes in .*s.csv"):
        src.read_sheet(spark, path, chunk_chars=100)


def test_empty_sheet_and_bad_headers(spark, tmp_path):
    empty = src.read_sheet(spark, put(tmp_path / "e.csv", ""))
    assert empty.columns == [] and empty.count() == 0
    assert src.read_sheet(spark, put(tmp_path / "h.csv", "A,B\n")).count() == 0
    with pytest.raises(ValueError, match="repeated headers"):
        src.read_sheet(spark, put(tmp_path / "d.csv", "A b,a_B\n1,2\n"))
    with pytest.raises(ValueError, match="empty"):
        src.read_sheet(spark, put(tmp_path / "n.csv", "A,??\n1,2\n"))


def test_sheet_round_trip(spark, tmp_path):
    data = [("  x ", dt.datetime(2024, 1, 2, 3, 4, 5), None), ('q"u,o\nte', None, 7), ("", None, None)]
    df = spark.createDataFrame(data, "`No. A` string, t timestamp_ntz, n int").repartition(3)
    path = str(tmp_path / "out")
    src.write_sheet(df, path)
    src.write_sheet(df, path)
    back = src.read_sheet(spark, path)
    assert back.columns == ["no_a", "t", "n"]
    assert rows(back) == [("", "", ""), ("  x ", "2024-01-02 03:04:05", ""), ('q"u,o\nte', "", "7")]


def test_write_sheet_with_index(spark, tmp_path):
    path = str(tmp_path / "out")
    src.write_sheet(spark.createDataFrame([("b",), ("a",)], "v string"), path, include_index=True)
    assert rows(src.read_sheet(spark, path)) == [("0", "a"), ("1", "b")]


def test_rename_synonyms(spark):
    df = spark.createDataFrame([("1", "2", "3", "4")], ["no_hp_telp", "no_telp", "full_name", "other"])
    got = src.rename_synonyms(df)
    assert got.columns == ["phone_number", "no_telp", "nama_pemilik_usaha", "other"]
    taken = spark.createDataFrame([("1", "2")], ["phone_number", "no_telp"])
    assert src.rename_synonyms(taken).columns == ["phone_number", "no_telp"]


def test_rename_synonyms_coalesce(spark):
    df = spark.createDataFrame([("", "2", "x"), (None, None, "y"), ("1", "2", "z")], "no_telp string, phone_number string, o string")
    got = src.rename_synonyms(df, mode="coalesce_all")
    assert got.columns == ["o", "phone_number"]
    assert sorted(got.collect()) == [("x", "2"), ("y", None), ("z", "2")]
    with pytest.raises(ValueError):
        src.rename_synonyms(df, mode="other")


def test_load_lead_sheets(spark, tmp_path):
    long_header = "Bidang usaha yang sedang dijalankan saat ini cth pakaian makanan minuman"
    a = put(tmp_path / "a.csv", f"id,Email,No. HP/Telp,{long_header}\n9,a@b.c,0812,kopi\n")
    b = put(tmp_path / "b.csv", "Email,Created Time\nx@y.z,2024-01-01\n")
    t = put(tmp_path / "t.csv", "Email\nskip@me.com\n")
    e = put(tmp_path / "e.csv", "Only Header\n")
    got = load_lead_sheets(spark, {"A": a, "B": b, "T": t, "E": e}, "leads_ads_community", BATCH, exclude=["T"])
    assert got.columns == [
        "id", "source_id", "email", "phone_number",
        "bidang_usaha_yang_sedang_dijalankan_saat_ini_cth_pakaian_makana",
        "sheet_name", "timestamp", "data_source", "extracted_at", "loaded_at",
    ]
    assert rows(got.select("source_id", "email", "sheet_name", "timestamp", "extracted_at")) == [
        (None, "x@y.z", "B", "2024-01-01", BATCH),
        ("9", "a@b.c", "A", None, BATCH),
    ]


def test_lead_ids_stay_at_the_next_load(spark, tmp_path):
    path, keys = tmp_path / "a.csv", str(tmp_path / "keys")
    put(path, "id,Email\n9,a@b.c\n8,x@y.z\n")
    load = lambda batch: load_lead_sheets(spark, {"A": str(path)}, "leads_ads_community", batch, key_dictionary=keys)
    assert rows(load(BATCH).select("id", "source_id", "email")) == [(1, "8", "x@y.z"), (2, "9", "a@b.c")]
    put(path, "id,Email\n1,new@y.z\n9,a@b.c\n")
    assert rows(load("2024-06-11 00:00:00").select("id", "source_id", "email")) == [(2, "9", "a@b.c"), (3, "1", "new@y.z")]


def test_sheet_paths(spark, tmp_path):
    put(tmp_path / "wb" / "Sheet 1.csv", "A\n1\n")
    put(tmp_path / "wb" / "Two" / "part-0.csv", "A\n2\n")
    put(tmp_path / "wb" / "_SUCCESS", "")
    paths = src.sheet_paths(spark, str(tmp_path / "wb"))
    assert list(paths) == ["Sheet 1", "Two"]
    assert rows(src.read_all_sheets(spark, paths)) == [("1", "Sheet 1"), ("2", "Two")]


# --- pages --------------------------------------------------------------------------


def test_pages_one_document_per_file(spark, tmp_path):
    for page in range(3):
        items = [{"id": page * 2 + i, "name": f"n{i}", "extra": 1} for i in range(2)]
        put(tmp_path / "p" / f"{page}.json", json.dumps({"count": 6, "items": items}, indent=1))
    put(tmp_path / "p" / "9.json", json.dumps({"count": 6, "items": []}))
    got = src.read_api_pages(spark, str(tmp_path / "p"), "id long, name string")
    assert rows(got.select("id")) == [(i,) for i in range(6)]
    assert got.where(F.col("page_file").endswith("1.json")).count() == 2
    stats = src.page_stats(read_pages(spark, str(tmp_path / "p"), "id long"), F.lit("users"))
    assert rows(stats) == [("users", 0, 6, None, 2), ("users", 1, 6, None, 2), ("users", 2, 6, None, 2), ("users", 9, 6, None, 0)]


def test_pages_with_meta_and_positions(spark, tmp_path):
    doc = {"code": 200, "message": "Success", "data": [{"id": 5}, {"id": 4}], "meta": {"total_pages": 2, "total_count": 3}}
    path = put(tmp_path / "p" / "1.json", json.dumps(doc))
    pages = read_pages(spark, path, "id long", items_field="data")
    assert rows(src.explode_pages(pages, "data", position="pos")) == [(0, 5), (1, 4)]
    assert rows(src.page_stats(pages, F.lit("x"), "data")) == [("x", 1, 3, 2, 2)]


def test_items_keep_json_and_broken_pages_are_set_apart(spark, tmp_path):
    items = [
        {"id": "e1", "metadata": {"a": [1, {"b": None}]}, "certificates": [], "created_at": "2024-01-01T08:00:00+07:00"},
        {"id": "e2", "order_data": False, "course_id": 7, "learning_progress": 12.5},
    ]
    put(tmp_path / "p" / "1.json", json.dumps({"count": 2, "items": items}))
    put(tmp_path / "p" / "2.json", '{"count": 2, "items": [{"id"')
    pages = src.read_pages(spark, str(tmp_path / "p"), item_fields("eduqat_enrollments"))
    good, rejects = split_rejects(pages)
    assert [r.page_file.rsplit("/")[-1] for r in rejects.collect()] == ["2.json"]
    raw = load_api_items(src.explode_pages(good), "eduqat_enrollments", BATCH)
    assert raw.columns == list(RAW["eduqat_enrollments"])
    got = {r.id: r for r in src.json_text_column(raw, "metadata", "certificates", "order_data").collect()}
    assert got["e1"].metadata == '{"a":[1,{"b":null}]}'
    assert got["e1"].certificates is None and got["e1"].created_at == dt.datetime(2024, 1, 1, 8)
    assert got["e2"].order_data is None and (got["e2"].course_id, got["e2"].learning_progress) == (7, 12.5)


@pytest.mark.parametrize("table", [t for t in RAW if t.startswith("eduqat_") and "survey" not in t])
def test_item_fields_are_readable(spark, tmp_path, table):
    path = put(tmp_path / "1.json", json.dumps({"count": 1, "items": [{"id": 1}]}))
    assert src.read_api_pages(spark, path, item_fields(table)).count() == 1


# --- tables ------------------------------------------------------------------------


def test_source_queries(spark):
    assert source_query("purchase_form_data") == (
        "SELECT customer_name, customer_email, customer_phone, created_at, paid_at, product_type, "
        "course_id, amount, payment_method, payment_channel FROM payments"
    )
    extract = spark.createDataFrame([("n", "a@b.c", "0812")], ["customer_name", "customer_email", "customer_phone"])
    row = load_source_table(extract, "purchase_form_data", BATCH).collect()[0]
    assert (row.customer_name, row.email, row.phone_number) == ("n", "a@b.c", "0812")


def test_empty_json_is_kept_where_declared(spark):
    users = spark.createDataFrame([("u1", [])], "id string, interests array<string>")
    raw = src.json_text_column(load_source_table(users, "users", BATCH), "interests")
    assert raw.collect()[0].interests == "[]"


def test_read_source_prunes_columns(spark, sf_small):
    df = src.read_source(spark, f"{sf_small}/orders.parquet", columns=["o_orderkey"])
    assert "ReadSchema: struct<o_orderkey:bigint>" in df._jdf.queryExecution().executedPlan().toString()
    df = src.read_source(spark, f"{sf_small}/orders.parquet", query="select o_orderkey from src where o_custkey = 3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,3)" in plan
    bound = src.read_source(
        spark, f"{sf_small}/nation.parquet", query="select n_name from src where n_nationkey = :k", params={"k": 4}
    )
    assert rows(bound) == [("NATION_4",)]
    with pytest.raises(ValueError):
        src.read_source(spark, {"url": "jdbc:x"}, query="select :k", params={"k": 1})
    spark.range(1).createOrReplaceTempView("src")
    named = "with few as (select n_name from src where n_nationkey < 2) select * from few"
    assert src.read_source(spark, f"{sf_small}/nation.parquet", query=named).count() == 2
    assert spark.table("src").columns == ["id"]
    src.read_source(spark, f"{sf_small}/nation.parquet").createOrReplaceTempView("nations")
    assert src.read_source(spark, "nations").count() == 25


def test_jdbc_options():
    conn = {"url": "jdbc:postgresql://db/x", "driver": "org.postgresql.Driver"}
    plain = jdbc_options(conn, "select 1", None)
    assert plain["query"] == "select 1" and "dbtable" not in plain
    split = jdbc_options(conn, "select id from users", {"column": "id", "lower": 0, "upper": 100, "num": 8})
    assert split["dbtable"] == "(select id from users) AS src"
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "100", "8")
    assert "query" not in split


def test_full_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    assert src.full_refresh(spark.range(5), path) == 5
    # new rows and a new schema
    assert src.full_refresh(spark.range(3).withColumn("x", F.lit("a")), path) == 3
    begun = src.read_source(spark, path)
    assert begun.columns == ["id", "x"]
    # an empty extract leaves the table
    assert src.full_refresh(spark.range(0), path) == 0
    assert src.read_source(spark, path).count() == 3
    assert src.full_refresh(spark.range(0), path, skip_if_empty=False) == 0
    assert src.read_source(spark, path).count() == 0
    # who began with a version before can still read it, also after two refreshes
    src.full_refresh(spark.range(9), path)
    assert begun.count() == 3
    assert [v.rows for v in src.versions(spark, path)] == [5, 3, 0, 9]
    assert src.read_source(spark, path, version=1).columns == ["id", "x"]
    assert src.read_source(spark, path, query="select count(*) as n from src", version=0).first().n == 5
    with pytest.raises(ValueError, match="keeps no version 7"):
        src.read_source(spark, path, version=7)
    # replaced versions go when their time is over
    src.full_refresh(spark.range(1), path, retain_seconds=0)
    assert [v.number for v in src.versions(spark, path)] == [4]
    assert len(data_folders(path)) == 1


def data_folders(path):
    return [n for n in os.listdir(path) if n.startswith("data-")]


def test_a_refresh_that_must_follow_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    src.full_refresh(spark.range(5), path, expected=-1)
    src.full_refresh(spark.range(6), path, expected=0)
    with pytest.raises(src.ConcurrentRefresh, match="version 1 is current, not 0"):
        src.full_refresh(spark.range(7), path, expected=0)
    assert src.read_source(spark, path).count() == 6 and len(data_folders(path)) == 2


def test_racing_refreshes_are_all_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(6) as pool:
        rows = list(pool.map(lambda n: src.full_refresh(spark.range(n), path), range(1, 13)))
    assert rows == list(range(1, 13))
    made = src.versions(spark, path)
    assert [v.number for v in made] == list(range(12)) and sorted(v.rows for v in made) == rows
    assert src.read_source(spark, path).count() == made[-1].rows
    # of those that must follow the same version one gets through
    def follow(n):
        try:
            return src.full_refresh(spark.range(n), path, expected=11)
        except src.ConcurrentRefresh:
            return None

    with ThreadPoolExecutor(4) as pool:
        got = [n for n in pool.map(follow, range(1, 5)) if n is not None]
    assert len(got) == 1 and src.read_source(spark, path).count() == got[0]
    assert len(data_folders(path)) == 13


def test_the_name_of_a_version_is_taken_once(spark, tmp_path):
    folder = _Folder(spark, str(tmp_path))
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: folder.put_if_absent("_commits/1.json", str(n)), range(24)))
    assert won.count(True) == 1 and folder.read("_commits/1.json") == str(won.index(True))
    assert folder.names("_commits") == ["1.json"]


def test_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    src.full_refresh(spark.range(5), path)
    spark.range(2).write.parquet(f"{path}/data-left")
    assert src.vacuum(spark, path) == []
    assert src.vacuum(spark, path, older_than_seconds=-1) == ["data-left"]
    assert src.read_source(spark, path).count() == 5


def test_full_refresh_keeps_the_table_when_the_job_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    src.full_refresh(spark.range(5), path)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        src.full_refresh(broken, path)
    assert src.read_source(spark, path).count() == 5
    assert len(data_folders(path)) == 1


def test_materialize(spark, tmp_path):
    view = src.materialize(spark.range(3), "v_test")
    assert spark.table("v_test").count() == view.count() == 3
    table = src.materialize(spark.range(4), "t_test", "table", str(tmp_path))
    assert "FileScan parquet" in table._jdf.queryExecution().executedPlan().toString()
    assert table.count() == 4
    with pytest.raises(ValueError):
        src.materialize(spark.range(1), "x", "table")


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == configured
    assert shared_path(spark, "x").startswith(configured)
    assert shared_path(spark, "x") != shared_path(spark, "x")


def test_release_shared(spark, monkeypatch):
    """Only the application's own folder goes."""
    monkeypatch.setattr(session, "_application_folder", lambda s: f"{ensure_checkpoint_dir(s)}/leadloom/other-app")
    path = shared_path(spark, "t")
    spark.range(3).write.parquet(path)
    keep = f"{ensure_checkpoint_dir(spark)}/keep"
    spark.range(3).write.mode("overwrite").parquet(keep)
    session.release_shared(spark)
    assert not os.path.exists(os.path.dirname(path)) and os.path.exists(keep)


def test_released_raw_tables_are_landed_again(spark, monkeypatch, sf_small):
    derive.forget_landed()
    monkeypatch.setattr(session, "_application_folder", lambda s: f"{ensure_checkpoint_dir(s)}/leadloom/third-app")
    n = derive.raw(spark, sf_small, "users").count()
    session.release_shared(spark)
    assert derive.raw(spark, sf_small, "users").count() == n
    derive.forget_landed()


# --- load steps -----------------------------------------------------------------------


def test_typed_load(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01T08:00:00+07:00", "3.5", "[1]", [], "extra")],
        "id string, created_at string, rating string, tags string, images array<int>, other string",
    )
    schema = {"id": "int", "created_at": "timestamp_ntz", "rating": "decimal(38,6)", "tags": "variant", "images": "variant", "name": "varchar(5)"}
    got = src.typed_load(df, schema)
    assert [t for _, t in got.dtypes] == ["int", "timestamp_ntz", "decimal(38,6)", "variant", "variant", "string"]
    row = src.json_text_column(got, "tags", "images").collect()[0]
    assert row.created_at == dt.datetime(2024, 1, 1, 8) and row.tags == "[1]" and row.images is None and row.name is None


def test_typed_load_strictness(spark):
    df = spark.createDataFrame([("3.0", "{"), ("4", "{\"a\":1}")], "id string, j string")
    schema = {"id": "int", "j": "variant"}
    with pytest.raises(Exception):
        src.typed_load(df, schema).collect()
    loose = src.json_text_column(src.typed_load(df, schema, strict=False), "j")
    assert rows(loose) == [(None, None), (4, '{"a":1}')]


def test_too_long_text(spark):
    df = spark.createDataFrame([("abcd",), (None,)], "name string")
    with pytest.raises(Exception, match=r"value too long for name varchar\(3\)"):
        src.typed_load(df, {"name": "varchar(3)"}).collect()
    assert src.typed_load(df, {"name": "varchar(3)"}, strict=False).count() == 2
    assert src.typed_load(df, {"name": "varchar(4)"}).count() == 2


def test_raw_violations(spark):
    users = spark.createDataFrame([(1, "a" * 51), (1, "b"), (None, None)], "id int, role string")
    raw = src.typed_load(users, RAW["eduqat_users"], strict=False)
    assert rows(raw_violations({"eduqat_users": raw})) == [
        ("eduqat_users", "length", 1),
        ("eduqat_users", "not null id", 1),
        ("eduqat_users", "unique id", 1),
    ]


def test_contract_of_landed_rows(spark, tmp_path):
    path = str(tmp_path / "users")
    load = lambda *r: src.typed_load(spark.createDataFrame(r, "id int, role string").repartition(3), RAW["eduqat_users"], strict=False)
    version, violations = land_raw(load((1, "a"), (2, "b")), "eduqat_users", path, refuse=True)
    assert version.rows == 2 and violations == {"length": 0, "not null id": 0, "unique id": 0}
    bad = load((1, "a" * 51), (1, "b"), (None, None))
    with pytest.raises(ContractViolation, match="1 rows or keys break length, 1 .* not null id, 1 .* unique id"):
        land_raw(bad, "eduqat_users", path, refuse=True)
    assert src.read_source(spark, path).count() == 2 and len(data_folders(path)) == 1
    version, violations = land_raw(bad, "eduqat_users", path)
    assert version.number == 1 and set(violations.values()) == {1}


def test_retype_and_parse_items(spark):
    df = spark.createDataFrame([(1, True), (2, None)], "id int, flag boolean")
    assert rows(src.json_text_column(src.retype(df, "flag"), "flag")) == [(1, "true"), (2, None)]
    items = spark.createDataFrame([(1, "{}"), (2, "{"), (3, None)], "id int, body string")
    good, bad = src.parse_items(items, "body")
    assert rows(good.select("id")) == [(1,)]
    assert rows(bad) == [(2, "{"), (3, None)]


def test_load_source_table_and_items(spark):
    users = spark.createDataFrame([("u1", "a@b.c", ["x"])], "id string, email string, interests array<string>")
    got = load_source_table(users, "users", BATCH)
    assert got.columns == list(RAW["users"])
    row = src.json_text_column(got, "interests").collect()[0]
    assert (row.data_source, row.interests, row.extracted_at) == ("users", '["x"]', dt.datetime(2024, 6, 10))

    items = spark.createDataFrame(
        [("e1", [], {"a": 1})], "id string, certificates array<struct<id:string>>, metadata map<string,int>"
    )
    got = src.json_text_column(load_api_items(items, "eduqat_enrollments", BATCH), "certificates", "metadata")
    row = got.collect()[0]
    assert (row.certificates, row.metadata) == (None, '{"a":1}')


def test_load_ai_conversations(spark):
    conv = spark.createDataFrame([(1, "c1", ("x",)), (2, "c2", None)], "id int, conversation_id string, user struct<name:string>")
    msgs = spark.createDataFrame(
        [("c1", 1, "ai", "b"), ("c1", 0, "human", "a")], "conversation_id string, position int, sender string, value string"
    )
    raw, said = load_ai_conversations(conv, msgs, BATCH)
    got = {r.id: r for r in src.json_text_column(raw, "user_data").collect()}
    assert got[1].user_data == '{"name":"x"}' and got[2].user_data is None
    assert rows(said.select("conversation_id", "position", "sender", "value")) == [("c1", 0, "human", "a"), ("c1", 1, "ai", "b")]


def test_a_long_conversation_keeps_its_keys(spark):
    conv = spark.createDataFrame([(1, "c1")], "id int, conversation_id string")
    msgs = spark.range(1001).select(
        F.lit("c1").alias("conversation_id"), F.col("id").cast("int").alias("position"), F.col("id").cast("string").alias("value")
    )
    raw, said = load_ai_conversations(conv, msgs, BATCH)
    found = raw_violations({"eduqat_ai_conversations": raw, "eduqat_ai_messages": said})
    assert found.where("violations > 0").isEmpty()
    staged = plans.stg_eduqat_ai_conversations(raw, said).select("message_order", "message_content")
    assert sorted(staged.collect()) == [(i + 1, str(i)) for i in range(1001)]


def test_survey_worklist_and_load(spark):
    survey = lambda **kw: {"type": "survey", "survey_type": "survey", "completed_at": "2024-01-01T00:00:00Z", **kw}
    materials = {
        "1": survey(survey_id="s1"),
        "2": survey(survey_id=""),
        "3": survey(survey_type="quiz"),
        "4": survey(completed_at=None),
        "5": {"type": "video"},
    }
    docs = [("e1", json.dumps({"materials": materials})), ("e2", "{}"), ("e3", None)]
    df = spark.createDataFrame([(i, 7, "u", d) for i, d in docs], "id string, course_id int, user_id string, t string")
    work = src.survey_worklist(df.withColumn("completions", F.parse_json("t")))
    assert rows(work.select("enrollment_id", "material_id", "survey_id")) == [("e1", "1", "s1"), ("e1", "2", "")]
    results = [("e1", "1", '{"id":"r1","elements":[]}'), ("e1", "2", '{"id":"r2","title":"T","elements":[{"question":"q"}]}'), ("e9", "1", "{}")]
    landed = spark.createDataFrame(results, "enrollment_id string, material_id string, t string")
    loaded = src.survey_load(work, landed.select("enrollment_id", "material_id", F.parse_json("t").alias("survey_data")), "s", BATCH)
    got = rows(src.json_text_column(loaded, "elements").select("material_id", "survey_id", "survey_title", "elements"))
    assert got == [("1", "s1", None, None), ("2", "r2", "T", '[{"question":"q"}]')]
