"""Landed files to metrics: sheets, pages and extracts through every layer."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from leadloom import plans
from leadloom import sources as src
from leadloom.build import (
    build_models,
    load_ai_conversations,
    load_api_items,
    load_lead_sheets,
    load_source_table,
    raw_violations,
)
from leadloom.schemas import RAW, item_fields
from tests.helpers import rows

BATCH = "2024-06-10 00:00:00"
MAKANA = "Bidang usaha yang sedang dijalankan saat ini cth pakaian makanan"
COMMON = "Email,No. HP/Telp,Full Name,Nama Usaha,Nama akun media sosial,Nama akun ecommerce,Lama Usaha,Provinsi Usaha,Pendapatan Bulanan,Memiliki NIB,Created Time"


def sheet(path, headers, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(headers), *lines]) + "\n", encoding="utf-8")
    return str(path)


def page(path, body):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(body), encoding="utf-8")


def lead(email, phone, name, age, income, when):
    return f"{email},{phone},{name},Usaha,@ig,toko,{age},Jawa,{income},Ya,{when}"


def load_leads(spark, tmp_path):
    common = COMMON.split(",")
    budi_old = lead(" Budi@Mail.com ", "0812 000 0001", "Budi Old", "1-2_tahun", "dibawah_10_juta", "2024-01-01")
    budi_new = lead("budi@mail.com", "+62 812-000-0001", "Budi", "diatas_10_tahun", "10 - 30 juta", "2024-02-01")
    extra = "Tergabung Komunitas UMKM,Memiliki Sertifikasi Halal"
    # the name is cut at 63 bytes when the sheet is landed
    sheets = {
        "leads_ads_community": (
            [*common, MAKANA, "Saat ini sudah memiliki berapa karyawan", *extra.split(",")],
            [budi_old + ",kopi,0,Ya,Tidak", budi_new + ",kopi,3-5 Karyawan,Ya,Tidak"],
        ),
        "website_form_responses": (
            [*common, "Bidang Usaha", "Di kota mana Anda menjalankan usaha Anda", "Berapa jumlah karyawan yang Anda miliki"],
            [lead("budi@mail.com", "08120000001", "Budi Web", "x", "y", "2023-01-01") + ",teh, Kota ,lebih_dari_10"],
        ),
        "leads_course_strategi_ads": (
            [*common, MAKANA, "Sebutkan nama kota kabupaten tempat usaha kamu beroperasi"],
            [lead("", "0813 000 0002", "Sari", "", "", "") + ",baju,"],
        ),
        "branding_level_up": (
            [*common, MAKANA, *extra.split(",")],
            [lead("not-an-email", "123", "Nobody", "", "", "") + ",roti,,"],
        ),
    }
    raw = {}
    for name, (headers, lines) in sheets.items():
        folder = tmp_path / "sheets" / name
        sheet(folder / "Form 1.csv", headers, *lines)
        raw[name] = load_lead_sheets(spark, src.sheet_paths(spark, str(folder)), name, BATCH)
    return raw


def load_platform(spark, tmp_path):
    base = tmp_path / "pages"
    users = [
        {"id": 1, "user_id": 11, "name": "Budi Akun", "email": "budi@mail.com", "role": "learner", "created_at": "2024-12-30T01:00:00Z"},
        {"id": 2, "user_id": 12, "name": "Tuti", "email": "tuti@mail.com", "role": "learner", "created_at": "2024-03-01T01:00:00Z"},
    ]
    for number, item in enumerate(users):
        page(base / "users" / f"{number}.json", {"count": 2, "items": [item]})
    page(base / "courses" / "1.json", {"count": 1, "items": [{"id": 7, "name": "Kursus", "type": "online", "prices": []}]})
    survey = {"type": "survey", "survey_type": "survey", "survey_id": "s1", "completed_at": "2024-04-02T09:00:00Z"}
    enrollments = [
        {
            "id": "e1", "user_id": "sub-1", "course_id": 7, "learning_time": 100, "learning_progress": 50,
            "created_at": "2024-04-01T00:00:00Z", "completed_at": "2024-04-03T20:00:00Z",
            "user_data": {"name": "Budi", "email": "budi@mail.com"},
            "metadata": {"started_at": "2024-04-01T08:00:00+07:00", "is_prakerja_user": True},
            "completions": {"materials": {"101": {"type": "video", "tracked_time": 90, "started_at": "2024-04-01T08:10:00Z"}, "102": survey}},
            "certificates": [{"id": "c"}],
        },
        {"id": "e2", "user_id": "sub-2", "course_id": 9, "user_data": {"email": "tuti@mail.com"}, "completions": {"materials": {}}, "certificates": []},
    ]
    page(base / "enrollments" / "1.json", {"count": 2, "items": enrollments})
    raw = {}
    for endpoint in ("users", "courses", "enrollments"):
        table = f"eduqat_{endpoint}"
        items = src.read_api_pages(spark, str(base / endpoint), item_fields(table))
        raw[table] = load_api_items(items, table, BATCH)

    talk = {"id": 5, "conversation_id": "t1", "enrollment_id": "e1", "course_id": 7, "user": {"name": "Budi"}}
    silent = {"id": 6, "conversation_id": "t2"}
    page(base / "talks" / "1.json", {"code": 200, "data": [talk, silent], "meta": {"total_pages": 1, "total_count": 2}})
    said = [{"session_id": "t1", "sender": s, "value": v, "timestamp": "2024-04-01T09:00:00Z"} for s, v in (("ai", "Halo"), ("human", "Hai"))]
    page(base / "messages" / "t1.json", {"code": 200, "data": said})
    talks = src.read_api_pages(spark, str(base / "talks"), item_fields("eduqat_ai_conversations"), "data")
    message = "session_id string, sender string, value string, timestamp string"
    pages = src.read_pages(spark, str(base / "messages"), message, "data")
    messages = src.explode_pages(pages, "data", position="position")
    messages = messages.withColumn("conversation_id", F.col("session_id"))
    raw["eduqat_ai_conversations"], raw["eduqat_ai_messages"] = load_ai_conversations(talks, messages, BATCH)

    result = {"id": "r1", "type": "survey", "title": "Kepuasan", "elements": [{"question": "Puas?", "type": "scale", "responses": [5]}]}
    results = spark.createDataFrame([("e1", "102", json.dumps(result))], "enrollment_id string, material_id string, t string")
    results = results.select("enrollment_id", "material_id", F.parse_json("t").alias("survey_data"))
    work = src.survey_worklist(raw["eduqat_enrollments"])
    raw["eduqat_survey_results"] = src.survey_load(work, results, "eduqat_survey_results", BATCH)
    return raw


def load_product(spark):
    ntz = lambda *a: dt.datetime(*a)
    extracts = {
        "purchase_form_data": spark.createDataFrame(
            [("Budi Beli", "budi@mail.com", None, ntz(2024, 3, 31), "7"), ("Tanpa Kontak", None, None, None, "7")],
            "customer_name string, customer_email string, customer_phone string, paid_at timestamp_ntz, course_id string",
        ),
        "users": spark.createDataFrame(
            [("u1", "budi@mail.com", "628120000001", ntz(2024, 4, 1)), ("u2", "staff@mail.com", "62899", ntz(2024, 4, 1))],
            "id string, email string, mobile string, created_at timestamp_ntz",
        ),
        "ai_chat_sessions": spark.createDataFrame(
            [("s1", "u1", None), ("s2", None, "g1"), ("s3", "u2", None)], "id string, user_id string, guest_session_id string"
        ),
        "ai_chat_messages": spark.createDataFrame(
            [("m1", "s1", ntz(2024, 4, 2)), ("m2", "s1", ntz(2024, 4, 16)), ("m3", "s2", ntz(2024, 4, 2)), ("m4", "s3", ntz(2024, 4, 1))],
            "id string, session_id string, created_at timestamp_ntz",
        ),
    }
    return {name: load_source_table(df, name, BATCH) for name, df in extracts.items()}


def test_landed_files_to_metrics(spark, tmp_path):
    raw = load_leads(spark, tmp_path) | load_platform(spark, tmp_path) | load_product(spark)
    assert len(raw) == 14
    landed = {name: src.materialize(df, f"raw_{name}", "table", str(tmp_path / "raw")) for name, df in raw.items()}
    checked = {n: df for n, df in landed.items() if n in RAW}
    assert raw_violations(checked).where("violations > 0").isEmpty()

    m = build_models(landed, str(tmp_path / "models"), internal_mobiles=["62899"])

    leads = {r.data_source: r for r in m["int_all_marketing_leads"].collect()}
    ads = leads["leads_ads_community"]
    assert (ads.email, ads.phone_number, ads.nama_pemilik_usaha) == ("budi@mail.com", "+628120000001", "Budi")
    assert (ads.lama_usaha, ads.pendapatan_bulanan, ads.jumlah_karyawan) == ("5-10 tahun", "10-50 juta", "1-5 karyawan")
    assert ads.bidang_usaha == "kopi" and ads.timestamp == "2024-02-01" and ads.sheet_name == "Form 1"
    web = leads["website_form_responses"]
    assert (web.bidang_usaha, web.kota_kabupaten, web.jumlah_karyawan) == ("teh", "Kota", None)
    assert leads["branding_level_up"].composite_key == "|"

    contacts = {r.contact_key: r for r in m["mart_contact"].collect()}
    assert sorted(contacts) == ["budi@mail.com|+628120000001", "tuti@mail.com|", "|+628130000002"]
    budi = contacts["budi@mail.com|+628120000001"]
    assert (budi.full_name, budi.total_purchases, budi.eduqat_user_id) == ("Budi Beli", 1, 11)
    assert (budi.enrolled_courses_count, budi.total_certificates, budi.prakerja_enrollments_count) == (1, 1, 1)
    assert (budi.eduqat_created_at_marketing_week, budi.eduqat_created_at_marketing_year) == (1, 2025)
    assert contacts["tuti@mail.com|"].total_certificates is None

    courses = {r.enrollment_id: r for r in m["mart_enrollment"].collect()}
    assert (courses["e1"].course_name, courses["e1"].days_to_complete) == ("Kursus", 2)
    assert courses["e1"].enrollment_started_at == dt.datetime(2024, 4, 1, 8)
    assert courses["e1"].purchased_at == dt.datetime(2024, 3, 31)
    assert (courses["e2"].course_name, courses["e2"].purchased_at) == (None, None)

    assert rows(m["mart_materials"].select("material_id", "material_type", "email")) == [
        (101, "video", "budi@mail.com"),
        (102, "survey", "budi@mail.com"),
    ]
    talk = m["stg_eduqat_ai_conversations"].select("conversation_id", "message_order", "message_sender", "message_content")
    assert rows(talk) == [("t1", 1, "ai", "Halo"), ("t1", 2, "human", "Hai")]
    survey = src.json_text_column(m["stg_eduqat_survey_results"], "responses")
    assert rows(survey.select("survey_id", "question_index", "question_text", "responses")) == [("s1", 0, "Puas?", "[5]")]

    kept = {r.user_id: r for r in m["int_user_retention"].collect()}
    assert (kept["u1"].retained_7d, kept["u1"].retained_14d, kept["u1"].retained_30d) == (1, 1, 0)
    assert kept["u1"].active_days == 2 and kept["u2"].is_internal_user

    by_sql = spark.sql(
        "select c.eduqat_role, count(distinct e.enrollment_id) as n from mart_contact c "
        "join stg_eduqat_enrollments e on e.user_email = c.email group by c.eduqat_role"
    )
    assert rows(by_sql) == [("learner", 2)]

    by_role = plans.metric_query(m["mart_contact"], ["number_of_contacts", "number_of_wa"], ["eduqat_role"])
    assert rows(by_role) == [(None, 1, 1), ("learner", 2, 1)]
    minutes = plans.metric_query(m["mart_enrollment"], ["total_learning_time_min"]).collect()[0][0]
    assert str(minutes) == "1.67"
