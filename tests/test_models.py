from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadloom import plans
from leadloom.bindings import derive
from leadloom.bindings.models import Models
from leadloom.operators import column_type_mismatches, row_audit, violations_unique
from leadloom.build import build_models
from leadloom.plans.marts import agg_purchases
from leadloom.schemas import LEAD_LAYOUT, LEAD_SHEETS, RAW
from tests.helpers import rows


@pytest.fixture(scope="module")
def models(spark, sf_small):
    return Models(spark, sf_small)


def lead(**values):
    row = dict.fromkeys(LEAD_LAYOUT)
    row |= {"data_source": "s", "extracted_at": "2024-06-01 00:00:00", **values}
    return tuple(row[c] for c in LEAD_LAYOUT)


def leads_table(spark, *data):
    return spark.createDataFrame(list(data), ", ".join(f"`{c}` string" for c in LEAD_LAYOUT))


PURCHASE = ", ".join(f"{c} {'int' if c == 'course_id' else 'timestamp_ntz' if t == 'timestamp_ntz' else 'string'}" for c, t in RAW["purchase_form_data"].items())


def purchases_table(spark, *data):
    names = list(RAW["purchase_form_data"])
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in data], PURCHASE)


ACCOUNT = "email string, user_id int, name string, role string, status string, total_enrollment int, last_loggin_at timestamp_ntz, created_at timestamp_ntz"
ENROLLMENT = "user_email string, learning_time int, learning_progress double, certificate_count int, is_prakerja_user boolean, enrollment_created_at timestamp_ntz"


def test_lead_layouts_agree(models):
    for name in LEAD_SHEETS:
        assert tuple(models.lead(name).columns) == LEAD_LAYOUT
        assert {t for _, t in models.lead(name).dtypes} == {"string"}


def test_staged_leads_are_unique_but_for_one_source(models):
    for name in LEAD_SHEETS[:3]:
        assert violations_unique(models.lead(name), ["composite_key"]).isEmpty()
    source = derive.raw_leads(models.spark, models.sf_dir, "branding_level_up")
    present = source.where("email is not null or phone_number is not null").count()
    assert models.lead("branding_level_up").count() == present


def test_doubly_invalid_leads_collapse(spark, models):
    staged = models.lead("leads_ads_community")
    assert staged.where("composite_key = '|'").count() == 1


def test_contact_joins_all_sides(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    leads = leads_table(
        spark,
        lead(email="a@x.y", phone_number="+62811111111", nama_pemilik_usaha="Lead A", extracted_at="2024-06-01 00:00:00"),
        lead(email="a@x.y", phone_number="+62811111111", nama_pemilik_usaha="Old A", extracted_at="2024-05-01 00:00:00"),
        lead(email="a@x.y", phone_number="+62822222222", nama_pemilik_usaha="Lead A2"),
        lead(phone_number="+62833333333", nama_pemilik_usaha="No mail"),
        lead(nama_pemilik_usaha="Nothing"),
    )
    purchases = purchases_table(
        spark,
        {"email": "a@x.y", "customer_name": "Paid", "paid_at": t(1)},
        {"email": "a@x.y", "customer_name": "Unpaid", "paid_at": None},
        {"email": "A@x.y", "customer_name": "Upper", "paid_at": t(2)},
    )
    accounts = spark.createDataFrame([("b@x.y", 7, "Account B", "learner", "ACTIVE", 1, None, dt.datetime(2024, 12, 30))], ACCOUNT)
    enrollments = spark.createDataFrame(
        [("b@x.y", 10, 50.0, None, True, t(5)), ("b@x.y", 20, 100.0, 2, None, t(6)), ("c@x.y", 1, 1.0, None, False, t(7))], ENROLLMENT
    )
    mart = plans.mart_contact(leads, purchases, accounts, enrollments)
    assert len(mart.columns) == 37
    got = {r.contact_key: r for r in mart.collect()}
    assert sorted(got) == ["A@x.y|", "a@x.y|+62811111111", "a@x.y|+62822222222", "b@x.y|", "c@x.y|", "|+62833333333"]
    a = got["a@x.y|+62811111111"]
    # the unpaid purchase counts as the latest one, and beats the lead's name
    assert (a.full_name, a.total_purchases, a.first_purchased_at) == ("Unpaid", 2, t(1))
    assert a.last_activity_at == dt.datetime(2024, 6, 1)
    b = got["b@x.y|"]
    assert (b.full_name, b.enrolled_courses_count, b.total_certificates, b.prakerja_enrollments_count) == ("Account B", 2, 2, 1)
    assert (b.eduqat_created_at_marketing_week, b.eduqat_created_at_marketing_year) == (1, 2025)
    assert b.avg_learning_progress == 75.0
    assert got["c@x.y|"].total_certificates is None
    assert got["|+62833333333"].full_name == "No mail"

    merged = plans.mart_contact(leads, purchases, accounts, enrollments, normalize_keys=True)
    by_key = {r.contact_key: r for r in merged.collect()}
    assert "A@x.y|" not in by_key and by_key["a@x.y|+62811111111"].total_purchases == 3


def test_contact_grain(models):
    assert row_audit(models.contact(), ["contact_key"]).collect()[0].grain_holds


def test_latest_lead_does_not_depend_on_partitions(spark, models):
    leads = models.leads()
    one = rows(plans.marts.latest_leads(leads.coalesce(1)))
    assert one == rows(plans.marts.latest_leads(leads.repartition(7, "nama_usaha")))


def test_purchase_course_ids(spark):
    raw = purchases_table(spark, {"email": "a@b.c"}).withColumn("course_id", F.lit("3.0"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        plans.stg_purchase_form_data(raw).collect()
    assert plans.stg_purchase_form_data(raw, strict=False).collect()[0].course_id is None


def test_latest_purchase_name_ties(spark):
    p = purchases_table(
        spark,
        {"email": "e", "customer_name": "x", "paid_at": None, "created_at": dt.datetime(2024, 1, 1)},
        {"email": "e", "customer_name": "y", "paid_at": None, "created_at": dt.datetime(2024, 1, 2)},
    )
    for parts in (1, 2, 5):
        assert agg_purchases(p.repartition(parts)).collect()[0].customer_name == "y"


def test_chat_keeps_guests(models):
    chat = models.chat()
    assert chat.count() == models.raw("ai_chat_messages").count()
    assert chat.where("user_id is null and guest_session_id is not null").count() > 0
    assert chat.where("user_id is not null and user_created_at is null").count() > 0


def test_retention_is_monotone(models):
    days = (1, 7, 14, 21, 30)
    got = plans.int_user_retention(models.chat(), days=days)
    for a, b in zip(days, days[1:]):
        assert got.where(F.col(f"retained_{b}d") > F.col(f"retained_{a}d")).isEmpty()
    unknown = got.where("user_created_at is null")
    assert unknown.count() > 0
    assert unknown.where("retained_7d is not null").isEmpty()


def test_enrollment_fans_out_over_purchases(models):
    audit = row_audit(models.enrollment(), ["enrollment_id"]).collect()[0]
    assert audit.key_count == models.enrollments().count()
    assert audit.row_count > audit.key_count


def test_a_hot_conversation_is_numbered_exactly(models):
    got = plans.stg_eduqat_ai_conversations(models.raw_conversations(), models.raw_messages())
    hot = got.where("conversation_id = 'all'")
    n = hot.count()
    assert n >= models.raw_messages().count() // 3
    assert sorted(r.message_order for r in hot.select("message_order").collect()) == list(range(1, n + 1))


def test_survey_questions_keep_json(models):
    got = plans.stg_eduqat_survey_results(models.raw("eduqat_survey_results"))
    assert dict(got.dtypes)["responses"] == "variant"
    assert {r.question_index for r in got.select("question_index").distinct().collect()} == {0, 1}


def test_metrics(spark):
    assert len(plans.METRICS) == 18
    df = spark.createDataFrame([("a", 100), ("a", 100), ("b", 1), (None, 1)], "enrollment_id string, learning_time_seconds int")
    got = plans.metric_query(df, ["number_of_enrollments", "total_learning_time_min"]).collect()[0]
    # 1.67 + 1.67 + 0.02 + 0.02: rounded per row
    assert (got[0], str(got[1])) == (2, "3.38")
    grouped = plans.metric_query(df, ["number_of_enrollments"], ["enrollment_id"], where=F.col("learning_time_seconds") > 1)
    assert rows(grouped) == [("a", 1)]
    with pytest.raises(KeyError):
        plans.metric_query(df, ["nope"])
    with pytest.raises(ValueError):
        plans.metric_query(df, ["number_of_enrollments", "number_of_materials"])


def test_metrics_from_a_summary(spark, tmp_path):
    """Any roll-up of two loads equals the metrics of their rows."""
    schema = "region string, kind string, enrollment_id string, enrollment_started_at timestamp_ntz, days_to_complete int, learning_time_seconds long"
    at = [dt.datetime(2024, 1, d, 1, 2, 3, 456) for d in range(1, 6)]
    rows = [
        ("x" if i % 3 else None, "kl"[i % 2], f"e{i % 7}" if i % 5 else None, at[i % 5] if i % 4 else None, i % 6 or None, i * 37)
        for i in range(60)
    ]
    metrics = ["number_of_enrollments", "number_of_enrollments_started", "avg_days_to_complete", "total_learning_time_min"]
    loads = [spark.createDataFrame(r, schema) for r in (rows[:35], rows[35:])]
    path = str(tmp_path / "summary")
    for df in loads:
        plans.metric_summary(df, metrics, ["region", "kind"], str(tmp_path / "codes")).write.mode("append").parquet(path)
    summary, whole = spark.read.parquet(path), loads[0].union(loads[1])
    for dims in ([], ["region"], ["kind"], ["region", "kind"]):
        for where in (None, F.col("kind") == "k"):
            got = plans.metrics_from_summary(summary, metrics, dims, where)
            want = plans.metric_query(whole, metrics, dims, where)
            assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_metric_columns_exist(models):
    tables = {
        "mart_contact": models.contact(),
        "mart_enrollment": models.enrollment(),
        "mart_materials": models.material(),
        "int_user_retention": models.retention(),
    }
    for metric in plans.METRICS.values():
        assert metric.column in tables[metric.table].columns


@pytest.mark.parametrize("tables", [False, True])
def test_build_models(spark, models, tmp_path, tables):
    raw = {name: models.raw(name) for name in derive.DERIVED if name != "leads"}
    raw |= {name: derive.raw_leads(spark, models.sf_dir, name) for name in LEAD_SHEETS}
    raw["eduqat_ai_conversations"], raw["eduqat_ai_messages"] = models.raw_conversations(), models.raw_messages()
    base = str(tmp_path) if tables else None
    built = build_models(raw, base, derive.INTERNAL_MOBILES)
    assert len(built) == 20
    for name, dimensions in plans.DIMENSIONS.items():
        assert column_type_mismatches(built[name], dimensions) == []
    assert rows(built["int_user_retention"]) == rows(models.retention())
    assert rows(built["mart_contact"].select("contact_key", "full_name")) == rows(
        models.contact().select("contact_key", "full_name")
    )
    if tables:
        assert built["mart_materials"].count() == models.material().count()
        assert dict(built["mart_enrollment"].dtypes)["certificates"] == "variant"
