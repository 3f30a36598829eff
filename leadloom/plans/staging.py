"""Staging models: one per raw table, plus the unnested enrollment materials."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.jsonv import json_as, json_child, json_len, json_text
from leadloom.functions.normalize import (
    blank_to_null,
    composite_key,
    flag_in_list,
    normalize_business_age,
    normalize_email,
    normalize_employee_count,
    normalize_income,
    normalize_phone,
)
from leadloom.operators.attach import attach_rows
from leadloom.operators.dedup import dedup_latest
from leadloom.operators.projection import any_not_null, project
from leadloom.operators.unnest import unnest_array, unnest_object
from leadloom.schemas import LEAD_LAYOUT, RAW, STAMP

# Fixed value: a header cut to 63 bytes by the landing database.
BIDANG_USAHA_HEADER = "bidang_usaha_yang_sedang_dijalankan_saat_ini_cth_pakaian_makana"


# --- lead sheets -----------------------------------------------------------


def _lead_rows(
    raw: DataFrame, bidang_usaha: str, fields: Mapping[str, Column], absent: Collection[str]
) -> DataFrame:
    """Raw lead rows in the common layout, plus the raw row's ``id``.

    ``fields`` overrides single columns, ``absent`` lists columns that the source
    does not have.
    """
    columns: dict[str, str | Column] = {c: c for c in LEAD_LAYOUT if c != "composite_key"}
    columns |= {
        "email": normalize_email(F.col("email")),
        "phone_number": normalize_phone(F.col("phone_number")),
        "bidang_usaha": bidang_usaha,
        "lama_usaha": normalize_business_age(F.col("lama_usaha")),
        "pendapatan_bulanan": normalize_income(F.col("pendapatan_bulanan")),
        **fields,
        "id": "id",
    }
    for c in absent:
        del columns[c]
    rows = project(
        raw.where(any_not_null("email", "phone_number")),
        columns,
        pad=dict.fromkeys(absent, "string"),
        order=[c for c in LEAD_LAYOUT if c != "composite_key"] + ["id"],
    )
    return rows.withColumn("composite_key", composite_key(F.col("email"), F.col("phone_number")))


def _latest_lead(rows: DataFrame) -> DataFrame:
    """Newest form submission per key, then newest extract, then lowest id.

    The sheet timestamps are text and compare as text. The key columns rather
    than their concatenation partition the window: the groups are the same.
    """
    latest = dedup_latest(
        rows,
        keys=[F.coalesce("email", F.lit("")), F.coalesce("phone_number", F.lit(""))],
        order_by=[F.col("timestamp").desc_nulls_last(), F.col("extracted_at").desc_nulls_first()],
        tiebreak=[F.col("id").asc_nulls_last()],
    )
    return latest.select(*LEAD_LAYOUT)


def _employees(column: str) -> Column:
    return normalize_employee_count(blank_to_null(F.col(column)))


def stg_leads_ads_community(raw: DataFrame) -> DataFrame:
    fields = {"jumlah_karyawan": _employees("saat_ini_sudah_memiliki_berapa_karyawan")}
    return _latest_lead(_lead_rows(raw, BIDANG_USAHA_HEADER, fields, absent=["kota_kabupaten"]))


def stg_website_form_responses(raw: DataFrame) -> DataFrame:
    fields = {
        "kota_kabupaten": blank_to_null(F.col("di_kota_mana_anda_menjalankan_usaha_anda")),
        "jumlah_karyawan": _employees("berapa_jumlah_karyawan_yang_anda_miliki"),
    }
    absent = [
        "nama_akun_ecommerce",
        "tergabung_komunitas_umkm",
        "memiliki_nib",
        "memiliki_sertifikasi_halal",
    ]
    return _latest_lead(_lead_rows(raw, "bidang_usaha", fields, absent))


def stg_leads_course_strategi_ads(raw: DataFrame) -> DataFrame:
    city = "sebutkan_nama_kota_kabupaten_tempat_usaha_kamu_beroperasi"
    fields = {"kota_kabupaten": blank_to_null(F.col(city))}
    absent = ["jumlah_karyawan", "tergabung_komunitas_umkm", "memiliki_sertifikasi_halal"]
    return _latest_lead(_lead_rows(raw, BIDANG_USAHA_HEADER, fields, absent))


def stg_branding_level_up(raw: DataFrame) -> DataFrame:
    """This source keeps all rows; the contact mart removes duplicates later."""
    rows = _lead_rows(raw, BIDANG_USAHA_HEADER, {}, absent=["kota_kabupaten", "jumlah_karyawan"])
    return rows.select(*LEAD_LAYOUT)


# --- purchases, users, chat ------------------------------------------------


def stg_purchase_form_data(raw: DataFrame, strict: bool = True) -> DataFrame:
    course = F.col("course_id")
    rows = raw.where(any_not_null("email", "phone_number")).select(*RAW["purchase_form_data"])
    return rows.withColumn("course_id", course.cast("int") if strict else course.try_cast("int"))


def stg_users(raw: DataFrame, internal_mobiles: Collection[str] = ()) -> DataFrame:
    """Users with a three-valued internal flag; the list is the caller's."""
    internal = flag_in_list(F.col("mobile"), internal_mobiles).alias("is_internal_user")
    own = [c for c in RAW["users"] if c not in STAMP]
    return raw.select(*own, internal, *STAMP)


def stg_ai_chat_sessions(raw: DataFrame) -> DataFrame:
    return raw.select(*RAW["ai_chat_sessions"])


def stg_ai_chat_messages(raw: DataFrame) -> DataFrame:
    return raw.select(*RAW["ai_chat_messages"])


# --- learning platform -----------------------------------------------------


# Columns of the staged accounts and courses, in order.
USER_COLUMNS = (
    "id",
    "user_id",
    "subid",
    "name",
    "user_name",
    "email",
    "phone_number",
    "phone_country",
    "phone_country_calling_code",
    "description",
    "avatar_url",
    "role",
    "status",
    "total_course",
    "total_enrollment",
    "pre_signup_at",
    "confirmed_at",
    "last_loggin_at",
    "created_at",
    "stripe_customer_ids",
    "metadata",
    "data_source",
    "extracted_at",
)
COURSE_COLUMNS = (
    "id",
    "slug",
    "name",
    "description",
    "type",
    "status",
    "duration",
    "total_student",
    "rating",
    "author",
    "parent",
    "timezone",
    "progress_status",
    "start_date",
    "end_date",
    "published_at",
    "language_codes",
    "categories",
    "educators",
    "images",
    "prices",
    "tags",
    "metadata",
    "data_source",
    "extracted_at",
)
COURSE_NAMES = {
    "id": "course_id",
    "name": "course_name",
    "type": "course_type",
    "status": "course_status",
    "duration": "duration_seconds",
    "parent": "parent_course_id",
}


def stg_eduqat_users(raw: DataFrame) -> DataFrame:
    return raw.select(*USER_COLUMNS)


def stg_eduqat_courses(raw: DataFrame) -> DataFrame:
    return raw.select(*(F.col(c).alias(COURSE_NAMES.get(c, c)) for c in COURSE_COLUMNS))


# Output column -> path and type in the user document, and in the
# enrollment's metadata.
USER_FIELDS = {
    "user_name": ("$.name", "string"),
    "user_email": ("$.email", "string"),
    "user_phone": ("$.phone_number", "string"),
    "user_role": ("$.role", "string"),
    "user_status": ("$.status", "string"),
    "user_created_at": ("$.created_at", "timestamp_ntz"),
}
METADATA_FIELDS = {
    "enrollment_started_at": ("$.started_at", "timestamp_ntz"),
    "total_tracked_time": ("$.tracked_time.total", "double"),
    "last_tracked_at": ("$.tracked_time.last_tracked_at", "timestamp_ntz"),
    "enrollment_type": ("$.type", "string"),
    "prakerja_id": ("$.prakerja_id", "string"),
    "is_prakerja_user": ("$.is_prakerja_user", "boolean"),
    "prakerja_redeem_code": ("$.prakerja_redeem_code", "string"),
    "prakerja_redeem_at": ("$.prakerja_redeem_at", "timestamp_ntz"),
}


# Columns of the staged enrollments, in order.
ENROLLMENT_COLUMNS = (
    "enrollment_id",
    "uid",
    "user_id",
    "course_id",
    "price_id",
    "schedule_id",
    "order_uid",
    *USER_FIELDS,
    "enrollment_started_at",
    "enrollment_completed_at",
    "enrollment_expires_at",
    "enrollment_created_at",
    "learning_progress",
    "learning_time",
    "total_tracked_time",
    "last_tracked_at",
    "enrollment_type",
    "timezone",
    "order_data",
    "prakerja_id",
    "is_prakerja_user",
    "prakerja_redeem_code",
    "prakerja_redeem_at",
    "certificate_count",
    "user_data",
    "metadata",
    "certificates",
    "user_groups",
    "user_group_admins",
    "data_source",
    "extracted_at",
)
ENROLLMENT_NAMES = {
    "enrollment_id": "id",
    "enrollment_completed_at": "completed_at",
    "enrollment_expires_at": "expires_at",
    "enrollment_created_at": "created_at",
}


def stg_eduqat_enrollments(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Enrollments with the fields of their documents; completions stay behind."""
    fields = {
        name: json_as(F.col(doc), path, dtype, strict)
        for doc, spec in (("user_data", USER_FIELDS), ("metadata", METADATA_FIELDS))
        for name, (path, dtype) in spec.items()
    }
    fields["certificate_count"] = json_len(F.col("certificates"))
    return raw.select(
        *(fields.get(c, F.col(ENROLLMENT_NAMES.get(c, c))).alias(c) for c in ENROLLMENT_COLUMNS)
    )


# Output column -> path and type in one material's record.
MATERIAL_FIELDS = {
    "material_type": ("$.type", "string"),
    "is_required": ("$.is_required", "boolean"),
    "started_at": ("$.started_at", "timestamp_ntz"),
    "completed_at": ("$.completed_at", "timestamp_ntz"),
    "tracked_time_seconds": ("$.tracked_time", "double"),
    "ai_tutor_status": ("$.status", "string"),
    "conversation_id": ("$.conversation_id", "string"),
    "conversation_started_at": ("$.start_conversation", "timestamp_ntz"),
    "conversation_ended_at": ("$.end_conversation", "timestamp_ntz"),
    "submission_count": ("$.count_submit", "int"),
    "self_assessment_id": ("$.self_assessment_id", "int"),
    "self_assessment_library_id": ("$.self_assessment_library_id", "string"),
    "require_feedback": ("$.require_feedback", "boolean"),
    "require_file_upload": ("$.require_file_upload", "boolean"),
    "require_educator_approval": ("$.require_educator_approval", "int"),
}


def stg_enrollment_materials(
    raw: DataFrame, strict: bool = True, carry: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per member of ``completions.materials``.

    ``carry`` adds columns of the enrollment, computed once per enrollment.
    """
    carried = [c.alias(name) for name, c in (carry or {}).items()]
    base = raw.select(
        F.col("id").alias("enrollment_id"), "user_id", "course_id", *carried, "completions"
    )
    fields = {
        name: json_as(F.col("value"), path, dtype, strict)
        for name, (path, dtype) in MATERIAL_FIELDS.items()
    }
    completions = F.col("completions")
    rows = unnest_object(
        base, completions, fields, key="material_id", key_type="int", path="$.materials"
    )
    return rows.drop("completions")


def stg_eduqat_ai_conversations(conversations: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per message of a conversation, numbered from 1."""
    said = messages.select(
        "conversation_id",
        "position",
        F.col("session_id").alias("message_session_id"),
        F.col("sender").alias("message_sender"),
        F.col("value").alias("message_content"),
        F.col("timestamp").alias("message_timestamp"),
    )
    fields = [c for c in said.columns if c not in ("conversation_id", "position")]
    rows = attach_rows(
        conversations, said, "conversation_id", "position", fields, "message_order", keep_childless=False
    )
    return rows.select(
        F.col("id").alias("submission_id"),
        "conversation_id",
        "user_id",
        "enrollment_id",
        "course_id",
        "material_id",
        F.col("status").alias("conversation_status"),
        "score",
        "content",
        "audio_url",
        "x_site_id",
        "educator_id",
        F.col("created_at").alias("conversation_created_at"),
        F.col("updated_at").alias("conversation_updated_at"),
        "message_session_id",
        "message_sender",
        "message_content",
        "message_timestamp",
        "message_order",
        "data_source",
        "extracted_at",
    )


def stg_eduqat_survey_results(raw: DataFrame) -> DataFrame:
    """One row per survey question, numbered from 0."""
    value = F.col("value")
    rows = unnest_array(
        raw,
        F.col("elements"),
        {
            "question_text": json_text(value, "$.question"),
            "question_description": json_text(value, "$.description"),
            "question_type": json_text(value, "$.type"),
            "responses": json_child(value, "$.responses"),
        },
        position="question_index",
        base=0,
    )
    return rows.select(
        "enrollment_id",
        "material_id",
        "question_index",
        "survey_id",
        "course_id",
        "user_id",
        "survey_type",
        "survey_title",
        "question_text",
        "question_description",
        "question_type",
        "responses",
        "completed_at",
        "data_source",
        "extracted_at",
    )
