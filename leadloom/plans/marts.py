"""Mart models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.functions.jsonv import json_text
from leadloom.functions.normalize import composite_key, normalize_email
from leadloom.functions.temporal import days_between, first_non_null, iso_week, iso_year, last_activity
from leadloom.operators.aggregates import aggregate, count_where, value_of_latest
from leadloom.operators.dedup import dedup_latest
from leadloom.operators.joins import Repeated, full_outer_on, left_join, left_join_fanout
from leadloom.operators.projection import any_not_null, not_null
from leadloom.plans.staging import stg_enrollment_materials


def latest_leads(leads: DataFrame) -> DataFrame:
    """Newest extract per e-mail and phone over all lead sources.

    Rows that tie are ordered by source, newest submission, then by the
    remaining columns, so the result does not depend on how the input is split.
    """
    first = ("email", "phone_number", "extracted_at", "data_source", "timestamp")
    rest = [F.col(c).asc_nulls_last() for c in leads.columns if c not in first]
    return dedup_latest(
        leads.where(any_not_null("email", "phone_number")),
        keys=[F.coalesce("email", F.lit("")), F.coalesce("phone_number", F.lit(""))],
        order_by=[F.col("extracted_at").desc_nulls_first()],
        tiebreak=[
            F.col("data_source").asc_nulls_last(),
            F.col("timestamp").desc_nulls_last(),
            *rest,
        ],
    )


def agg_purchases(purchases: DataFrame) -> DataFrame:
    """Purchases per e-mail. An unpaid purchase counts as the latest one."""
    return aggregate(
        purchases.where(not_null("email")),
        ["email"],
        {
            "first_purchased_at": F.min("paid_at"),
            "last_purchased_at": F.max("paid_at"),
            "total_purchases": F.count("*"),
            "customer_name": value_of_latest(
                F.col("customer_name"),
                F.col("paid_at"),
                nulls="first",
                tiebreak=[F.col("created_at"), F.col("customer_name")],
            ),
        },
    )


def agg_enrollments(enrollments: DataFrame) -> DataFrame:
    """Enrollments per e-mail; a NULL Prakerja flag does not count."""
    return aggregate(
        enrollments.where(not_null("user_email")),
        [F.col("user_email").alias("email")],
        {
            "enrolled_courses_count": F.count("*"),
            "total_learning_time_seconds": F.sum("learning_time"),
            "avg_learning_progress": F.avg("learning_progress"),
            "total_certificates": F.sum("certificate_count").cast("long"),
            "prakerja_enrollments_count": count_where(F.col("is_prakerja_user")),
            "last_enrollment_at": F.max("enrollment_created_at"),
        },
    )


def mart_contact(
    leads: DataFrame,
    purchases: DataFrame,
    accounts: DataFrame,
    enrollments: DataFrame,
    normalize_keys: bool = False,
) -> DataFrame:
    """One row per e-mail and phone over leads, purchases and platform accounts.

    Only lead e-mails are normalised at the source, so the match is
    case-sensitive; ``normalize_keys`` normalises the other sides too.
    """
    if normalize_keys:
        purchases = purchases.withColumn("email", normalize_email(F.col("email")))
        accounts = accounts.withColumn("email", normalize_email(F.col("email")))
        enrollments = enrollments.withColumn("user_email", normalize_email(F.col("user_email")))
    platform = accounts.where(not_null("email")).select(
        "email",
        F.col("user_id").alias("eduqat_user_id"),
        F.col("name").alias("eduqat_name"),
        F.col("role").alias("eduqat_role"),
        F.col("status").alias("eduqat_status"),
        F.col("total_enrollment").alias("eduqat_total_enrollments"),
        F.col("last_loggin_at").alias("eduqat_last_login_at"),
        F.col("created_at").alias("eduqat_created_at"),
    )
    # staged lead e-mails are an address or NULL; leads without one join to
    # nothing and go their own way, so that the others are read once
    mailed = leads.where(not_null("email"))
    everyone = full_outer_on(
        "email",
        repeated=[
            Repeated(platform),
            Repeated(
                rows=latest_leads(mailed),
                # a deduplication per (email, phone) keeps every e-mail
                keys=mailed,
                unkeyed=latest_leads(leads.where(~not_null("email"))),
            ),
        ],
        per_key=[agg_purchases(purchases), agg_enrollments(enrollments)],
    )
    return everyone.where(any_not_null("email", "phone_number")).select(
        composite_key(F.col("email"), F.col("phone_number")).alias("contact_key"),
        "email",
        "phone_number",
        first_non_null(F.col("customer_name"), F.col("eduqat_name"), F.col("nama_pemilik_usaha")).alias(
            "full_name"
        ),
        "first_purchased_at",
        "last_purchased_at",
        "total_purchases",
        "eduqat_user_id",
        "eduqat_role",
        "eduqat_status",
        "eduqat_total_enrollments",
        "eduqat_last_login_at",
        "eduqat_created_at",
        iso_week(F.col("eduqat_created_at")).alias("eduqat_created_at_marketing_week"),
        iso_year(F.col("eduqat_created_at")).alias("eduqat_created_at_marketing_year"),
        "enrolled_courses_count",
        "total_learning_time_seconds",
        "avg_learning_progress",
        "total_certificates",
        "prakerja_enrollments_count",
        "last_enrollment_at",
        "provinsi_usaha",
        "kota_kabupaten",
        "bidang_usaha",
        "pendapatan_bulanan",
        "lama_usaha",
        "jumlah_karyawan",
        "nama_usaha",
        "nama_akun_media_sosial",
        "nama_akun_ecommerce",
        "tergabung_komunitas_umkm",
        "memiliki_nib",
        "memiliki_sertifikasi_halal",
        F.col("data_source").alias("marketing_data_source"),
        F.col("sheet_name").alias("marketing_sheet_name"),
        F.col("timestamp").alias("marketing_timestamp"),
        last_activity(
            F.col("extracted_at"),
            F.col("last_purchased_at"),
            F.col("eduqat_created_at"),
            F.col("last_enrollment_at"),
        ).alias("last_activity_at"),
    )


def mart_enrollment(enrollments: DataFrame, courses: DataFrame, purchases: DataFrame) -> DataFrame:
    """Enrollments with their course and purchases of it by the same e-mail.

    An enrollment appears once per matching purchase.
    """
    lookup = courses.select("course_id", "course_name", "course_type", "course_status")
    paid = purchases.select("course_id", "email", F.col("paid_at").alias("purchased_at"))
    e = enrollments.withColumnsRenamed(
        {
            "user_email": "email",
            "user_phone": "phone_number",
            "enrollment_created_at": "enrolled_at",
            "learning_time": "learning_time_seconds",
            "total_tracked_time": "total_tracked_time_seconds",
        }
    )
    started, completed = F.col("enrollment_started_at"), F.col("enrollment_completed_at")
    # the lookup is joined last: the fan-out join then moves no course columns
    joined = left_join(left_join_fanout(e, paid, ["course_id", "email"]), lookup, "course_id")
    return joined.select(
        "enrollment_id",
        "uid",
        "course_id",
        "price_id",
        "schedule_id",
        "order_uid",
        "user_id",
        "email",
        "phone_number",
        "user_name",
        "course_name",
        "course_type",
        "course_status",
        "enrollment_started_at",
        "enrollment_completed_at",
        "enrollment_expires_at",
        "enrolled_at",
        iso_week(started).alias("started_at_marketing_week"),
        iso_year(started).alias("started_at_marketing_year"),
        iso_week(completed).alias("completed_at_marketing_week"),
        iso_year(completed).alias("completed_at_marketing_year"),
        days_between(completed, started).alias("days_to_complete"),
        "learning_progress",
        "learning_time_seconds",
        "total_tracked_time_seconds",
        "last_tracked_at",
        "enrollment_type",
        "timezone",
        "prakerja_id",
        "is_prakerja_user",
        "prakerja_redeem_code",
        "prakerja_redeem_at",
        "certificate_count",
        "certificates",
        "order_data",
        "purchased_at",
        "data_source",
        "extracted_at",
    )


def mart_materials(materials: DataFrame, enrollments: DataFrame, courses: DataFrame) -> DataFrame:
    """Enrollment materials with the user of the enrollment and the course."""
    who = enrollments.select(
        "enrollment_id",
        F.col("user_email").alias("email"),
        F.col("user_phone").alias("phone_number"),
        "user_name",
        "data_source",
        "extracted_at",
    )
    return _with_course(left_join(materials, who, "enrollment_id"), courses)


def mart_materials_from_raw(raw: DataFrame, courses: DataFrame, strict: bool = True) -> DataFrame:
    """The same mart without a join to the enrollments.

    Materials and enrollments are unnested from the same raw rows, whose id is
    unique, so the user's fields can ride along and nothing is shuffled by
    enrollment.
    """
    user = F.col("user_data")
    carry = {
        "email": json_text(user, "$.email"),
        "phone_number": json_text(user, "$.phone_number"),
        "user_name": json_text(user, "$.name"),
        "data_source": F.col("data_source"),
        "extracted_at": F.col("extracted_at"),
    }
    return _with_course(stg_enrollment_materials(raw, strict, carry), courses)


def _with_course(materials: DataFrame, courses: DataFrame) -> DataFrame:
    joined = left_join(materials, courses.select("course_id", "course_name"), "course_id")
    return joined.select(
        "enrollment_id",
        "user_id",
        "course_id",
        "material_id",
        "email",
        "phone_number",
        "user_name",
        "course_name",
        "material_type",
        F.col("is_required").alias("material_is_required"),
        F.col("started_at").alias("material_started_at"),
        F.col("completed_at").alias("material_completed_at"),
        F.col("tracked_time_seconds").alias("material_tracked_time_seconds"),
        "ai_tutor_status",
        "conversation_id",
        "conversation_started_at",
        "conversation_ended_at",
        "submission_count",
        "self_assessment_id",
        "self_assessment_library_id",
        "require_feedback",
        "require_file_upload",
        "require_educator_approval",
        "data_source",
        "extracted_at",
    )
