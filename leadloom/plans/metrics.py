"""Named metrics, each one aggregate over one table, by any dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.temporal import minutes_2dp


@dataclass(frozen=True)
class Metric:
    table: str
    column: str
    build: Callable[[Column], Column]
    description: str

    def expression(self) -> Column:
        return self.build(F.col(self.column))

    @property
    def kind(self) -> str:
        """What a summary keeps of it: ``distinct``, ``mean``, ``minutes`` or ``sum``."""
        return {_distinct: "distinct", F.avg: "mean", _minutes: "minutes"}.get(self.build, "sum")


def _distinct(c: Column) -> Column:
    return F.count_distinct(c)


def _minutes(c: Column) -> Column:
    """Each row is rounded before the sum."""
    return F.sum(minutes_2dp(c))


METRICS: dict[str, Metric] = {
    "number_of_contacts": Metric("mart_contact", "contact_key", _distinct, "contacts"),
    "number_of_emails": Metric("mart_contact", "email", _distinct, "e-mail addresses"),
    "number_of_wa": Metric("mart_contact", "phone_number", _distinct, "phone numbers"),
    "number_of_product_users": Metric("mart_contact", "eduqat_user_id", _distinct, "platform users"),
    "number_of_enrollments": Metric("mart_enrollment", "enrollment_id", _distinct, "enrollments"),
    "number_of_enrollments_started": Metric(
        "mart_enrollment", "enrollment_started_at", _distinct, "distinct start times"
    ),
    "number_of_enrollments_completed": Metric(
        "mart_enrollment", "enrollment_completed_at", _distinct, "distinct completion times"
    ),
    "avg_days_to_complete": Metric("mart_enrollment", "days_to_complete", F.avg, "days to complete"),
    "total_learning_time_min": Metric(
        "mart_enrollment", "learning_time_seconds", _minutes, "minutes learned"
    ),
    "number_of_materials": Metric("mart_materials", "material_id", _distinct, "materials"),
    "number_of_materials_started": Metric(
        "mart_materials", "material_started_at", _distinct, "distinct start times"
    ),
    "number_of_materials_completed": Metric(
        "mart_materials", "material_completed_at", _distinct, "distinct completion times"
    ),
    "total_material_time_min": Metric(
        "mart_materials", "material_tracked_time_seconds", _minutes, "minutes on materials"
    ),
    **{
        f"retained_{n}d_count": Metric(
            "int_user_retention", f"retained_{n}d", F.sum, f"users active after {n} days"
        )
        for n in (7, 14, 30, 60, 90)
    },
}


# Declared types of the dimensions that are not plain text.
DIMENSIONS: dict[str, dict[str, str]] = {
    "stg_purchase_form_data": {
        "created_at": "timestamp",
        "paid_at": "timestamp",
        "extracted_at": "timestamp",
    },
    "stg_users": {
        "created_at": "timestamp",
        "updated_at": "timestamp",
        "mobile_verified_at": "timestamp",
        "extracted_at": "timestamp",
    },
    "stg_ai_chat_sessions": {
        "created_at": "timestamp",
        "updated_at": "timestamp",
        "extracted_at": "timestamp",
    },
    "stg_ai_chat_messages": {
        "message_order": "number",
        "created_at": "timestamp",
        "extracted_at": "timestamp",
    },
    "stg_eduqat_courses": {
        "duration_seconds": "number",
        "total_student": "number",
        "rating": "number",
        "start_date": "timestamp",
        "end_date": "timestamp",
        "published_at": "timestamp",
        "extracted_at": "timestamp",
    },
    "int_ai_chat_messages": {"user_created_at": "timestamp"},
    "int_user_retention": {
        "user_created_at": "timestamp",
        "is_internal_user": "boolean",
        "first_message_at": "timestamp",
        "last_message_at": "timestamp",
    },
    "mart_contact": {
        "eduqat_created_at_marketing_week": "number",
        "eduqat_created_at_marketing_year": "number",
    },
    "mart_enrollment": {
        "started_at_marketing_week": "number",
        "started_at_marketing_year": "number",
        "completed_at_marketing_week": "number",
        "completed_at_marketing_year": "number",
    },
}


def metric_query(
    df: DataFrame, metrics: Sequence[str], dims: Sequence[str | Column] = (), where: Column | None = None
) -> DataFrame:
    """Evaluate metrics of one table, grouped by dimensions, after a filter."""
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise KeyError(f"unknown metrics: {unknown}")
    tables = {METRICS[m].table for m in metrics}
    if len(tables) != 1:
        raise ValueError(f"metrics of different tables cannot be combined: {sorted(tables)}")
    rows = df if where is None else df.where(where)
    return rows.groupBy(*dims).agg(*[METRICS[m].expression().alias(m) for m in metrics])
