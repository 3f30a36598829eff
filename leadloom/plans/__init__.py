"""The 20 models as functions of DataFrames, and the metric layer."""

from leadloom.plans.intermediate import int_ai_chat_messages, int_all_marketing_leads, int_user_retention
from leadloom.plans.marts import (
    mart_contact,
    mart_enrollment,
    mart_materials,
    mart_materials_from_raw,
)
from leadloom.plans.metrics import DIMENSIONS, METRICS, metric_query
from leadloom.plans.staging import (
    stg_ai_chat_messages,
    stg_ai_chat_sessions,
    stg_branding_level_up,
    stg_eduqat_ai_conversations,
    stg_eduqat_courses,
    stg_eduqat_enrollments,
    stg_eduqat_survey_results,
    stg_eduqat_users,
    stg_enrollment_materials,
    stg_leads_ads_community,
    stg_leads_course_strategi_ads,
    stg_purchase_form_data,
    stg_users,
    stg_website_form_responses,
)
from leadloom.plans.summary import metric_summary, metrics_from_summary

__all__ = [
    "DIMENSIONS",
    "METRICS",
    "int_ai_chat_messages",
    "int_all_marketing_leads",
    "int_user_retention",
    "mart_contact",
    "mart_enrollment",
    "mart_materials",
    "mart_materials_from_raw",
    "metric_query",
    "metric_summary",
    "metrics_from_summary",
    "stg_ai_chat_messages",
    "stg_ai_chat_sessions",
    "stg_branding_level_up",
    "stg_eduqat_ai_conversations",
    "stg_eduqat_courses",
    "stg_eduqat_enrollments",
    "stg_eduqat_survey_results",
    "stg_eduqat_users",
    "stg_enrollment_materials",
    "stg_leads_ads_community",
    "stg_leads_course_strategi_ads",
    "stg_purchase_form_data",
    "stg_users",
    "stg_website_form_responses",
]
