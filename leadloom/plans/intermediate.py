"""Intermediate models."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.operators.aggregates import aggregate, distinct_days, reached_after
from leadloom.operators.joins import left_join
from leadloom.operators.projection import not_null
from leadloom.operators.setops import union_all

RETENTION_DAYS = (7, 14, 30, 60, 90)


def int_all_marketing_leads(
    leads_ads_community: DataFrame,
    website_form_responses: DataFrame,
    leads_course_strategi_ads: DataFrame,
    branding_level_up: DataFrame,
) -> DataFrame:
    return union_all(
        leads_ads_community, website_form_responses, leads_course_strategi_ads, branding_level_up
    )


def int_ai_chat_messages(messages: DataFrame, sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Messages with their session and user; guest sessions keep a NULL user.

    The user depends on the session only, so sessions are joined to users first
    and the messages, by far the largest table, are moved once.
    """
    s = sessions.select(
        F.col("id").alias("session_id"),
        "user_id",
        "guest_session_id",
        F.col("title").alias("session_title"),
        F.col("created_at").alias("session_created_at"),
        F.col("updated_at").alias("session_updated_at"),
    )
    u = users.select(
        F.col("id").alias("user_id"),
        F.col("email").alias("user_email"),
        F.col("mobile").alias("user_mobile"),
        "is_internal_user",
        F.col("created_at").alias("user_created_at"),
    )
    m = messages.select(
        F.col("id").alias("message_id"),
        "session_id",
        "role",
        "content",
        "message_order",
        F.col("created_at").alias("message_created_at"),
    )
    joined = left_join(m, left_join(s, u, "user_id"), "session_id")
    return joined.select(
        "message_id",
        "session_id",
        "user_id",
        "user_email",
        "user_mobile",
        "guest_session_id",
        "session_title",
        "role",
        "content",
        "message_order",
        "message_created_at",
        "is_internal_user",
        "user_created_at",
        "session_created_at",
        "session_updated_at",
    )


def int_user_retention(
    chat_messages: DataFrame,
    days: Sequence[int] = RETENTION_DAYS,
    exclude_internal: bool = False,
    roles: Collection[str] | None = None,
) -> DataFrame:
    """One row per user: activity, and whether the user wrote N days after joining.

    By default only messages without a user are left out. ``exclude_internal``
    removes users known to be internal, ``roles`` keeps messages of these roles.
    """
    rows = chat_messages.where(not_null("user_id"))
    if exclude_internal:
        rows = rows.where(~F.coalesce("is_internal_user", F.lit(False)))
    if roles is not None:
        rows = rows.where(F.col("role").isin(list(roles)))
    sent, joined_at = F.col("message_created_at"), F.col("user_created_at")
    measures = {
        "first_message_at": F.min(sent),
        "last_message_at": F.max(sent),
        "total_messages": F.count("*"),
        "active_days": distinct_days(sent),
    }
    measures |= {f"retained_{n}d": reached_after(sent, joined_at, n) for n in days}
    keys = ["user_id", "user_email", "user_mobile", "user_created_at", "is_internal_user"]
    return aggregate(rows, keys, measures)
