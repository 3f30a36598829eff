"""Declared layouts: the raw tables and the common lead layout.

Types are Spark SQL types; ``varchar(n)`` is text with a checked length, and
``variant`` holds JSON. NUMERIC without a precision is ``decimal(38,6)``.
"""

from __future__ import annotations

# Provenance, the last columns of every raw table.
STAMP = {"data_source": "varchar(100)", "extracted_at": "timestamp_ntz"}

# Columns and types of the raw tables.
RAW: dict[str, dict[str, str]] = {
    "purchase_form_data": {
        "customer_name": "varchar(255)",
        "email": "varchar(255)",
        "phone_number": "varchar(50)",
        "created_at": "timestamp_ntz",
        "paid_at": "timestamp_ntz",
        "product_type": "varchar(100)",
        "course_id": "varchar(255)",
        "amount": "decimal(38,6)",
        "payment_method": "varchar(100)",
        "payment_channel": "varchar(100)",
        **STAMP,
    },
    "users": {
        "id": "string",
        "email": "varchar(255)",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
        "role": "varchar(50)",
        "eduqat_user_id": "varchar(255)",
        "name": "varchar(255)",
        "mobile": "varchar(50)",
        "mobile_verified": "boolean",
        "mobile_verified_at": "timestamp_ntz",
        "avatar_url": "string",
        "birth_date": "date",
        "address": "string",
        "city": "varchar(255)",
        "province": "varchar(255)",
        "postal_code": "varchar(20)",
        "language_preference": "varchar(10)",
        "ai_tone_preference": "varchar(50)",
        "interests": "variant",
        "level": "varchar(50)",
        "voice_preference": "varchar(50)",
        "latitude": "double",
        "longitude": "double",
        "segment": "varchar(100)",
        "business_name": "varchar(255)",
        **STAMP,
    },
    "ai_chat_messages": {
        "id": "string",
        "session_id": "string",
        "role": "string",
        "content": "string",
        "message_order": "int",
        "created_at": "timestamp_ntz",
        **STAMP,
    },
    "ai_chat_sessions": {
        "id": "string",
        "user_id": "string",
        "guest_session_id": "string",
        "title": "string",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
        **STAMP,
    },
    "eduqat_enrollments": {
        "id": "varchar(255)",
        "uid": "varchar(255)",
        "user_id": "varchar(255)",
        "course_id": "int",
        "price_id": "int",
        "schedule_id": "int",
        "order_uid": "varchar(255)",
        "order_data": "variant",
        "timezone": "varchar(100)",
        "learning_progress": "double",
        "learning_time": "int",
        "completed_at": "timestamp_ntz",
        "expires_at": "timestamp_ntz",
        "created_at": "timestamp_ntz",
        "user_data": "variant",
        "metadata": "variant",
        "completions": "variant",
        "certificates": "variant",
        "user_groups": "variant",
        "user_group_admins": "variant",
        **STAMP,
    },
    "eduqat_users": {
        "id": "int",
        "user_id": "int",
        "subid": "varchar(255)",
        "user_name": "varchar(255)",
        "name": "varchar(255)",
        "email": "varchar(255)",
        "phone_number": "varchar(50)",
        "phone_country": "varchar(50)",
        "phone_country_calling_code": "varchar(10)",
        "description": "string",
        "avatar_url": "string",
        "role": "varchar(50)",
        "status": "varchar(50)",
        "total_course": "int",
        "total_enrollment": "int",
        "stripe_customer_ids": "variant",
        "metadata": "variant",
        "pre_signup_at": "timestamp_ntz",
        "confirmed_at": "timestamp_ntz",
        "last_loggin_at": "timestamp_ntz",
        "created_at": "timestamp_ntz",
        **STAMP,
    },
    "eduqat_courses": {
        "id": "int",
        "name": "varchar(500)",
        "slug": "varchar(500)",
        "description": "string",
        "type": "varchar(50)",
        "status": "varchar(50)",
        "author": "varchar(255)",
        "duration": "int",
        "language_codes": "variant",
        "categories": "variant",
        "educators": "variant",
        "images": "variant",
        "prices": "variant",
        "tags": "variant",
        "metadata": "variant",
        "parent": "int",
        "timezone": "varchar(100)",
        "total_student": "int",
        "rating": "decimal(38,6)",
        "progress_status": "varchar(50)",
        "start_date": "timestamp_ntz",
        "end_date": "timestamp_ntz",
        "published_at": "timestamp_ntz",
        **STAMP,
    },
    "eduqat_ai_conversations": {
        "id": "int",
        "conversation_id": "varchar(255)",
        "user_id": "varchar(255)",
        "enrollment_id": "varchar(255)",
        "course_id": "int",
        "material_id": "int",
        "status": "varchar(50)",
        "score": "int",
        "content": "string",
        "audio_url": "string",
        "x_site_id": "varchar(100)",
        "educator_id": "varchar(255)",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
        "user_data": "variant",
        "educator_data": "variant",
        **STAMP,
    },
    # the messages of a conversation, one row each
    "eduqat_ai_messages": {
        "conversation_id": "varchar(255)",
        "position": "int",
        "session_id": "string",
        "sender": "string",
        "value": "string",
        "timestamp": "timestamp_ntz",
        **STAMP,
    },
    "eduqat_survey_results": {
        "enrollment_id": "varchar(255)",
        "material_id": "varchar(255)",
        "survey_id": "varchar(255)",
        "course_id": "int",
        "user_id": "varchar(255)",
        "survey_type": "varchar(50)",
        "survey_title": "string",
        "elements": "variant",
        "completed_at": "timestamp_ntz",
        **STAMP,
    },
}

# Lead sheets have whatever columns their headers name, all text; these are
# added on load.
LEAD_SHEETS = (
    "leads_ads_community",
    "website_form_responses",
    "leads_course_strategi_ads",
    "branding_level_up",
)
LEAD_ADDED = {
    "id": "bigint",
    "sheet_name": "string",
    "data_source": "string",
    "extracted_at": "string",
    "loaded_at": "timestamp_ntz",
}

# Column order of every staged lead source.
LEAD_LAYOUT = (
    "email",
    "phone_number",
    "nama_usaha",
    "nama_pemilik_usaha",
    "nama_akun_media_sosial",
    "nama_akun_ecommerce",
    "bidang_usaha",
    "lama_usaha",
    "provinsi_usaha",
    "kota_kabupaten",
    "pendapatan_bulanan",
    "jumlah_karyawan",
    "tergabung_komunitas_umkm",
    "memiliki_nib",
    "memiliki_sertifikasi_halal",
    "timestamp",
    "sheet_name",
    "data_source",
    "extracted_at",
    "composite_key",
)

# Keys the raw tables declare.
UNIQUE_KEYS: dict[str, list[list[str]]] = {
    "eduqat_enrollments": [["id"]],
    "eduqat_users": [["id"]],
    "eduqat_courses": [["id"]],
    "eduqat_ai_conversations": [["id"], ["conversation_id"]],
    "eduqat_ai_messages": [["conversation_id", "position"]],
    "eduqat_survey_results": [["enrollment_id", "material_id"]],
}


# Raw tables loaded from a source database: the table they come from, and the
# columns that have another name there.
SOURCE_TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "purchase_form_data": (
        "payments",
        {"email": "customer_email", "phone_number": "customer_phone"},
    ),
    "users": ("users", {}),
    "ai_chat_messages": ("ai_chat_messages", {}),
    "ai_chat_sessions": ("ai_chat_sessions", {}),
}

# JSON columns in which an empty value is kept as it is.
KEEP_EMPTY: dict[str, tuple[str, ...]] = {"users": ("interests",)}

# Names that nested values have in the endpoint's items.
ITEM_NAMES: dict[str, dict[str, str]] = {
    "eduqat_ai_conversations": {"user_data": "user", "educator_data": "educator"},
}


def _extracted(table: str) -> dict[str, str]:
    return {c: t for c, t in RAW[table].items() if c not in STAMP}


def source_query(table: str) -> str:
    """Projection query that extracts a raw table from the source database."""
    source, names = SOURCE_TABLES[table]
    return f"SELECT {', '.join(names.get(c, c) for c in _extracted(table))} FROM {source}"


def item_fields(table: str) -> str:
    """DDL fields of an endpoint's items, for reading its landed pages.

    Timestamps are read as text, so that the typed load drops an offset instead
    of applying it, and amounts as text, so that no digit is lost.
    """
    names = ITEM_NAMES.get(table, {})
    as_text = ("varchar", "timestamp", "decimal")
    fields = {
        names.get(c, c): "string" if t.startswith(as_text) else t
        for c, t in _extracted(table).items()
    }
    return ", ".join(f"{c}: {t}" for c, t in fields.items())


def length_limits(table: str) -> dict[str, int]:
    """Column -> longest text its VARCHAR(n) allows."""
    return {
        c: int(t[len("varchar(") : -1]) for c, t in RAW[table].items() if t.startswith("varchar")
    }
