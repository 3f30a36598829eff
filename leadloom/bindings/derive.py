"""Raw tables derived from the benchmark tables.

Each table is a plain projection of one benchmark table: every row is used and no
rows are generated, so the derived tables grow with the data. The expressions are
written in syntax that Spark SQL and DuckDB share, so that the same raw input
feeds the Spark models and the SQL they are checked against. ``{ts}`` stands for
the zone-less timestamp type of the engine.

The values are invented. They include missing, blank and malformed contact
fields, all listed survey answers, one lead e-mail that holds a third of the
rows, and JSON documents with missing, null and empty parts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadloom.functions.normalize import BUSINESS_AGE, EMPLOYEE_COUNT, INCOME
from leadloom.session import on_release, shared_path
from leadloom.sources.tables import current_path, full_refresh

BATCH_TS = "2024-06-10 00:00:00"


def _quoted(text: str | None) -> str:
    return "null" if text is None else "'" + text.replace("'", "''") + "'"


def _pick(index: str, values: list[str | None]) -> str:
    """CASE that walks through a list of texts by a row number."""
    arms = " ".join(f"when {i} then {_quoted(v)}" for i, v in enumerate(values))
    return f"case {index} % {len(values)} {arms} end"


def _text(number: str) -> str:
    return f"cast({number} as string)"


def _div(number: str, by: int) -> str:
    return f"cast(floor({number} / {by}) as bigint)"


def _pad(number: str, width: int) -> str:
    return f"lpad({_text(number)}, {width}, '0')"


_K = "c_custkey"
# one address holds a third of the rows; the rest come in runs of 16 customers
_LEAD_NO = f"case when {_K} % 3 = 0 then 7 else {_div(_K, 16)} end"
_LEAD_EMAIL = (
    f"case when {_K} % 11 = 0 then null when {_K} % 11 = 1 then '' "
    f"when {_K} % 11 = 2 then 'not-an-email' "
    f"else '  User' || {_text(_LEAD_NO)} || '@Mail.Example.com ' end"
)
_PHONE_NO = _div(_K, 32)
_LEAD_PHONE = (
    f"case {_K} % 9 when 0 then null when 1 then '   ' when 2 then '12345' "
    f"when 3 then '+62 812-' || {_pad(_PHONE_NO, 7)} when 4 then '0812 ' || {_pad(_PHONE_NO, 7)} "
    f"when 5 then '62812' || {_pad(_PHONE_NO, 7)} when 6 then '812' || {_pad(_PHONE_NO, 7)} "
    f"when 7 then '(021) 555-' || {_pad(_PHONE_NO, 4)} else 'abc' end"
)
_LEAD_TS = (
    f"case when {_K} % 13 = 0 then null when {_K} % 13 = 1 then '' "
    f"else '2024-0' || {_text(f'(1 + {_K} % 9)')} || '-1' || {_text(f'{_K} % 10')} || ' 08:00:00' end"
)
_YES_NO = ["Ya", "Tidak", "", None, "Dalam proses"]

# Columns any lead source may have; a source uses the part that it needs.
LEADS: dict[str, str] = {
    "id": _K,
    "email": _LEAD_EMAIL,
    "phone_number": _LEAD_PHONE,
    "nama_usaha": f"'Usaha ' || {_text(_K)}",
    "nama_pemilik_usaha": f"case when {_K} % 7 = 0 then null else 'Pemilik ' || {_text(_K)} end",
    "nama_akun_media_sosial": f"'@usaha' || {_text(f'{_K} % 50')}",
    "nama_akun_ecommerce": f"case when {_K} % 5 = 0 then '' else 'toko' || {_text(f'{_K} % 60')} end",
    "bidang_usaha": "c_mktsegment",
    "bidang_usaha_yang_sedang_dijalankan_saat_ini_cth_pakaian_makana": "c_mktsegment",
    "lama_usaha": _pick(_div(_K, 4), [*BUSINESS_AGE, "belum mulai", None, ""]),
    "provinsi_usaha": f"'Provinsi ' || {_text('c_nationkey')}",
    "di_kota_mana_anda_menjalankan_usaha_anda": _pick(_div(_K, 4), ["  ", " Kota A ", "Kota B", None]),
    "sebutkan_nama_kota_kabupaten_tempat_usaha_kamu_beroperasi": _pick(
        _div(_K, 4), ["Kabupaten C", "", None, " Kota D"]
    ),
    "pendapatan_bulanan": _pick(_div(_K, 4), [*INCOME, "tidak tahu", None, ""]),
    "saat_ini_sudah_memiliki_berapa_karyawan": _pick(
        _div(_K, 4), [*EMPLOYEE_COUNT, " 0 ", "  ", None, "banyak"]
    ),
    "berapa_jumlah_karyawan_yang_anda_miliki": _pick(
        _div(_K, 4), ["banyak", None, *EMPLOYEE_COUNT, "", " > 50 orang"]
    ),
    "tergabung_komunitas_umkm": _pick(_div(_K, 4), _YES_NO),
    "memiliki_nib": _pick(_div(_K, 8), _YES_NO),
    "memiliki_sertifikasi_halal": _pick(_div(_K, 16), _YES_NO),
    "timestamp": _LEAD_TS,
    "sheet_name": f"'Sheet ' || {_text(f'{_K} % 3')}",
    "data_source": _pick(
        _K,
        [
            "leads_ads_community",
            "website_form_responses",
            "leads_course_strategi_ads",
            "branding_level_up",
        ],
    ),
    "extracted_at": f"'2024-06-0' || {_text(f'(1 + {_K} % 7)')} || ' 00:00:00'",
}

_O, _C = "o_orderkey", "o_custkey"
_DAY = "substr(cast(o_orderdate as string), 1, 10)"
_BUYER_NO = _div(_C, 4)
_COURSE = f"{_O} % 60"

PURCHASES: dict[str, str] = {
    "customer_name": f"case when {_O} % 19 = 0 then null else 'Customer ' || {_text(_O)} end",
    "email": (
        f"case when {_O} % 23 = 0 then null else "
        f"(case when {_C} % 5 = 0 then 'USER' else 'user' end) || {_text(_BUYER_NO)} || '@mail.example.com' end"
    ),
    "phone_number": f"case when {_O} % 46 < 40 then '0812' || {_pad(f'{_C} % 10000000', 7)} end",
    "created_at": "cast(o_orderdate as {ts})",
    "paid_at": "case when o_orderstatus = 'P' then null else cast(o_orderdate as {ts}) end",
    "product_type": "o_orderpriority",
    "course_id": _text(_COURSE),
    "amount": "o_totalprice",
    "payment_method": _pick(_O, ["card", "transfer", None]),
    "payment_channel": _pick(_C, ["web", "app"]),
    "data_source": "'purchase_form_data'",
    "extracted_at": f"cast('{BATCH_TS}' as {{ts}})",
}

# two accounts of different customers never share an address
ACCOUNTS: dict[str, str] = {
    "id": f"cast({_K} as int)",
    "user_id": f"cast({_K} + 1000 as int)",
    "subid": f"'sub-' || {_text(_K)}",
    "user_name": f"'account' || {_text(_K)}",
    "name": f"case when {_K} % 6 = 0 then null else 'Account ' || {_text(_K)} end",
    "email": f"case when {_K} % 29 = 0 then null else 'user' || {_text(_K)} || '@mail.example.com' end",
    "phone_number": f"case when {_K} % 2 = 0 then '0813' || {_pad(f'{_K} % 10000000', 7)} end",
    "phone_country": "'ID'",
    "phone_country_calling_code": "'62'",
    "description": "cast(null as string)",
    "avatar_url": f"'https://img.example.com/' || {_text(_K)}",
    "role": _pick(_K, ["learner", "learner", "educator", None]),
    "status": _pick(_K, ["ACTIVE", "INVITED", "ACTIVE"]),
    "total_course": "cast(c_nationkey % 3 as int)",
    "total_enrollment": f"cast({_K} % 5 as int)",
    "stripe_customer_ids": "case when c_nationkey % 2 = 0 then '[\"cus\"]' end",
    "metadata": f"'{{{{\"segment\":\"' || c_mktsegment || '\"}}}}'",
    "pre_signup_at": "cast(null as {ts})",
    "confirmed_at": f"cast('2023-12-2' || {_text(f'{_K} % 10')} || ' 09:00:00' as {{ts}})",
    "last_loggin_at": (
        f"case when {_K} % 4 = 0 then null else cast('2024-05-1' || {_text(f'{_K} % 10')} || ' 10:30:00' as {{ts}}) end"
    ),
    # includes days whose ISO year differs from the calendar year
    "created_at": (
        "cast(case c_nationkey % 4 when 0 then '2024-12-30' when 1 then '2021-01-01' "
        f"when 2 then '2023-0' || {_text(f'(1 + {_K} % 9)')} || '-05' else '2022-06-1' || {_text(f'{_K} % 10')} end "
        "|| ' 07:15:00' as {ts})"
    ),
    "data_source": "'eduqat_users'",
    "extracted_at": f"cast('{BATCH_TS}' as {{ts}})",
}

_META_FLAG = (
    f"case {_O} % 4 when 0 then '\"is_prakerja_user\":true,' when 1 then '\"is_prakerja_user\":false,' "
    "when 2 then '\"is_prakerja_user\":null,' else '' end"
)

_ENROLLMENT_TYPE = f"(case {_O} % 3 when 0 then 'manual' when 1 then 'self' else 'group' end)"
_REDEEMED = (
    f"(case when {_O} % 5 = 0 then ',\"prakerja_redeem_at\":\"' || {_DAY} || "
    f"'T15:45:00+07:00\",\"prakerja_redeem_code\":\"rc' || {_text(f'{_O} % 700')} || '\"' "
    f"when {_O} % 5 = 1 then ',\"prakerja_redeem_code\":null' else '' end)"
)


def _material(no: str, body: str) -> str:
    return f"'\"' || {_text(no)} || '\":{{{{{body}}}}}'"


_M1 = _material(
    f"(100 + {_C} % 50)",
    "\"type\":\"video\",\"is_required\":true,\"started_at\":\"' || "
    + _DAY
    + " || 'T08:15:00Z\",\"completed_at\":\"' || "
    + _DAY
    + " || 'T09:00:00Z\",\"tracked_time\":' || "
    + _text(f"{_O} % 5000")
    + " || '.5",
)
_M2 = _material(
    f"(200 + {_O} % 50)",
    "\"type\":\"survey\",\"survey_type\":\"' || case when "
    + f"{_O} % 2 = 0 then 'survey' else 'quiz' end || '\",\"survey_id\":' || "
    + f"case when {_O} % 6 = 0 then '\"\"' when {_O} % 6 = 2 then 'null' else '\"sv' || {_text(f'{_O} % 9')} || '\"' end || "
    + f"case when {_O} % 8 = 0 then '' else ',\"completed_at\":\"' || {_DAY} || 'T10:30:00+07:00\"' end || '",
)
_M3 = _material(
    f"(300 + {_C} % 20)",
    "\"type\":\"ai_tutor\",\"status\":\"DONE\",\"conversation_id\":\"c' || "
    + _text(_O)
    + " || '\",\"started_at\":null,\"start_conversation\":\"' || "
    + _DAY
    + " || ' 11:00:00\",\"end_conversation\":\"' || "
    + _DAY
    + " || ' 11:45:00\",\"count_submit\":' || "
    + _text(f"{_O} % 4")
    + " || ',\"self_assessment_id\":' || "
    + _text(f"{_C} % 10")
    + " || ',\"self_assessment_library_id\":\"lib\",\"require_feedback\":false,\"require_file_upload\":true,"
    + "\"require_educator_approval\":1",
)

ENROLLMENTS: dict[str, str] = {
    "id": _text(_O),
    "uid": f"'uid-' || {_text(_O)}",
    "user_id": f"'sub-' || {_text(_C)}",
    "course_id": f"case when {_O} % 41 = 0 then null else cast({_COURSE} as int) end",
    "price_id": f"cast({_O} % 7 as int)",
    "schedule_id": "cast(null as int)",
    "order_uid": f"'ord-' || {_text(_O)}",
    "order_data": _pick(_O, ["true", "false", None]),
    "timezone": "'Asia/Jakarta'",
    "learning_progress": f"cast({_O} % 101 as double)",
    "learning_time": f"cast({_O} % 7200 as int)",
    "completed_at": (
        "case o_orderstatus when 'F' then cast(o_orderdate as {ts}) + interval '44' hour "
        "when 'P' then cast(o_orderdate as {ts}) - interval '52' hour end"
    ),
    "expires_at": "cast(null as {ts})",
    "created_at": "cast(o_orderdate as {ts})",
    "user_data": (
        f"'{{{{\"created_at\":\"' || {_DAY} || 'T23:30:00+07:00\",\"email\":' || "
        f"case when {_O} % 31 = 0 then 'null' else '\"user' || {_text(_BUYER_NO)} || '@mail.example.com\"' end || "
        f"',\"name\":\"Learner ' || {_text(_C)} || '\"' || "
        f"case when {_C} % 2 = 0 then ',\"phone_number\":\"0812' || {_pad(f'{_C} % 10000000', 7)} || '\"' else '' end || "
        "',\"role\":\"learner\",\"status\":\"ACTIVE\"}}'"
    ),
    "metadata": (
        f"'{{{{' || {_META_FLAG} || '\"prakerja_id\":\"pk' || {_text(f'{_O} % 100')} || '\"' || {_REDEEMED} || ',\"started_at\":\"' || {_DAY} || "
        f"'T08:00:00Z\",\"tracked_time\":{{{{\"last_tracked_at\":\"' || {_DAY} || 'T12:00:00Z\",\"total\":' || "
        f"{_text(f'{_O} % 9000')} || '}}}},\"type\":\"' || {_ENROLLMENT_TYPE} || '\"}}}}'"
    ),
    "completions": (
        f"case {_O} % 7 when 0 then null when 1 then '{{{{\"materials\":null}}}}' "
        f"when 2 then '{{{{\"materials\":{{{{}}}}}}}}' when 3 then '{{{{\"materials\":[1]}}}}' "
        f"when 4 then '{{{{\"materials\":{{{{' || {_M1} || '}}}}}}}}' "
        f"when 5 then '{{{{\"materials\":{{{{' || {_M1} || ',' || {_M2} || '}}}}}}}}' "
        f"else '{{{{\"materials\":{{{{' || {_M1} || ',' || {_M2} || ',' || {_M3} || '}}}}}}}}' end"
    ),
    "certificates": (
        f"case {_O} % 3 when 0 then null when 1 then '[{{{{\"id\":\"a\"}}}}]' "
        "else '[{{\"id\":\"a\"}},{{\"id\":\"b\"}}]' end"
    ),
    "user_groups": "cast(null as string)",
    "user_group_admins": "cast(null as string)",
    "data_source": "'eduqat_enrollments'",
    "extracted_at": f"cast('{BATCH_TS}' as {{ts}})",
}

_P = "p_partkey"
COURSES: dict[str, str] = {
    "id": f"cast({_P} as int)",
    "name": "p_name",
    "slug": f"'course-' || {_text(_P)}",
    "description": "p_brand",
    "type": "p_type",
    "status": _pick(_P, ["published", "draft"]),
    "author": "p_brand",
    "duration": "cast(p_size * 60 as int)",
    "language_codes": "'[\"id\"]'",
    "categories": "'[\"' || p_type || '\"]'",
    "educators": "cast(null as string)",
    "images": "cast(null as string)",
    "prices": f"'[{{{{\"amount\":' || {_text('p_size')} || '}}}}]'",
    "tags": "cast(null as string)",
    "metadata": "'{{\"v\":1}}'",
    "parent": f"case when {_P} % 10 = 0 then null else cast({_P} - {_P} % 10 as int) end",
    "timezone": "'Asia/Jakarta'",
    "total_student": f"cast({_P} % 100 as int)",
    "rating": "cast(p_size % 5 as double)",
    "progress_status": "cast(null as string)",
    "start_date": "cast('2024-01-01 00:00:00' as {ts})",
    "end_date": "cast(null as {ts})",
    "published_at": "cast('2023-12-15 12:00:00' as {ts})",
    "data_source": "'eduqat_courses'",
    "extracted_at": f"cast('{BATCH_TS}' as {{ts}})",
}

_S = "event_type"
_U = "user_id"
CHAT_MESSAGES: dict[str, str] = {
    "id": f"'m' || {_text('event_id')}",
    "session_id": f"'s' || {_text(_U)} || '-' || {_S}",
    "role": f"case when {_S} in ('click', 'view') then 'user' else 'assistant' end",
    "content": "props",
    "message_order": "cast(event_id % 100 as int)",
    "created_at": "cast(ts as {ts})",
    "data_source": "'ai_chat_messages'",
    "extracted_at": f"cast('{BATCH_TS}' as {{ts}})",
}

# Per (user_id, event_type) of events; first_ts and last_ts are the extremes.
CHAT_SESSIONS: dict[str, str] = {
    # some messages refer to a session that is not there
    "id": f"(case when {_S} = 'view' and {_U} % 10 = 3 then 'x' else 's' end) || {_text(_U)} || '-' || {_S}",
    "user_id": f"case when {_S} = 'error' and {_U} % 4 = 0 then null else 'u' || {_text(_U)} end",
    "guest_session_id": f"case when {_S} = 'error' and {_U} % 4 = 0 then 'g' || {_text(_U)} end",
    "title": f"'Session ' || {_S}",
    "created_at": "cast(first_ts as {ts})",
    "updated_at": "cast(last_ts as {ts})",
    "data_source": "'ai_chat_sessions'",
    "extracted_at": f"cast('{BATCH_TS}' as {{ts}})",
}

# Per user_id of events.
USERS: dict[str, str] = {
    "id": f"(case when {_U} % 13 = 5 then 'gone' else 'u' end) || {_text(_U)}",
    "email": f"'user' || {_text(_U)} || '@mail.example.com'",
    "created_at": "cast(first_ts as {ts})",
    "updated_at": "cast(last_ts as {ts})",
    "role": "'member'",
    "eduqat_user_id": f"'sub-' || {_text(_U)}",
    "name": f"'User ' || {_text(_U)}",
    "mobile": f"case when {_U} % 8 = 1 then null else '62899' || {_pad(f'{_U} % 20', 7)} end",
    "mobile_verified": f"{_U} % 2 = 0",
    "mobile_verified_at": "cast(null as {ts})",
    "avatar_url": "cast(null as string)",
    "birth_date": "cast('1990-01-15' as date)",
    "address": "cast(null as string)",
    "city": f"'Kota ' || {_text(f'{_U} % 9')}",
    "province": f"'Provinsi ' || {_text(f'{_U} % 5')}",
    "postal_code": "'40111'",
    "language_preference": "'id'",
    "ai_tone_preference": "cast(null as string)",
    "interests": _pick(_U, ["[]", '["kopi","roti"]', None]),
    "level": "cast(null as string)",
    "voice_preference": "cast(null as string)",
    "latitude": f"cast({_U} % 90 as double)",
    "longitude": f"cast({_U} % 180 as double)",
    "segment": f"case when {_U} % 2 = 0 then 'a' else 'b' end",
    "business_name": "cast(null as string)",
    "data_source": "'users'",
    "extracted_at": f"cast('{BATCH_TS}' as {{ts}})",
}

# invented numbers of the derived users, standing in for the caller's own list
INTERNAL_MOBILES = ("628990000003", "628990000007", "628990000011")

SURVEYS: dict[str, str] = {
    "enrollment_id": f"'e' || {_text('doc_id')}",
    "material_id": _text("doc_id % 7"),
    "survey_id": f"'sv' || {_text('doc_id % 3')}",
    "course_id": "cast(doc_id % 60 as int)",
    "user_id": f"'sub-' || {_text('doc_id')}",
    "survey_type": "'survey'",
    "survey_title": f"'Survey ' || {_text('doc_id % 3')}",
    "elements": (
        "case doc_id % 6 when 0 then null when 1 then '[]' when 2 then 'null' else "
        f"'[{{{{\"description\":\"text quality\",\"question\":\"quality\",\"responses\":[' || {_text('quality')} || "
        f"'],\"type\":\"scale\"}}}},{{{{\"question\":\"toxic\",\"responses\":[' || {_text('toxic')} || "
        "'],\"type\":\"choice\"}}]' end"
    ),
    "completed_at": "cast('2024-03-01 08:00:00' as {ts})",
    "data_source": "'eduqat_survey_results'",
    "extracted_at": f"cast('{BATCH_TS}' as {{ts}})",
}

# raw table -> (benchmark table, or the grouped query it starts from; columns)
_EVENTS_BY_SESSION = (
    "(select user_id, event_type, min(ts) as first_ts, max(ts) as last_ts "
    "from events group by user_id, event_type) as s"
)
_EVENTS_BY_USER = (
    "(select user_id, min(ts) as first_ts, max(ts) as last_ts from events group by user_id) as u"
)
DERIVED: dict[str, tuple[str, dict[str, str]]] = {
    "leads": ("customer", LEADS),
    "purchase_form_data": ("orders", PURCHASES),
    "eduqat_users": ("customer", ACCOUNTS),
    "eduqat_enrollments": ("orders", ENROLLMENTS),
    "eduqat_courses": ("part", COURSES),
    "ai_chat_messages": ("events", CHAT_MESSAGES),
    "ai_chat_sessions": (_EVENTS_BY_SESSION, CHAT_SESSIONS),
    "users": (_EVENTS_BY_USER, USERS),
    "eduqat_survey_results": ("labels", SURVEYS),
}

JSON_COLUMNS: dict[str, list[str]] = {
    "eduqat_users": ["stripe_customer_ids", "metadata"],
    "eduqat_enrollments": [
        "order_data",
        "user_data",
        "metadata",
        "completions",
        "certificates",
        "user_groups",
        "user_group_admins",
    ],
    "eduqat_courses": [
        "language_codes",
        "categories",
        "educators",
        "images",
        "prices",
        "tags",
        "metadata",
    ],
    "users": ["interests"],
    "eduqat_survey_results": ["elements"],
}


# Expressions that several columns of a table repeat, by projection. Spark computes them once per
# row, and each projection in a method of its own: the one generated for all columns of the
# enrollments would be longer than the JVM compiles (8,000 bytes), and interpreted.
SHARED: dict[str, list[dict[str, str]]] = {
    "orders": [
        {"__day": _DAY, "__order": _text(_O), "__customer": _text(_C), "__buyer": _text(_BUYER_NO)},
        {"__first": _M1.format(), "__second": _M2.format()},
    ],
}


def columns_of(name: str, ts: str) -> Mapping[str, str]:
    """Column -> expression of a derived table in an engine's type names."""
    return {c: e.format(ts=ts) for c, e in DERIVED[name][1].items()}


def select_list(name: str, ts: str) -> str:
    return ", ".join(f'({e}) as "{c}"' for c, e in columns_of(name, ts).items())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(scan: DataFrame) -> DataFrame:
    """A benchmark table too small to give every core a task, over all cores."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def _source(spark: SparkSession, sf_dir: str, name: str, spread: bool) -> DataFrame:
    source = DERIVED[name][0]
    if source is _EVENTS_BY_SESSION or source is _EVENTS_BY_USER:
        keys = ["user_id", "event_type"] if source is _EVENTS_BY_SESSION else ["user_id"]
        events = table(spark, sf_dir, "events")
        return events.groupBy(*keys).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    scan = table(spark, sf_dir, source)
    return _spread(scan) if spread else scan


def raw_text(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A derived raw table with its JSON columns still text."""
    rows, shared = _source(spark, sf_dir, name, spread), {}
    for made in SHARED.get(DERIVED[name][0], []):
        rows = rows.selectExpr("*", *[f"{_with(shared, e)} as `{c}`" for c, e in made.items()])
        shared = {**made, **shared}  # the longer expressions first
    columns = columns_of(name, "timestamp_ntz")
    return rows.selectExpr(*[f"({_with(shared, e)}) as `{c}`" for c, e in columns.items()])


def _with(shared: Mapping[str, str], text: str) -> str:
    """An expression in terms of columns that hold parts of it."""
    for c, part in shared.items():
        text = text.replace(part, f"`{c}`")
    return text


def parsed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived raw table with its JSON columns as VARIANT, not yet landed."""
    df = raw_text(spark, sf_dir, name, spread=True)
    return df.withColumns({c: F.parse_json(F.col(c)) for c in JSON_COLUMNS.get(name, [])})


# application, data folder and table -> path and schema of the landed table
_landed: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def land(spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """A raw table as the loaders leave it: a written table in the shared folder.

    It is written at first use and read by every later query of the session. The
    models then scan it as they would scan any raw table: Spark stores VARIANT
    columns shredded and reads only the JSON fields a model asks for.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        path, df = shared_path(spark, f"raw-{name}"), rows()
        full_refresh(df, path, skip_if_empty=False)
        _landed[key] = current_path(spark, path), df.schema
    path, schema = _landed[key]
    return spark.read.schema(schema).parquet(path)


@on_release
def forget_landed() -> None:
    """Land the raw tables again at their next use."""
    _landed.clear()


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived raw table, landed."""
    return land(spark, sf_dir, name, lambda: parsed(spark, sf_dir, name))


def raw_leads(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The raw table of one lead sheet, landed."""

    def rows() -> DataFrame:
        return raw_text(spark, sf_dir, "leads", spread=True).where(F.col("data_source") == source)

    return land(spark, sf_dir, source, rows)
