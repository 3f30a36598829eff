"""Projections, joins, aggregates, unnesting and scalar functions, one query per
operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom import functions as fn
from leadloom import operators as ops
from leadloom import plans
from leadloom.bindings import derive
from leadloom.bindings.catalog import Catalog, flat
from leadloom.bindings.model_sql import BUSINESS_AGE, EMPLOYEE_COUNT, INCOME, sql_email, sql_map, sql_phone, with_models
from leadloom.bindings.models import Models
from leadloom.functions.jsonv import json_object
from leadloom.session import shared_path

CATALOG = Catalog()


# --- projection and predicates -------------------------------------------------


@CATALOG.query(
    "project_rename",
    "select p_partkey as course_id, p_name as course_name, p_type as course_type from part",
)
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"course_id": "p_partkey", "course_name": "p_name", "course_type": "p_type"}
    return ops.project(derive.table(spark, sf_dir, "part"), names)


@CATALOG.query(
    "pad_missing_columns",
    """
    select c_custkey as id, cast(null as varchar) as memiliki_nib, cast(null as timestamp) as paid_at,
           c_name as nama from customer
    """,
)
def pad_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.project(
        derive.table(spark, sf_dir, "customer"),
        {"id": "c_custkey", "nama": "c_name"},
        pad={"memiliki_nib": "string", "paid_at": "timestamp_ntz"},
        order=["id", "memiliki_nib", "paid_at", "nama"],
    )


@CATALOG.query(
    "filter_any_key_present",
    with_models("raw_leads")
    + " select id, email, phone_number from raw_leads where email is not null or phone_number is not null",
)
def filter_any_key_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = derive.raw_text(spark, sf_dir, "leads").select("id", "email", "phone_number")
    return leads.where(ops.any_not_null("email", "phone_number"))


@CATALOG.query(
    "filter_not_null",
    with_models("raw_purchase_form_data")
    + " select email, paid_at from raw_purchase_form_data where paid_at is not null",
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchases = derive.raw_text(spark, sf_dir, "purchase_form_data").select("email", "paid_at")
    return purchases.where(ops.not_null("paid_at"))


@CATALOG.query(
    "flag_in_list",
    with_models("raw_users")
    + f" select id, mobile in ({', '.join(repr(m) for m in derive.INTERNAL_MOBILES)}) as is_internal_user from raw_users",
)
def flag_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = derive.raw_text(spark, sf_dir, "users")
    return users.select("id", fn.flag_in_list(F.col("mobile"), derive.INTERNAL_MOBILES).alias("is_internal_user"))


_STATUS = {"F": "finished", "O": "open", "P": None}


@CATALOG.query(
    "case_map",
    f"select o_orderkey, {sql_map('o_orderstatus', _STATUS)} as status, "
    f"{sql_map('o_orderpriority', {'1-URGENT': 'now', '5-LOW': 'later'})} as priority from orders",
)
def case_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.case_map(F.col("o_orderstatus"), _STATUS).alias("status"),
        fn.case_map(F.col("o_orderpriority"), {"1-URGENT": "now", "5-LOW": "later"}).alias("priority"),
    )


@CATALOG.query(
    "case_search",
    """
    select o_orderkey, case when o_totalprice > 300000 then 'high' when o_totalprice > 100000 then 'mid' end as band
    from orders
    """,
)
def case_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    band = F.when(price > 300000, "high").when(price > 100000, "mid")
    return derive.table(spark, sf_dir, "orders").select("o_orderkey", band.alias("band"))


@CATALOG.query(
    "filter_json_field",
    """
    select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events
    where json_extract_string(props, '$.k') = '42' or json_extract_string(props, '$.missing') is not null
    """,
)
def filter_json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derive.table(spark, sf_dir, "events")
    docs = events.select("event_id", F.parse_json("props").alias("props"))
    hit = fn.json_text(F.col("props"), "$.k") == "42"
    other = fn.json_text(F.col("props"), "$.missing").isNotNull()
    return docs.where(hit | other).select("event_id", fn.json_as(F.col("props"), "$.k", "int").alias("k"))


@CATALOG.query(
    "filter_json_object",
    with_models("raw_eduqat_enrollments")
    + """
    select id, course_id from raw_eduqat_enrollments
    where json_type(completions, '$.materials') = 'OBJECT'
    """,
)
def filter_json_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive.raw(spark, sf_dir, "eduqat_enrollments")
    return raw.where(fn.is_json_object(F.col("completions"), "$.materials")).select("id", "course_id")


@CATALOG.query(
    "like_filter",
    """
    select c_custkey, c_name from customer
    where (c_name like 'Customer#%1' or c_mktsegment like 'B%') and c_name like '%#%0%'
    """,
)
def like_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = derive.table(spark, sf_dir, "customer")
    either = F.col("c_name").like("Customer#%1") | F.col("c_mktsegment").startswith("B")
    return customer.where(either & F.col("c_name").like("%#%0%")).select("c_custkey", "c_name")


# --- joins ------------------------------------------------------------------------


@CATALOG.query(
    "join_left_chain",
    """
    select l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_custkey, c.c_name from lineitem l
    left join (select * from orders where o_orderstatus <> 'P') o on l.l_orderkey = o.o_orderkey
    left join customer c on o.o_custkey = c.c_custkey
    """,
)
def join_left_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derive.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = derive.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    orders = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customer = derive.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return ops.left_join(ops.left_join(lines, orders, "l_orderkey"), customer, "o_custkey")


@CATALOG.query(
    "join_left_multi_key",
    with_models("stg_eduqat_enrollments", "stg_purchase_form_data")
    + """
    select e.enrollment_id, e.course_id, e.user_email as email, p.customer_name, p.paid_at
    from stg_eduqat_enrollments e
    left join stg_purchase_form_data p on e.course_id = p.course_id and e.user_email = p.email
    """,
)
def join_left_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Models(spark, sf_dir)
    e = m.enrollments().select("enrollment_id", "course_id", F.col("user_email").alias("email"))
    p = m.purchases().select("course_id", "email", "customer_name", "paid_at")
    return ops.left_join_fanout(e, p, ["course_id", "email"]).select(
        "enrollment_id", "course_id", "email", "customer_name", "paid_at"
    )


@CATALOG.query(
    "join_left_dim",
    """
    select l_orderkey, l_linenumber, l_quantity, l_partkey, p_name, p_brand
    from lineitem left join (select * from part where p_size > 10) on l_partkey = p_partkey
    """,
)
def join_left_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derive.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_partkey"
    )
    part = derive.table(spark, sf_dir, "part").where(F.col("p_size") > 10)
    part = part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return ops.left_join(lines, part, "l_partkey")


@CATALOG.query(
    "join_full_outer_chain",
    with_models("latest_leads", "agg_purchases", "agg_enrollments", "stg_eduqat_users")
    + """
    select coalesce(m.email, p.email, u.email, e.email) as email, m.phone_number, m.nama_usaha,
           p.total_purchases, u.user_id, e.enrolled_courses_count
    from latest_leads m full outer join agg_purchases p on m.email = p.email
    full outer join (select email, user_id from stg_eduqat_users) u on coalesce(m.email, p.email) = u.email
    full outer join agg_enrollments e on coalesce(m.email, p.email, u.email) = e.email
    """,
)
def join_full_outer_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadloom.plans.marts import agg_enrollments, agg_purchases, latest_leads

    m = Models(spark, sf_dir)
    leads = latest_leads(m.leads_table()).select("email", "phone_number", "nama_usaha")
    return ops.full_outer_on(
        "email",
        repeated=[
            ops.Repeated.split(m.accounts().select("email", "user_id"), "email"),
            ops.Repeated.split(leads, "email"),
        ],
        per_key=[
            agg_purchases(m.purchases()).select("email", "total_purchases"),
            agg_enrollments(m.enrollments()).select("email", "enrolled_courses_count"),
        ],
    ).select("email", "phone_number", "nama_usaha", "total_purchases", "user_id", "enrolled_courses_count")


@CATALOG.query(
    "lateral_unnest_ordinality",
    """
    select doc_id, pos as position, line from (
        select doc_id, unnest(string_split("text", chr(10))) as line,
               cast(generate_subscripts(string_split("text", chr(10)), 1) as bigint) as pos
        from documents
    )
    """,
)
def lateral_unnest_ordinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a JSON array of its lines."""
    documents = derive.table(spark, sf_dir, "documents")
    lines = F.to_variant_object(F.split("text", "\n")).alias("lines")
    rows = ops.unnest_array(
        documents.select("doc_id", lines),
        F.col("lines"),
        {"line": fn.json_text(F.col("value"), "$")},
        base=1,
    )
    return rows.select("doc_id", "position", "line")


@CATALOG.query(
    "lateral_unnest_object",
    """
    select l_orderkey, l_linenumber, cast(sum(l_quantity) as double) as quantity, count(*) as line_count
    from lineitem group by l_orderkey, l_linenumber
    """,
)
def lateral_unnest_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines nested as an object by line number, and unnested again.

    An order has at most seven line numbers, so the object is bounded once the
    lines are summed by number.
    """
    line = F.col("l_linenumber").cast("string")
    body = F.struct(F.col("quantity"), F.col("line_count"))
    summed = (
        derive.table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.sum("l_quantity").alias("quantity"), F.count("*").alias("line_count"))
    )
    members = F.map_from_entries(F.collect_list(F.struct(line, body)))
    orders = summed.groupBy("l_orderkey").agg(members.alias("lines"))
    value = F.col("value")
    rows = ops.unnest_object(
        orders.select("l_orderkey", F.to_variant_object("lines").alias("lines")),
        F.col("lines"),
        {
            "quantity": fn.json_as(value, "$.quantity", "double"),
            "line_count": fn.json_as(value, "$.line_count", "bigint"),
        },
        key="l_linenumber",
        key_type="int",
    )
    return rows.drop("lines")


@CATALOG.query(
    "drill_across",
    with_models("mart_enrollment", "mart_materials")
    + """
    select e.enrollment_id, e.purchase_rows, e.learning_time_seconds, m.materials, m.tracked_seconds
    from (select enrollment_id, count(*) as purchase_rows, max(learning_time_seconds) as learning_time_seconds
          from mart_enrollment group by 1) e
    full join (select enrollment_id, count(*) as materials, sum(material_tracked_time_seconds) as tracked_seconds
               from mart_materials group by 1) m on e.enrollment_id = m.enrollment_id
    """,
)
def drill_across(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Models(spark, sf_dir)
    return ops.drill_across(
        m.enrollment(),
        m.material(),
        "enrollment_id",
        {"purchase_rows": F.count("*"), "learning_time_seconds": F.max("learning_time_seconds")},
        {"materials": F.count("*"), "tracked_seconds": F.sum("material_tracked_time_seconds")},
    )


def _drill_email(name: str, right: str, right_sql: str, right_aggs) -> None:
    """Contacts by e-mail next to a fact table, keys of either side kept."""
    sql = with_models("mart_contact", right) + f"""
    select coalesce(c.email, r.email) as email, c.contacts, c.phones, r.* exclude (email)
    from (select email, count(*) as contacts, count(distinct phone_number) as phones from mart_contact group by 1) c
    full join (select email, {right_sql} from {right} group by 1) r on c.email is not distinct from r.email
    """

    @CATALOG.query(name, sql)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = Models(spark, sf_dir)
        facts = m.enrollment() if right == "mart_enrollment" else m.material()
        contacts = {"contacts": F.count("*"), "phones": F.count_distinct("phone_number")}
        return ops.drill_across(m.contact_table(), facts, "email", contacts, right_aggs())


_drill_email(
    "drill_across_email_enrollments",
    "mart_enrollment",
    "count(distinct enrollment_id) as enrollments, max(purchased_at) as last_purchase",
    lambda: {"enrollments": F.count_distinct("enrollment_id"), "last_purchase": F.max("purchased_at")},
)
_drill_email(
    "drill_across_email_materials",
    "mart_materials",
    "count(*) as materials, max(material_completed_at) as last_material",
    lambda: {"materials": F.count("*"), "last_material": F.max("material_completed_at")},
)


# --- aggregates -----------------------------------------------------------------


@CATALOG.query(
    "agg_ordered_first",
    """
    select o_custkey,
           list(o_orderkey order by paid desc nulls first, o_orderkey desc)[1] as latest_nulls_first,
           list(o_orderkey order by paid desc nulls last, o_orderkey desc)[1] as latest_nulls_last
    from (select *, case when o_orderstatus <> 'P' then o_orderdate end as paid from orders) group by o_custkey
    """,
)
def agg_ordered_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    orders = derive.table(spark, sf_dir, "orders").withColumn("paid", paid)
    key = F.col("o_orderkey")
    return ops.aggregate(
        orders,
        ["o_custkey"],
        {
            f"latest_nulls_{n}": ops.value_of_latest(key, F.col("paid"), nulls=n, tiebreak=[key])
            for n in ("first", "last")
        },
    )


@CATALOG.query(
    "agg_filtered_count",
    with_models("stg_eduqat_enrollments")
    + """
    select course_id, count(*) as enrollments, count(*) filter (where is_prakerja_user = true) as prakerja
    from stg_eduqat_enrollments group by course_id
    """,
)
def agg_filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {"enrollments": F.count("*"), "prakerja": ops.count_where(F.col("is_prakerja_user"))}
    return ops.aggregate(Models(spark, sf_dir).enrollments(), ["course_id"], measures)


@CATALOG.query(
    "agg_distinct_days",
    "select user_id, event_type, count(distinct date_trunc('day', ts)) as active_days from events group by 1, 2",
)
def agg_distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derive.table(spark, sf_dir, "events")
    return ops.aggregate(events, ["user_id", "event_type"], {"active_days": ops.distinct_days(F.col("ts"))})


@CATALOG.query(
    "agg_bool_or",
    """
    select user_id, cast(bool_or(ts >= t0 + interval 14 day) as integer) as reached_14d,
           cast(bool_or(ts >= t0 + interval 29 day) as integer) as reached_29d
    from (select user_id, ts, case when user_id % 5 <> 0 then timestamp '2024-01-01 12:00:00' end as t0 from events)
    group by user_id
    """,
)
def agg_bool_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    events = derive.table(spark, sf_dir, "events").withColumn("t0", F.when(F.col("user_id") % 5 != 0, start))
    reached = {f"reached_{n}d": ops.reached_after(F.col("ts"), F.col("t0"), n) for n in (14, 29)}
    return ops.aggregate(events, ["user_id"], reached)


@CATALOG.query(
    "agg_multi_key",
    with_models("stg_users")
    + """
    select mobile, segment, city, is_internal_user, mobile_verified, count(*) as users
    from stg_users group by all
    """,
)
def agg_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["mobile", "segment", "city", "is_internal_user", "mobile_verified"]
    return ops.aggregate(Models(spark, sf_dir).users(), keys, {"users": F.count("*")})


@CATALOG.query(
    "json_min",
    with_models("raw_eduqat_enrollments")
    + """
    select r.id, min(nullif(json_extract_string(e.value, '$.started_at'), '')) as first_start
    from raw_eduqat_enrollments r left join (
        select r2.id, e2.value from raw_eduqat_enrollments r2, json_each(r2.completions, '$.materials') e2
        where json_type(r2.completions, '$.materials') = 'OBJECT'
    ) e on r.id = e.id group by r.id
    """,
)
def json_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive.raw(spark, sf_dir, "eduqat_enrollments")
    first = fn.earliest_in_object(F.col("completions"), "$.materials", "started_at")
    return raw.select("id", first.alias("first_start"))


# --- windows, top-1, set operations -------------------------------------------------


@CATALOG.query(
    "dedup_latest",
    """
    select o_custkey, o_orderstatus, o_orderkey, o_orderdate from (
        select *, row_number() over (partition by o_custkey, o_orderstatus
                                     order by o_orderdate desc nulls last, o_orderkey) as rn from orders
    ) where rn = 1
    """,
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derive.table(spark, sf_dir, "orders")
    rows = orders.select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderdate")
    return ops.dedup_latest(
        rows,
        ["o_custkey", "o_orderstatus"],
        [F.col("o_orderdate").desc_nulls_last()],
        [F.col("o_orderkey").asc()],
    )


@CATALOG.query(
    "dedup_latest_folded",
    """
    select o_custkey, o_orderstatus, o_orderkey, o_orderdate from (
        select *, row_number() over (partition by o_custkey, o_orderstatus
                                     order by o_orderdate desc nulls last, o_orderkey) as rn from orders
    ) where rn = 1
    """,
)
def dedup_latest_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three extracts, the oldest of them late, folded into the rows kept so far."""
    orders = derive.table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderdate")
    kept = ops.LatestRows(
        spark,
        shared_path(spark, "latest"),
        ["o_custkey", "o_orderstatus"],
        [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc()],
        buckets=16,
    )
    few = orders.where("o_custkey % 100 = 7")
    for extract in (orders.where("o_orderkey % 3 <> 0"), few, orders.where("o_orderkey % 3 = 0")):
        kept.fold(extract)
    return kept.read()


@CATALOG.query(
    "top1_per_group",
    """
    select event_type, max(value) as top_value,
           (list(event_id order by value desc, event_id desc))[1] as top_event from events group by event_type
    """,
)
def top1_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derive.table(spark, sf_dir, "events")
    latest = ops.value_of_latest(F.col("event_id"), F.col("value"), nulls="last", tiebreak=[F.col("event_id")])
    return ops.aggregate(events, ["event_type"], {"top_value": F.max("value"), "top_event": latest})


@CATALOG.query(
    "ordinality",
    with_models("raw_eduqat_survey_results")
    + """
    select r.enrollment_id, cast(e.key as bigint) as question_index, cast(e.key as bigint) + 1 as question_number
    from raw_eduqat_survey_results r, json_each(r.elements) e where json_type(r.elements) = 'ARRAY'
    """,
)
def ordinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive.raw(spark, sf_dir, "eduqat_survey_results").select("enrollment_id", "elements")
    rows = ops.unnest_array(raw, F.col("elements"), {}, position="question_index")
    return rows.select("enrollment_id", "question_index", (F.col("question_index") + 1).alias("question_number"))


@CATALOG.query(
    "union_all_leads",
    with_models("int_all_marketing_leads")
    + " select data_source, count(*) as lead_rows, count(distinct composite_key) as keys from int_all_marketing_leads group by 1",
)
def union_all_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {"lead_rows": F.count("*"), "keys": F.count_distinct("composite_key")}
    return ops.aggregate(Models(spark, sf_dir).leads(), ["data_source"], measures)


@CATALOG.query(
    "union_by_name",
    """
    select c_custkey as key, c_name as name, c_mktsegment as segment, cast(null as integer) as nation, 'customer' as origin from customer
    union all select s_suppkey, s_name, null, s_nationkey, 'supplier' from supplier
    """,
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = derive.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    supplier = derive.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    tables = {"customer": customer, "supplier": supplier, "draft": customer}
    return ops.union_by_name(tables, tag_column="origin", exclude=["draft"])


# --- scalar functions --------------------------------------------------------------


@CATALOG.query(
    "normalize_email", with_models("raw_leads") + f" select id, {sql_email('email')} as email from raw_leads"
)
def normalize_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = derive.raw_text(spark, sf_dir, "leads")
    return leads.select("id", fn.normalize_email(F.col("email")).alias("email"))


@CATALOG.query(
    "normalize_phone",
    with_models("raw_leads")
    + f" select id, {sql_phone('phone_number')} as phone, {sql_phone('cast(id * 8123457 as varchar)')} as synthetic from raw_leads",
)
def normalize_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = derive.raw_text(spark, sf_dir, "leads")
    number = (F.col("id") * 8123457).cast("string")
    return leads.select(
        "id",
        fn.normalize_phone(F.col("phone_number")).alias("phone"),
        fn.normalize_phone(number).alias("synthetic"),
    )


def _category(name: str, column: str, values: dict, function) -> None:
    sql = with_models("raw_leads") + f" select id, {sql_map(column, values)} as label from raw_leads"

    @CATALOG.query(name, sql)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        leads = derive.raw_text(spark, sf_dir, "leads")
        return leads.select("id", function(F.col(column)).alias("label"))


_category("normalize_business_age", "lama_usaha", BUSINESS_AGE, fn.normalize_business_age)
_category("normalize_income", "pendapatan_bulanan", INCOME, fn.normalize_income)
_category(
    "normalize_employee_count",
    "saat_ini_sudah_memiliki_berapa_karyawan",
    EMPLOYEE_COUNT,
    fn.normalize_employee_count,
)


@CATALOG.query(
    "composite_key",
    with_models("raw_leads")
    + " select id, coalesce(email, '') || '|' || coalesce(phone_number, '') as composite_key from raw_leads",
)
def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = derive.raw_text(spark, sf_dir, "leads")
    return leads.select("id", fn.composite_key(F.col("email"), F.col("phone_number")).alias("composite_key"))


@CATALOG.query(
    "blank_to_null",
    with_models("raw_leads")
    + " select id, nullif(trim(di_kota_mana_anda_menjalankan_usaha_anda, ' '), '') as city from raw_leads",
)
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = derive.raw_text(spark, sf_dir, "leads")
    city = fn.blank_to_null(F.col("di_kota_mana_anda_menjalankan_usaha_anda"))
    return leads.select("id", city.alias("city"))


@CATALOG.query(
    "string_functions",
    """
    select c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') as digits, substr(c_name, 10) as tail,
           length(c_name) as name_length, lower(c_mktsegment) as segment from customer
    """,
)
def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    return derive.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.regexp_replace(name, "[^0-9]", "").alias("digits"),
        F.expr("substring(c_name, 10)").alias("tail"),
        F.length(name).cast("long").alias("name_length"),
        F.lower("c_mktsegment").alias("segment"),
    )


@CATALOG.query(
    "string_functions_long",
    """
    select doc_id, length(substr("text", 10)) as tail_length, md5(substr("text", 10)) as tail,
           md5(lower("text")) as low from documents
    """,
)
def string_functions_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of any length, of which nothing is cut."""
    tail = F.expr("substring(text, 10)")
    return derive.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.length(tail).cast("long").alias("tail_length"),
        F.md5(tail).alias("tail"),
        F.md5(F.lower("text")).alias("low"),
    )


@CATALOG.query(
    "last_activity",
    with_models("raw_eduqat_users")
    + """
    select id, coalesce(phone_number, email, name) as label,
           greatest(coalesce(last_loggin_at, timestamp '1970-01-01'), coalesce(pre_signup_at, timestamp '1970-01-01')) as last_activity_at
    from raw_eduqat_users
    """,
)
def last_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = derive.raw_text(spark, sf_dir, "eduqat_users")
    return accounts.select(
        "id",
        fn.first_non_null(F.col("phone_number"), F.col("email"), F.col("name")).alias("label"),
        fn.last_activity(F.col("last_loggin_at"), F.col("pre_signup_at")).alias("last_activity_at"),
    )


@CATALOG.query(
    "dates",
    """
    select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
           cast(extract(day from (l.l_shipdate - o.o_orderdate)) as integer) as days_to_ship,
           cast(week(l.l_shipdate) as integer) as iso_week, cast(isoyear(l.l_shipdate) as integer) as iso_year,
           l.l_shipdate + interval 7 day as week_later, date_trunc('day', l.l_shipdate) = l.l_shipdate as at_midnight
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey
    """,
)
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derive.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    shipped = F.col("l_shipdate")
    return derive.table(spark, sf_dir, "lineitem").join(orders, on="l_orderkey").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        fn.days_between(shipped, F.col("o_orderdate")).alias("days_to_ship"),
        fn.iso_week(shipped).alias("iso_week"),
        fn.iso_year(shipped).alias("iso_year"),
        (shipped + F.make_dt_interval(F.lit(7))).alias("week_later"),
        (F.date_trunc("day", shipped).cast("timestamp_ntz") == shipped).alias("at_midnight"),
    )


@CATALOG.query(
    "iso_week",
    """
    select event_type, cast(isoyear(ts) as integer) as iso_year, cast(week(ts) as integer) as iso_week,
           count(*) as events, count(distinct user_id) as users from events group by 1, 2, 3
    """,
)
def iso_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["event_type", fn.iso_year(F.col("ts")).alias("iso_year"), fn.iso_week(F.col("ts")).alias("iso_week")]
    measures = {"events": F.count("*"), "users": F.count_distinct("user_id")}
    return ops.aggregate(derive.table(spark, sf_dir, "events"), keys, measures)


@CATALOG.query(
    "days_between",
    with_models("stg_eduqat_enrollments")
    + """
    select enrollment_id, cast(extract(day from (enrollment_completed_at - enrollment_started_at)) as integer) as days
    from stg_eduqat_enrollments
    """,
)
def days_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Models(spark, sf_dir).enrollments()
    days = fn.days_between(F.col("enrollment_completed_at"), F.col("enrollment_started_at"))
    return e.select("enrollment_id", days.alias("days"))


@CATALOG.query(
    "text_casts",
    """
    select o_orderkey, o_orderdate as at, cast(o_totalprice as double) as price, cast(o_custkey as integer) as customer,
           o_orderkey % 2 = 0 as even, cast(null as integer) as not_a_number from orders
    """,
)
def text_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derive.table(spark, sf_dir, "orders")
    text = orders.select(
        "o_orderkey",
        F.concat(F.col("o_orderdate").cast("string"), F.lit("Z")).alias("at"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.col("o_custkey").cast("string").alias("customer"),
        (F.col("o_orderkey") % 2 == 0).cast("string").alias("even"),
        "o_orderpriority",
    )
    return text.select(
        "o_orderkey",
        F.col("at").cast("timestamp_ntz").alias("at"),
        F.col("price").cast("double").alias("price"),
        F.col("customer").cast("int").alias("customer"),
        F.col("even").cast("boolean").alias("even"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
    )


@CATALOG.query(
    "minutes_2dp",
    """
    select o_orderkey, cast(round(cast(cast(o_orderkey % 7200 as decimal(18, 6)) / 60 as decimal(18, 9)), 2) as double) as minutes
    from orders
    """,
)
def minutes_2dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derive.table(spark, sf_dir, "orders")
    return flat(orders.select("o_orderkey", fn.minutes_2dp(F.col("o_orderkey") % 7200).alias("minutes")))


@CATALOG.query(
    "json_text",
    """
    select event_id, json_extract_string(props, '$.k') as k_text, cast(json_extract_string(props, '$.k') as integer) as k,
           json_extract_string(props, '$.a.b') as missing from events
    """,
)
def json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derive.table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("v"))
    v = F.col("v")
    return events.select(
        "event_id",
        fn.json_text(v, "$.k").alias("k_text"),
        fn.json_as(v, "$.k", "int").alias("k"),
        fn.json_text(v, "$.a.b").alias("missing"),
    )


@CATALOG.query(
    "json_child",
    with_models("raw_eduqat_enrollments")
    + """
    select id, json_extract(metadata, '$.tracked_time')::varchar as tracked,
           cast(json_extract_string(metadata, '$.tracked_time.total') as double) as total,
           json_extract_string(metadata, '$.started_at') as started_at from raw_eduqat_enrollments
    """,
)
def json_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive.raw(spark, sf_dir, "eduqat_enrollments")
    meta = F.col("metadata")
    return flat(
        raw.select(
            "id",
            fn.json_child(meta, "$.tracked_time").alias("tracked"),
            fn.tracked_total(meta).alias("total"),
            fn.enrollment_start(meta).alias("started_at"),
        )
    )


@CATALOG.query(
    "enrollment_start",
    with_models("raw_eduqat_enrollments")
    + """
    select substr(json_extract_string(metadata, '$.started_at'), 1, 4) as start_year, count(*) as enrollments,
           sum(cast(json_extract_string(metadata, '$.tracked_time.total') as double)) as tracked_seconds
    from raw_eduqat_enrollments group by 1
    """,
)
def enrollment_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive.raw(spark, sf_dir, "eduqat_enrollments")
    meta = F.col("metadata")
    year = F.substring(fn.enrollment_start(meta), 1, 4).alias("start_year")
    measures = {"enrollments": F.count("*"), "tracked_seconds": F.sum(fn.tracked_total(meta))}
    return ops.aggregate(raw, [year], measures)


@CATALOG.query(
    "json_array_length",
    with_models("raw_eduqat_enrollments")
    + " select id, cast(json_array_length(certificates) as integer) as certificates from raw_eduqat_enrollments",
)
def json_array_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive.raw(spark, sf_dir, "eduqat_enrollments")
    return raw.select("id", fn.json_len(F.col("certificates")).alias("certificates"))


@CATALOG.query(
    "json_typeof",
    with_models("raw_eduqat_enrollments")
    + """
    select id, coalesce(json_type(completions, '$.materials') = 'OBJECT', false) as is_object,
           case when json_type(completions, '$.materials') = 'OBJECT'
                then cast(len(json_keys(completions, '$.materials')) as integer) end as members
    from raw_eduqat_enrollments
    """,
)
def json_typeof(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive.raw(spark, sf_dir, "eduqat_enrollments")
    materials = json_object(F.col("completions"), "$.materials")
    return raw.select(
        "id",
        fn.is_json_object(F.col("completions"), "$.materials").alias("is_object"),
        F.when(materials.isNotNull(), F.size(materials)).alias("members"),
    )


# without dimensions a metric query returns one row
@CATALOG.query(
    "metric_totals",
    with_models("mart_materials")
    + """
    select count(distinct material_id) as number_of_materials,
           count(distinct material_started_at) as number_of_materials_started,
           count(distinct material_completed_at) as number_of_materials_completed
    from mart_materials where material_is_required
    """,
)
def metric_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ["number_of_materials", "number_of_materials_started", "number_of_materials_completed"]
    mart = Models(spark, sf_dir).material_table()
    return plans.metric_query(mart, metrics, where=F.col("material_is_required"))
