"""The 20 models and the metric layer over the derived raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom import plans
from leadloom.bindings import derive
from leadloom.bindings.catalog import Catalog, flat
from leadloom.bindings.model_sql import model, with_models
from leadloom.build import load_ai_conversations
from leadloom.plans.marts import agg_enrollments, agg_purchases, latest_leads
from leadloom.schemas import LEAD_SHEETS
from leadloom.session import delete_folder, shared_path
from leadloom.sources import materialize

CATALOG = Catalog()


class Models:
    """Models over one data folder, built on demand from each other."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        # folders that only a model not yet written reads
        self.scratch: list[str] = []

    def _scratch(self, name: str) -> str:
        self.scratch.append(shared_path(self.spark, name))
        return self.scratch[-1]

    def raw(self, name: str) -> DataFrame:
        return derive.raw(self.spark, self.sf_dir, name)

    def lead(self, name: str) -> DataFrame:
        stage = getattr(plans, f"stg_{name}")
        return stage(derive.raw_leads(self.spark, self.sf_dir, name))

    def leads(self) -> DataFrame:
        return plans.int_all_marketing_leads(*[self.lead(name) for name in LEAD_SHEETS])

    def users(self) -> DataFrame:
        return plans.stg_users(self.raw("users"), derive.INTERNAL_MOBILES)

    def purchases(self) -> DataFrame:
        return plans.stg_purchase_form_data(self.raw("purchase_form_data"))

    def enrollments(self) -> DataFrame:
        return plans.stg_eduqat_enrollments(self.raw("eduqat_enrollments"))

    def materials(self) -> DataFrame:
        return plans.stg_enrollment_materials(self.raw("eduqat_enrollments"))

    def courses(self) -> DataFrame:
        return plans.stg_eduqat_courses(self.raw("eduqat_courses"))

    def accounts(self) -> DataFrame:
        return plans.stg_eduqat_users(self.raw("eduqat_users"))

    def chat(self) -> DataFrame:
        return plans.int_ai_chat_messages(
            plans.stg_ai_chat_messages(self.raw("ai_chat_messages")),
            plans.stg_ai_chat_sessions(self.raw("ai_chat_sessions")),
            self.users(),
        )

    def retention(self) -> DataFrame:
        return plans.int_user_retention(self.chat())

    def leads_table(self) -> DataFrame:
        """The stacked leads as a written table: the contact mart reads it more
        than once, and a lost executor does not bring the staging back."""
        return materialize(self.leads(), "int_all_marketing_leads", "table", self._scratch("models"))

    def contact(self, **options: bool) -> DataFrame:
        return plans.mart_contact(
            self.leads_table(),
            self.purchases(),
            self.accounts(),
            self.enrollments(),
            **options,
        )

    def _written(self, name: str, rows) -> DataFrame:
        return derive.land(self.spark, self.sf_dir, name, rows)

    def contact_table(self) -> DataFrame:
        """The contact mart as a written table; metrics read it as often as they like."""
        table = self._written("mart_contact", self.contact)
        while self.scratch:
            delete_folder(self.spark, self.scratch.pop())
        return table

    def enrollment_table(self) -> DataFrame:
        return self._written("mart_enrollment", self.enrollment)

    def material_table(self) -> DataFrame:
        return self._written("mart_materials", self.material)

    def retention_table(self) -> DataFrame:
        return self._written("int_user_retention", self.retention)

    def enrollment(self) -> DataFrame:
        return plans.mart_enrollment(self.enrollments(), self.courses(), self.purchases())

    def material(self) -> DataFrame:
        return plans.mart_materials_from_raw(self.raw("eduqat_enrollments"), self.courses())

    def material_joined(self) -> DataFrame:
        return plans.mart_materials(self.materials(), self.enrollments(), self.courses())

    def raw_conversations(self) -> DataFrame:
        return derive.land(self.spark, self.sf_dir, "eduqat_ai_conversations", lambda: self._talks()[0])

    def raw_messages(self) -> DataFrame:
        return derive.land(self.spark, self.sf_dir, "eduqat_ai_messages", lambda: self._talks()[1])

    def _talks(self) -> tuple[DataFrame, DataFrame]:
        """Conversations and messages as their endpoints give them, loaded.

        Besides the benchmark's conversations there is one, `all`, that holds a third
        of all events.
        """
        key = F.col("conv_id")
        turns = derive.table(self.spark, self.sf_dir, "conversations").select(
            F.concat(F.lit("c"), key.cast("string")).alias("conversation_id"),
            F.col("turn").cast("int").alias("position"),
            F.concat(F.lit("c"), key.cast("string")).alias("session_id"),
            F.when(F.col("role") == "user", "human").otherwise("ai").alias("sender"),
            F.col("text").alias("value"),
            F.lit("2024-02-01T09:00:00Z").alias("timestamp"),
        )
        # event ids are unique, so those of one conversation are positions in it
        events = derive.table(self.spark, self.sf_dir, "events").where("event_id % 3 = 0")
        hot = events.select(
            F.lit("all").alias("conversation_id"),
            F.floor(F.col("event_id") / 3).cast("int").alias("position"),
            F.lit("all").alias("session_id"),
            F.lit("human").alias("sender"),
            F.col("event_type").alias("value"),
            F.lit("2024-02-01T09:00:00Z").alias("timestamp"),
        )
        counts = derive.table(self.spark, self.sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
        fields = lambda i, n, name: [
            i.cast("int").alias("id"),
            name.alias("conversation_id"),
            F.concat(F.lit("u"), (i % 15).cast("string")).alias("user_id"),
            F.concat(F.lit("e"), i.cast("string")).alias("enrollment_id"),
            (i % 60).cast("int").alias("course_id"),
            (i % 9).cast("int").alias("material_id"),
            F.when(i % 2 == 0, "WAITING").otherwise("COMPLETED").alias("status"),
            n.cast("int").alias("score"),
            F.lit("").alias("content"),
            F.lit("site").alias("x_site_id"),
            F.lit("").alias("educator_id"),
            F.lit("2024-02-01 09:00:00").alias("created_at"),
        ]
        talks = counts.select(*fields(key, F.col("n"), F.concat(F.lit("c"), key.cast("string"))))
        whole = events.agg(F.count("*").alias("n")).select(*fields(F.lit(-1), F.col("n"), F.lit("all")))
        return load_ai_conversations(talks.unionByName(whole), turns.unionByName(hot), derive.BATCH_TS)


def land_raw_tables(spark: SparkSession, sf_dir: str, again: bool = False) -> int:
    """Land all raw tables now rather than at first use; returns their number."""
    if again:
        derive.forget_landed()
    m = Models(spark, sf_dir)
    tables = [m.raw(name) for name in derive.DERIVED if name != "leads"]
    tables += [derive.raw_leads(spark, sf_dir, name) for name in LEAD_SHEETS]
    return len([*tables, m.raw_conversations(), m.raw_messages()])


def _register(name: str, build) -> None:
    CATALOG.query(name, model(name))(lambda spark, sf_dir: flat(build(Models(spark, sf_dir))))


for _source in LEAD_SHEETS:
    _register(f"stg_{_source}", lambda m, s=_source: m.lead(s))
_register("stg_purchase_form_data", Models.purchases)
_register("stg_users", Models.users)
_register("stg_ai_chat_sessions", lambda m: plans.stg_ai_chat_sessions(m.raw("ai_chat_sessions")))
_register("stg_ai_chat_messages", lambda m: plans.stg_ai_chat_messages(m.raw("ai_chat_messages")))
_register("stg_eduqat_users", Models.accounts)
_register("stg_eduqat_courses", Models.courses)
_register("stg_eduqat_enrollments", Models.enrollments)
_register("stg_enrollment_materials", Models.materials)
_register(
    "stg_eduqat_survey_results",
    lambda m: plans.stg_eduqat_survey_results(m.raw("eduqat_survey_results")),
)
_register("int_all_marketing_leads", Models.leads)
_register("int_ai_chat_messages", Models.chat)
_register("int_user_retention", Models.retention)
_register("mart_contact", Models.contact)
_register("mart_enrollment", Models.enrollment)
_register("mart_materials", Models.material)
CATALOG.query("mart_materials_join", model("mart_materials"))(
    lambda spark, sf_dir: Models(spark, sf_dir).material_joined()
)
_register("agg_purchases", lambda m: agg_purchases(m.purchases()))
_register("agg_enrollments", lambda m: agg_enrollments(m.enrollments()))
CATALOG.query("dedup_cross_source", model("latest_leads"))(
    lambda spark, sf_dir: latest_leads(Models(spark, sf_dir).leads())
)


@CATALOG.query(
    "stg_eduqat_ai_conversations",
    """
    select cast(conv_id as integer) as submission_id, 'c' || conv_id as conversation_id,
           'u' || (conv_id % 15) as user_id, 'e' || conv_id as enrollment_id,
           cast(conv_id % 60 as integer) as course_id, cast(conv_id % 9 as integer) as material_id,
           case when conv_id % 2 = 0 then 'WAITING' else 'COMPLETED' end as conversation_status,
           cast(count(*) over (partition by conv_id) as integer) as score, '' as content,
           cast(null as varchar) as audio_url, 'site' as x_site_id, '' as educator_id,
           timestamp '2024-02-01 09:00:00' as conversation_created_at,
           cast(null as timestamp) as conversation_updated_at,
           'c' || conv_id as message_session_id,
           case when role = 'user' then 'human' else 'ai' end as message_sender,
           "text" as message_content, timestamp '2024-02-01 09:00:00' as message_timestamp,
           row_number() over (partition by conv_id order by turn) as message_order,
           'eduqat_ai_conversations' as data_source, timestamp '2024-06-10 00:00:00' as extracted_at
    from conversations
    union all
    select -1, 'all', 'u-1', 'e-1', -1, -1, 'COMPLETED', cast(count(*) over () as integer), '', null, 'site', '',
           timestamp '2024-02-01 09:00:00', null, 'all', 'human', event_type, timestamp '2024-02-01 09:00:00',
           row_number() over (order by event_id), 'eduqat_ai_conversations', timestamp '2024-06-10 00:00:00'
    from events where event_id % 3 = 0
    """,
)
def stg_eduqat_ai_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Models(spark, sf_dir)
    return plans.stg_eduqat_ai_conversations(m.raw_conversations(), m.raw_messages())


@CATALOG.query(
    "mart_contact_normalized_keys",
    with_models("latest_leads", "stg_purchase_form_data", "stg_eduqat_users", "stg_eduqat_enrollments")
    + """, p as (
        select lower(trim(email, ' ')) as email, count(*) as total_purchases
        from stg_purchase_form_data where email like '%@%.%' group by 1
    ), eu as (
        select lower(trim(email, ' ')) as email, user_id as eduqat_user_id
        from stg_eduqat_users where email like '%@%.%'
    ), ea as (
        select lower(trim(user_email, ' ')) as email, count(*) as enrolled_courses_count
        from stg_eduqat_enrollments where user_email like '%@%.%' group by 1
    )
    select coalesce(m.email, p.email, eu.email, ea.email) as email, m.phone_number, p.total_purchases,
           eu.eduqat_user_id, ea.enrolled_courses_count
    from latest_leads m full outer join p on m.email = p.email
    full outer join eu on coalesce(m.email, p.email) = eu.email
    full outer join ea on coalesce(m.email, p.email, eu.email) = ea.email
    where coalesce(m.email, p.email, eu.email, ea.email, m.phone_number) is not null
    """,
)
def mart_contact_normalized_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    contact = Models(spark, sf_dir).contact(normalize_keys=True)
    return contact.select(
        "email", "phone_number", "total_purchases", "eduqat_user_id", "enrolled_courses_count"
    )


# retention with thresholds that lie within the 30 days that the events span
@CATALOG.query(
    "int_user_retention_options",
    with_models("int_ai_chat_messages")
    + """
    select user_id, user_email, user_mobile, user_created_at, is_internal_user,
           min(message_created_at) as first_message_at, max(message_created_at) as last_message_at,
           count(*) as total_messages, count(distinct cast(message_created_at as date)) as active_days,
           cast(bool_or(message_created_at >= user_created_at + interval 1 day) as integer) as retained_1d,
           cast(bool_or(message_created_at >= user_created_at + interval 21 day) as integer) as retained_21d,
           cast(bool_or(message_created_at >= user_created_at + interval 29 day) as integer) as retained_29d
    from int_ai_chat_messages
    where user_id is not null and role in ('user') and not coalesce(is_internal_user, false)
    group by 1, 2, 3, 4, 5
    """,
)
def int_user_retention_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = Models(spark, sf_dir).chat()
    return plans.int_user_retention(chat, days=(1, 21, 29), exclude_internal=True, roles=["user"])


# --- metrics ----------------------------------------------------------------


@CATALOG.query(
    "metric_contacts_by_province",
    with_models("mart_contact")
    + """
    select provinsi_usaha, eduqat_role, count(distinct contact_key) as number_of_contacts,
           count(distinct email) as number_of_emails, count(distinct phone_number) as number_of_wa,
           count(distinct eduqat_user_id) as number_of_product_users
    from mart_contact group by 1, 2
    """,
)
def metric_contacts_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ["number_of_contacts", "number_of_emails", "number_of_wa", "number_of_product_users"]
    return plans.metric_query(Models(spark, sf_dir).contact_table(), metrics, ["provinsi_usaha", "eduqat_role"])


def _from_summary(
    spark: SparkSession, loads: list[DataFrame], metrics: list[str], dims: list[str]
) -> DataFrame:
    """Metrics by each dimension alone, from one summary of several loads."""
    dictionary, path = shared_path(spark, "codes"), shared_path(spark, "summary")
    for load in loads:
        plans.metric_summary(load, metrics, dims, dictionary).write.mode("append").parquet(path)
    summary = spark.read.parquet(path)
    parts = []
    for d in dims:
        rows = plans.metrics_from_summary(summary, metrics, [d])
        parts.append(rows.select(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"), *metrics))
    return parts[0].unionByName(parts[1])


@CATALOG.query(
    "metric_contacts_from_summary",
    with_models("mart_contact")
    + """
    select 'provinsi_usaha' as dimension, provinsi_usaha as value, count(distinct contact_key) as number_of_contacts,
           count(distinct email) as number_of_emails, count(distinct phone_number) as number_of_wa,
           count(distinct eduqat_user_id) as number_of_product_users
    from mart_contact group by provinsi_usaha
    union all
    select 'eduqat_role', eduqat_role, count(distinct contact_key), count(distinct email),
           count(distinct phone_number), count(distinct eduqat_user_id)
    from mart_contact group by eduqat_role
    """,
)
def metric_contacts_from_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load holds the first again, which distinct counts must not notice."""
    metrics = ["number_of_contacts", "number_of_emails", "number_of_wa", "number_of_product_users"]
    mart = Models(spark, sf_dir).contact_table()
    loads = [mart.where("phone_number is not null"), mart]
    return _from_summary(spark, loads, metrics, ["provinsi_usaha", "eduqat_role"])


@CATALOG.query(
    "metric_enrollments_from_summary",
    with_models("mart_enrollment")
    + """
    select 'course_type' as dimension, course_type as value,
           count(distinct enrollment_id) as number_of_enrollments,
           count(distinct enrollment_started_at) as number_of_enrollments_started,
           count(distinct enrollment_completed_at) as number_of_enrollments_completed,
           avg(days_to_complete) as avg_days_to_complete,
           cast(sum(round(cast(cast(learning_time_seconds as decimal(18, 6)) / 60 as decimal(18, 9)), 2))
                as double) as total_learning_time_min
    from mart_enrollment group by course_type
    union all
    select 'started_at_marketing_year', cast(started_at_marketing_year as varchar), count(distinct enrollment_id),
           count(distinct enrollment_started_at), count(distinct enrollment_completed_at), avg(days_to_complete),
           cast(sum(round(cast(cast(learning_time_seconds as decimal(18, 6)) / 60 as decimal(18, 9)), 2)) as double)
    from mart_enrollment group by started_at_marketing_year
    """,
)
def metric_enrollments_from_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [
        "number_of_enrollments",
        "number_of_enrollments_started",
        "number_of_enrollments_completed",
        "avg_days_to_complete",
        "total_learning_time_min",
    ]
    mart = Models(spark, sf_dir).enrollment_table()
    manual = F.col("enrollment_type").eqNullSafe("manual")
    return flat(_from_summary(spark, [mart.where(manual), mart.where(~manual)], metrics, ["course_type", "started_at_marketing_year"]))


@CATALOG.query(
    "metric_enrollments_by_course_type",
    with_models("mart_enrollment")
    + """
    select course_type, started_at_marketing_year,
           count(distinct enrollment_id) as number_of_enrollments,
           count(distinct enrollment_started_at) as number_of_enrollments_started,
           count(distinct enrollment_completed_at) as number_of_enrollments_completed,
           avg(days_to_complete) as avg_days_to_complete,
           cast(sum(round(cast(cast(learning_time_seconds as decimal(18, 6)) / 60 as decimal(18, 9)), 2))
                as double) as total_learning_time_min
    from mart_enrollment where enrollment_type = 'manual' group by 1, 2
    """,
)
def metric_enrollments_by_course_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [
        "number_of_enrollments",
        "number_of_enrollments_started",
        "number_of_enrollments_completed",
        "avg_days_to_complete",
        "total_learning_time_min",
    ]
    dims = ["course_type", "started_at_marketing_year"]
    mart = Models(spark, sf_dir).enrollment_table()
    return flat(plans.metric_query(mart, metrics, dims, where=F.col("enrollment_type") == "manual"))


@CATALOG.query(
    "metric_materials_by_type",
    with_models("mart_materials")
    + """
    select material_type, course_name, count(distinct material_id) as number_of_materials,
           count(distinct material_started_at) as number_of_materials_started,
           count(distinct material_completed_at) as number_of_materials_completed,
           cast(sum(round(cast(cast(material_tracked_time_seconds as decimal(18, 6)) / 60
                    as decimal(18, 9)), 2)) as double) as total_material_time_min
    from mart_materials group by 1, 2
    """,
)
def metric_materials_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [
        "number_of_materials",
        "number_of_materials_started",
        "number_of_materials_completed",
        "total_material_time_min",
    ]
    mart = Models(spark, sf_dir).material_table()
    return flat(plans.metric_query(mart, metrics, ["material_type", "course_name"]))


@CATALOG.query(
    "metric_retention",
    with_models("int_user_retention")
    + """
    select is_internal_user, cast(sum(retained_7d) as bigint) as retained_7d_count,
           cast(sum(retained_14d) as bigint) as retained_14d_count,
           cast(sum(retained_30d) as bigint) as retained_30d_count,
           cast(sum(retained_60d) as bigint) as retained_60d_count,
           cast(sum(retained_90d) as bigint) as retained_90d_count
    from int_user_retention group by 1
    """,
)
def metric_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [f"retained_{n}d_count" for n in (7, 14, 30, 60, 90)]
    return plans.metric_query(Models(spark, sf_dir).retention_table(), metrics, ["is_internal_user"])
