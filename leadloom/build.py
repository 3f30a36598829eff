"""From landed extracts to raw tables, and from raw tables to all models."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from leadloom import plans
from leadloom.commits import Version, commit
from leadloom.operators.keys import add_surrogate_key, stable_surrogate_key
from leadloom.operators.quality import violations_unique
from leadloom.operators.setops import union_all
from leadloom.schemas import ITEM_NAMES, KEEP_EMPTY, LEAD_ADDED, RAW, UNIQUE_KEYS, length_limits
from leadloom.sources.landing import stamp, typed_load
from leadloom.sources.sheets import MAX_NAME_BYTES, read_all_sheets, rename_synonyms
from leadloom.sources.tables import materialize


def load_lead_sheets(
    spark: SparkSession,
    paths: Mapping[str, str],
    data_source: str,
    batch_ts: str,
    header_row: int = 0,
    exclude: Collection[str] = (),
    multi_line: bool = True,
    key_dictionary: str | None = None,
) -> DataFrame:
    """Raw table of one lead workbook: sheet name -> CSV export.

    Synonyms are renamed once, after all sheets are stacked, and names are cut to
    the length limit after that. The provenance columns stay text, and an ``id``
    of the sheets becomes ``source_id``. The new ``id`` is fixed once the table is
    written, so write it before building on it; with a folder ``key_dictionary`` a row
    that the sheets still hold has the ``id`` of the load before.
    """
    rows = rename_synonyms(read_all_sheets(spark, paths, header_row, exclude, multi_line))
    rows = rows.toDF(*[c[:MAX_NAME_BYTES] for c in rows.columns])
    stamped = stamp(rows, data_source, batch_ts, as_text=True)
    if key_dictionary is None:
        rows = add_surrogate_key(stamped)
    else:
        rows = stable_surrogate_key(stamped, rows.columns, key_dictionary)
    return rows.withColumn("loaded_at", F.lit(batch_ts).cast(LEAD_ADDED["loaded_at"]))


def load_source_table(extract: DataFrame, table: str, batch_ts: str, strict: bool = True) -> DataFrame:
    """Raw table of a source database table."""
    rows = stamp(rename_synonyms(extract), table, batch_ts)
    return typed_load(rows, RAW[table], strict, KEEP_EMPTY.get(table, ()))


def load_api_items(items: DataFrame, table: str, batch_ts: str, strict: bool = True) -> DataFrame:
    """Raw table of an endpoint's items; nested values become VARIANT."""
    return typed_load(stamp(items, table, batch_ts), RAW[table], strict)


def load_ai_conversations(
    conversations: DataFrame, messages: DataFrame, batch_ts: str, strict: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Raw conversations, and their messages as a raw table of its own.

    ``messages`` has conversation_id, an integer ``position`` from 0 within the
    conversation, and the message fields. A message is a row, so a conversation
    may have any number of them; ``stg_eduqat_ai_conversations`` joins the two.
    """
    talks, said = "eduqat_ai_conversations", "eduqat_ai_messages"
    renames = {item: column for column, item in ITEM_NAMES[talks].items()}
    rows = stamp(conversations.withColumnsRenamed(renames), talks, batch_ts)
    return (
        typed_load(rows, RAW[talks], strict),
        typed_load(stamp(messages, said, batch_ts), RAW[said], strict),
    )


def contract(table: str) -> tuple[dict[str, Column], list[list[str]]]:
    """Rules of a raw table: name -> condition of a violating row, and the keys that are unique."""
    too_long = [F.coalesce(F.char_length(F.col(c)) > n, F.lit(False)) for c, n in length_limits(table).items()]
    keys = UNIQUE_KEYS.get(table, [])
    rules = {"length": reduce(lambda a, b: a | b, too_long, F.lit(False))}
    for key in keys:
        rules[f"not null {', '.join(key)}"] = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return rules, keys


def raw_violations(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Declared keys and lengths of raw tables: one row per table and rule. A table is read once
    for all rules that look at a row, and once, key columns only, for each unique key."""
    found = []
    for table, df in raw.items():
        rules, keys = contract(table)
        counts = F.array(*[F.struct(F.lit(r).alias("rule"), F.count_if(c).alias("violations")) for r, c in rules.items()])
        parts = [df.agg(counts.alias("c")).select(F.explode("c").alias("c")).select("c.*")]
        for key in keys:
            twice = violations_unique(df, key).agg(F.count("*").alias("violations"))
            parts.append(twice.select(F.lit(f"unique {', '.join(key)}").alias("rule"), "violations"))
        found += [p.select(F.lit(table).alias("table_name"), "rule", "violations") for p in parts]
    return union_all(*found)


class ContractViolation(ValueError):
    """Rows that were to be landed break rules of their table."""


def land_raw(
    df: DataFrame, table: str, path: str, refuse: bool = False, expected: int | None = None
) -> tuple[Version | None, dict[str, int]]:
    """Refresh a raw table and check its contract in the same write.

    Rules that look at a row are counted while the rows are written; unique keys are checked on
    the key columns of the written files, so the extract itself runs once. Returns the version and
    the violations per rule. With ``refuse`` rows that break a rule become no version, and
    ContractViolation names the rules.
    """
    rules, keys = contract(table)
    seen = Observation()
    counts = [F.count_if(c).alias(f"r{i}") for i, c in enumerate(rules.values())]
    violations: dict[str, int] = {}

    def accept(rows: int, written: DataFrame) -> bool:
        observed = seen.get
        violations.update({r: observed[f"r{i}"] for i, r in enumerate(rules)})
        violations.update({f"unique {', '.join(k)}": violations_unique(written, k).count() for k in keys})
        return not (refuse and any(violations.values()))

    version = commit(df.observe(seen, *counts), path, accept, expected)
    if version is None:
        raise ContractViolation(f"{table}: " + ", ".join(f"{n} rows or keys break {r}" for r, n in violations.items() if n))
    return version, violations


def build_models(
    raw: Mapping[str, DataFrame],
    base: str | None = None,
    internal_mobiles: Collection[str] = (),
    strict: bool = True,
) -> dict[str, DataFrame]:
    """All 20 models from the raw tables.

    Staging models stay views. With ``base`` the intermediate models and the
    marts are written below it and read back, so that each is computed once;
    without it everything stays lazy. Every model is also a temporary view of its
    name, for use from SQL.
    """

    def table(name: str, df: DataFrame) -> DataFrame:
        return df if base is None else materialize(df, name, "table", base)

    m: dict[str, DataFrame] = {}
    for source in (
        "leads_ads_community",
        "website_form_responses",
        "leads_course_strategi_ads",
        "branding_level_up",
        "ai_chat_messages",
        "ai_chat_sessions",
        "eduqat_users",
        "eduqat_courses",
        "eduqat_survey_results",
    ):
        m[f"stg_{source}"] = getattr(plans, f"stg_{source}")(raw[source])
    m["stg_purchase_form_data"] = plans.stg_purchase_form_data(raw["purchase_form_data"], strict)
    m["stg_users"] = plans.stg_users(raw["users"], internal_mobiles)
    m["stg_eduqat_enrollments"] = plans.stg_eduqat_enrollments(raw["eduqat_enrollments"], strict)
    m["stg_enrollment_materials"] = plans.stg_enrollment_materials(raw["eduqat_enrollments"], strict)
    m["stg_eduqat_ai_conversations"] = plans.stg_eduqat_ai_conversations(
        raw["eduqat_ai_conversations"], raw["eduqat_ai_messages"]
    )

    m["int_all_marketing_leads"] = table(
        "int_all_marketing_leads",
        plans.int_all_marketing_leads(
            m["stg_leads_ads_community"],
            m["stg_website_form_responses"],
            m["stg_leads_course_strategi_ads"],
            m["stg_branding_level_up"],
        ),
    )
    m["int_ai_chat_messages"] = table(
        "int_ai_chat_messages",
        plans.int_ai_chat_messages(
            m["stg_ai_chat_messages"], m["stg_ai_chat_sessions"], m["stg_users"]
        ),
    )
    m["int_user_retention"] = table(
        "int_user_retention", plans.int_user_retention(m["int_ai_chat_messages"])
    )

    m["mart_contact"] = table(
        "mart_contact",
        plans.mart_contact(
            m["int_all_marketing_leads"],
            m["stg_purchase_form_data"],
            m["stg_eduqat_users"],
            m["stg_eduqat_enrollments"],
        ),
    )
    m["mart_enrollment"] = table(
        "mart_enrollment",
        plans.mart_enrollment(
            m["stg_eduqat_enrollments"], m["stg_eduqat_courses"], m["stg_purchase_form_data"]
        ),
    )
    m["mart_materials"] = table(
        "mart_materials",
        plans.mart_materials_from_raw(raw["eduqat_enrollments"], m["stg_eduqat_courses"], strict),
    )
    for name, df in m.items():
        df.createOrReplaceTempView(name)
    return m
