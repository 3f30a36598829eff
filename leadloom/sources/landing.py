"""Steps between an extract and its raw table."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.jsonv import json_pack, json_text
from leadloom.operators.unnest import unnest_object


def stamp(df: DataFrame, data_source: str, batch_ts: str, as_text: bool = False) -> DataFrame:
    """Provenance: the source name and one UTC timestamp for the whole batch.

    The timestamp is a constant of the batch, not the time a query runs. The
    lead sheets keep it as text.
    """
    extracted = F.lit(batch_ts).cast("string" if as_text else "timestamp_ntz")
    return df.withColumns({"data_source": F.lit(data_source), "extracted_at": extracted})


def cast_type(declared: str) -> str:
    return "string" if declared.startswith("varchar") else declared


def _as_variant(c: Column, actual: str, strict: bool) -> Column:
    if actual == "variant":
        return c
    if actual == "string":
        return F.parse_json(c) if strict else F.try_parse_json(c)
    if actual.startswith(("array", "map", "struct")):
        return F.to_variant_object(c)
    return c.cast("variant")


def _fitting(c: Column, name: str, declared: str) -> Column:
    if not declared.startswith("varchar"):
        return c
    limit = int(declared.removeprefix("varchar(").rstrip(")"))
    error = F.raise_error(F.lit(f"value too long for {name} {declared}")).cast("string")
    return F.when(F.char_length(c) > limit, error).otherwise(c)


def typed_load(
    df: DataFrame, schema: Mapping[str, str], strict: bool = True, keep_empty: Collection[str] = ()
) -> DataFrame:
    """Cast an extract to the declared columns; a column it lacks reads NULL.

    A value that does not fit raises, as does a text longer than its VARCHAR(n);
    when not strict the value reads NULL and the text stays, for
    ``violations_length`` to find. An offset in a timestamp text is dropped, not
    applied. JSON text and nested values become VARIANT, and NULL if they are
    empty, but for the columns in ``keep_empty``.
    """
    actual = dict(df.dtypes)

    def column(name: str, declared: str) -> Column:
        if name not in actual:
            return F.lit(None).cast(cast_type(declared))
        c = F.col(name)
        if declared == "variant":
            return json_pack(_as_variant(c, actual[name], strict), name not in keep_empty)
        if not strict:
            return c.try_cast(cast_type(declared))
        return _fitting(c.cast(cast_type(declared)), name, declared)

    return df.select(*[column(n, t).alias(n) for n, t in schema.items()])


def retype(df: DataFrame, column: str, expr: Column | None = None) -> DataFrame:
    """Change a column's type in place; by default scalar -> JSON through text."""
    return df.withColumn(column, F.parse_json(F.col(column).cast("string")) if expr is None else expr)


def parse_items(df: DataFrame, text: str, into: str = "item") -> tuple[DataFrame, DataFrame]:
    """Landed JSON items as VARIANT, and the rejects that are no valid JSON.

    A missing item (NULL text) counts as rejected too.
    """
    parsed = df.withColumn(into, F.try_parse_json(F.col(text)))
    bad = F.col(into).isNull()
    return parsed.where(~bad).drop(text), parsed.where(bad).drop(into)


def json_text_column(df: DataFrame, *names: str) -> DataFrame:
    """VARIANT columns as JSON text, for sinks without a VARIANT type."""
    return df.withColumns({n: F.to_json(F.col(n)) for n in names})


def survey_worklist(enrollments: DataFrame) -> DataFrame:
    """Completed surveys found among the materials of each enrollment."""
    base = enrollments.select(
        F.col("id").alias("enrollment_id"), "course_id", "user_id", "completions"
    )
    value = F.col("value")
    members = unnest_object(
        base,
        F.col("completions"),
        {
            "survey_id": json_text(value, "$.survey_id"),
            "completed_at": json_text(value, "$.completed_at"),
            "__type": json_text(value, "$.type"),
            "__survey_type": json_text(value, "$.survey_type"),
        },
        key="material_id",
        path="$.materials",
    )
    done = (
        (F.col("__type") == "survey")
        & (F.col("__survey_type") == "survey")
        & F.col("completed_at").isNotNull()
    )
    return members.where(done).select(
        "enrollment_id", "material_id", "survey_id", "completed_at", "course_id", "user_id"
    )


def survey_load(worklist: DataFrame, results: DataFrame, data_source: str, batch_ts: str) -> DataFrame:
    """Raw survey table: work list joined with the landed results.

    ``results`` has enrollment_id, material_id and the VARIANT document
    ``survey_data``. Work items without a result are skipped. An empty survey id
    falls back to the id in the result.
    """
    data = F.col("survey_data")
    joined = worklist.join(results, on=["enrollment_id", "material_id"], how="inner")
    loaded = joined.select(
        "enrollment_id",
        "material_id",
        F.coalesce(F.nullif(F.col("survey_id"), F.lit("")), json_text(data, "$.id")).alias("survey_id"),
        "course_id",
        "user_id",
        json_text(data, "$.type").alias("survey_type"),
        json_text(data, "$.title").alias("survey_title"),
        json_pack(F.try_variant_get(data, F.lit("$.elements"), "variant")).alias("elements"),
        F.col("completed_at").cast("timestamp_ntz").alias("completed_at"),
    )
    return stamp(loaded, data_source, batch_ts)
