"""Reading semi-structured VARIANT columns.

A missing path, a JSON null and a NULL document all read as NULL. Text is taken
first and cast afterwards, so a malformed value raises under ANSI casts (strict)
or reads as NULL (``strict=False``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def json_text(v: Column, path: str) -> Column:
    """Scalar as text, object or array as JSON text."""
    return F.try_variant_get(v, F.lit(path), "string")


def json_as(v: Column, path: str, dtype: str, strict: bool = True) -> Column:
    text = json_text(v, path)
    return text.cast(dtype) if strict else text.try_cast(dtype)


def json_child(v: Column, path: str) -> Column:
    """Nested value, still VARIANT."""
    return F.try_variant_get(v, F.lit(path), "variant")


def json_object(v: Column, path: str = "$") -> Column:
    """Object as ``map<string,variant>``; NULL for anything that is no object."""
    return F.try_variant_get(v, F.lit(path), "map<string,variant>")


def json_array(v: Column, path: str = "$") -> Column:
    """Array as ``array<variant>``; NULL for anything that is no array."""
    return F.try_variant_get(v, F.lit(path), "array<variant>")


def is_json_object(v: Column, path: str = "$") -> Column:
    return json_object(v, path).isNotNull()


def json_len(v: Column, path: str = "$") -> Column:
    """Number of array elements; NULL for NULL, so "no list" is not zero."""
    return F.array_size(json_array(v, path))


def json_pack(v: Column, falsy_to_null: bool = True) -> Column:
    """VARIANT as landed: empty or false values are stored as NULL."""
    if not falsy_to_null:
        return v
    kind = F.schema_of_variant(v)
    number = F.try_variant_get(v, F.lit("$"), "double")
    falsy = (
        kind.isin("VOID", "OBJECT<>", "ARRAY<VOID>")
        & F.coalesce(F.array_size(json_array(v)) == 0, F.lit(True))
        | (kind == "BOOLEAN") & ~F.try_variant_get(v, F.lit("$"), "boolean")
        | (kind == "STRING") & (F.try_variant_get(v, F.lit("$"), "string") == "")
        | (kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")) & (number == 0)
    )
    return F.when(~F.coalesce(falsy, F.lit(False)), v)


def earliest_in_object(v: Column, path: str, field: str) -> Column:
    """Smallest non-empty text of ``field`` over all members of an object."""
    members = F.map_values(json_object(v, path))
    texts = F.transform(members, lambda m: F.nullif(json_text(m, f"$.{field}"), F.lit("")))
    return F.array_min(texts)


def enrollment_start(metadata: Column) -> Column:
    return json_text(metadata, "$.started_at")


def tracked_total(metadata: Column) -> Column:
    return json_as(metadata, "$.tracked_time.total", "double")
