"""Text normalisation of contact fields and survey categories."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw survey answer -> canonical label. An answer that is not
# listed passes through unchanged; an answer mapped to None becomes NULL.
BUSINESS_AGE: dict[str, str | None] = {
    "dibawah_1_tahun": "dibawah 1 tahun",
    "< 1 tahun": "dibawah 1 tahun",
    "1-2_tahun": "1-2 tahun",
    "1 - 2 tahun": "1-2 tahun",
    "3-5_tahun": "3-5 tahun",
    "3 - 5 tahun": "3-5 tahun",
    "6-10_tahun": "5-10 tahun",
    "diatas_10_tahun": "5-10 tahun",
    "5 - 10 tahun": "5-10 tahun",
    "diatas_20_tahun": "diatas 10 tahun",
    "> 10 tahun": "diatas 10 tahun",
}
INCOME: dict[str, str | None] = {
    "Dibawah 10 juta": "dibawah 10 juta",
    "dibawah_10_juta": "dibawah 10 juta",
    "10 - 30 juta": "10-50 juta",
    "10_-_50_juta": "10-50 juta",
    "31 - 50 juta": "10-50 juta",
    "10 - 50 juta": "10-50 juta",
    "50_-_100_juta": "50-100 juta",
    "51 - 70 juta": "50-100 juta",
    "71 - 100 juta": "50-100 juta",
    "Diatas 100 juta": "diatas 100 juta",
    "100_-_200_juta": "diatas 100 juta",
    "diatas_200_juta": "diatas 100 juta",
}
EMPLOYEE_COUNT: dict[str, str | None] = {
    "0": "0 karyawan",
    "1 - 5 orang": "1-5 karyawan",
    "1-3_karyawan": "1-5 karyawan",
    "3-5_karyawan": "1-5 karyawan",
    "1-3 Karyawan": "1-5 karyawan",
    "3-5 Karyawan": "1-5 karyawan",
    "6 - 10 orang": "6-10 karyawan",
    "5-10_karyawan": "6-10 karyawan",
    "5-10 Karyawan": "6-10 karyawan",
    "11 - 20 orang": "11-20 karyawan",
    "21 - 50 orang": "21-50 karyawan",
    "> 50 orang": "50+ karyawan",
    "lebih_dari_10": None,
}


def case_map(c: Column, values: Mapping[str, str | None]) -> Column:
    """Replace listed values by their label; anything else passes through.

    One ``IN`` test per label keeps the expression short, and a value mapped to
    None really yields NULL (``coalesce(map[x], x)`` would give ``x`` back).
    """
    by_label: dict[str | None, list[str]] = {}
    for variant, label in values.items():
        by_label.setdefault(label, []).append(variant)
    out: Column | None = None
    for label, variants in by_label.items():
        hit, then = c.isin(variants), F.lit(label).cast("string")
        out = F.when(hit, then) if out is None else out.when(hit, then)
    return c if out is None else out.otherwise(c)


def normalize_business_age(c: Column) -> Column:
    return case_map(c, BUSINESS_AGE)


def normalize_income(c: Column) -> Column:
    return case_map(c, INCOME)


def normalize_employee_count(c: Column) -> Column:
    return case_map(c, EMPLOYEE_COUNT)


def normalize_email(c: Column) -> Column:
    """Lower-cased, trimmed address; NULL unless it looks like ``x@y.z``."""
    return F.when(c.like("%@%.%"), F.lower(F.trim(c)))


def normalize_phone(c: Column) -> Column:
    """``+62`` followed by at least nine digits, else NULL.

    One leading country code ``62``, or else one leading ``0``, is dropped. The
    possessive prefix (``?+``) forbids the regex to give the prefix back when
    too few digits remain, so no CASE over repeated sub-expressions is needed.
    """
    digits = F.regexp_replace(c, "[^0-9]", "")
    subscriber = F.regexp_extract(digits, "^(?:62|0)?+([0-9]{9,})$", 1)
    return F.nullif(F.concat(F.lit("+62"), subscriber), F.lit("+62"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def composite_key(*cols: Column) -> Column:
    """``a|b|...`` with NULL written as the empty string; never NULL."""
    return F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in cols])


def flag_in_list(c: Column, values: Iterable[str]) -> Column:
    """Three-valued membership: NULL stays NULL, also for an empty list."""
    listed = list(values)
    if not listed:
        return F.when(c.isNotNull(), F.lit(False))
    return c.isin(listed)
