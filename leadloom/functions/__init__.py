"""Column -> Column functions; everything here stays inside the JVM."""

from leadloom.functions.jsonv import (
    earliest_in_object,
    enrollment_start,
    is_json_object,
    json_as,
    json_child,
    json_len,
    json_pack,
    json_text,
    tracked_total,
)
from leadloom.functions.normalize import (
    BUSINESS_AGE,
    EMPLOYEE_COUNT,
    INCOME,
    blank_to_null,
    case_map,
    composite_key,
    flag_in_list,
    normalize_business_age,
    normalize_email,
    normalize_employee_count,
    normalize_income,
    normalize_phone,
)
from leadloom.functions.temporal import (
    days_between,
    first_non_null,
    iso_week,
    iso_year,
    last_activity,
    minutes_2dp,
)

__all__ = [
    "BUSINESS_AGE",
    "EMPLOYEE_COUNT",
    "INCOME",
    "blank_to_null",
    "case_map",
    "composite_key",
    "days_between",
    "earliest_in_object",
    "enrollment_start",
    "first_non_null",
    "flag_in_list",
    "is_json_object",
    "iso_week",
    "iso_year",
    "json_as",
    "json_child",
    "json_len",
    "json_pack",
    "json_text",
    "last_activity",
    "minutes_2dp",
    "normalize_business_age",
    "normalize_email",
    "normalize_employee_count",
    "normalize_income",
    "normalize_phone",
    "tracked_total",
]
