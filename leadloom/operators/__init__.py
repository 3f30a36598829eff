"""DataFrame -> DataFrame operators built from Catalyst-visible expressions."""

from leadloom.operators.aggregates import (
    aggregate,
    category_counts,
    count_where,
    distinct_days,
    reached_after,
    value_of_latest,
)
from leadloom.operators.attach import attach_rows
from leadloom.operators.dedup import dedup_latest
from leadloom.operators.islands import extract_faults, gaps, runs
from leadloom.operators.joins import Repeated, drill_across, full_outer_on, heavy_keys, left_join, left_join_fanout
from leadloom.operators.keys import add_surrogate_key, stable_surrogate_key
from leadloom.operators.latest import LatestRows
from leadloom.operators.projection import any_not_null, not_null, project
from leadloom.operators.quality import (
    column_type_mismatches,
    page_completeness,
    row_audit,
    split_rejects,
    violations_length,
    violations_null,
    violations_unique,
)
from leadloom.operators.setops import union_all, union_by_name
from leadloom.operators.unnest import unnest_array, unnest_object

__all__ = [
    "LatestRows",
    "Repeated",
    "add_surrogate_key",
    "aggregate",
    "any_not_null",
    "attach_rows",
    "category_counts",
    "column_type_mismatches",
    "count_where",
    "dedup_latest",
    "distinct_days",
    "drill_across",
    "extract_faults",
    "full_outer_on",
    "gaps",
    "heavy_keys",
    "left_join",
    "left_join_fanout",
    "not_null",
    "page_completeness",
    "project",
    "reached_after",
    "row_audit",
    "runs",
    "split_rejects",
    "stable_surrogate_key",
    "union_all",
    "union_by_name",
    "unnest_array",
    "unnest_object",
    "value_of_latest",
    "violations_length",
    "violations_null",
    "violations_unique",
]
