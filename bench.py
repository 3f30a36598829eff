"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the cores. Each query is run once to warm up and then timed; metrics read the
marts that the warm-up has written; all result
columns are computed, none is collected. The queries share the landed raw tables;
landing them, which derives them from the benchmark tables, is timed by itself as
``land_raw_tables``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from leadloom.bindings import CATALOG
from leadloom.bindings.models import land_raw_tables
from leadloom.session import local_session, release_shared

HEADLINE = [
    "int_user_retention",
    "mart_contact",
    "mart_enrollment",
    "mart_materials",
    "int_all_marketing_leads",
    "int_ai_chat_messages",
    "dedup_cross_source",
    "dedup_latest",
    "join_left_chain",
    "join_left_dim",
    "join_full_outer_chain",
    "lateral_unnest_ordinality",
    "lateral_unnest_object",
    "stg_eduqat_enrollments",
    "stg_enrollment_materials",
    "stg_eduqat_ai_conversations",
    "agg_purchases",
    "agg_enrollments",
    "agg_distinct_days",
    "dates",
    "drill_across",
    "metric_contacts_by_province",
    "metric_enrollments_by_course_type",
    "survey_load",
    "scan_api_pages",
    "scan_sheet",
    "surrogate_key",
    "assert_unique",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    CATALOG.queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    land_raw_tables(spark, sf_dir)
    start = time.perf_counter()
    land_raw_tables(spark, sf_dir, again=True)
    seconds = {"land_raw_tables": round(time.perf_counter() - start, 3)}
    for name in names:
        run(spark, name, sf_dir)
    for name in names:
        seconds[name] = round(run(spark, name, sf_dir), 3)
    release_shared(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline query wall time, sum",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
