"""Readers, load steps and writers."""

from leadloom.commits import ConcurrentRefresh, Version, commit, vacuum, versions
from leadloom.sources.api_pages import explode_pages, page_stats, parse_pages, read_api_pages, read_pages
from leadloom.sources.landing import (
    json_text_column,
    parse_items,
    retype,
    stamp,
    survey_load,
    survey_worklist,
    typed_load,
)
from leadloom.sources.sheets import (
    HEADER_SYNONYMS,
    normalize_headers,
    read_all_sheets,
    read_sheet,
    rename_synonyms,
    sheet_paths,
    write_sheet,
)
from leadloom.sources.tables import current_path, full_refresh, materialize, read_source, read_tables

__all__ = [
    "ConcurrentRefresh",
    "HEADER_SYNONYMS",
    "Version",
    "commit",
    "explode_pages",
    "current_path",
    "full_refresh",
    "json_text_column",
    "materialize",
    "normalize_headers",
    "page_stats",
    "parse_items",
    "parse_pages",
    "read_all_sheets",
    "read_api_pages",
    "read_pages",
    "read_sheet",
    "read_source",
    "read_tables",
    "rename_synonyms",
    "retype",
    "sheet_paths",
    "stamp",
    "survey_load",
    "survey_worklist",
    "typed_load",
    "vacuum",
    "versions",
    "write_sheet",
]
