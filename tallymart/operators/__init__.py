from .aggregates import (
    any_true,
    build_fact,
    count_by,
    dataset_overview,
    distinct_on,
    match_tally,
    min_max_across,
    non_missing_sums,
    rollup_measures,
    rows_and_distinct,
    sanity_counts,
    status_tally,
    sum_all_numeric,
    table_counts,
)
from .dims import attribute_dim, date_dim, entity_dim, first_last_non_null
from .joins import join_on, missing_keys
from .ordering import first_n, order
from .profile import (
    character_profile,
    exact_duplicates,
    guess_schema,
    guess_types,
    missing_profile,
    numeric_profile,
    profile_report,
    schema_presence,
    type_profile,
)
from .quality import (
    band_reconciliation,
    conflicting_attributes,
    duplicate_keys,
    foreign_key_check,
    grain_checks,
    grain_reconciliation,
    issue_count,
    published_total_check,
    qa_summary,
    range_check,
    reconciliation_summary,
    unique_key_check,
)
from .reporting import drilldown, latest_period, month_on_month, rank_within, region_compare, share_of_total
from .reshape import stack, stats_to_long, wide_to_long
from .rows import any_text_equals, drop_totals, text_equals, valid_key

__all__ = [
    "any_text_equals",
    "any_true",
    "attribute_dim",
    "band_reconciliation",
    "build_fact",
    "character_profile",
    "conflicting_attributes",
    "count_by",
    "dataset_overview",
    "date_dim",
    "distinct_on",
    "drilldown",
    "drop_totals",
    "duplicate_keys",
    "entity_dim",
    "exact_duplicates",
    "first_last_non_null",
    "first_n",
    "foreign_key_check",
    "grain_checks",
    "grain_reconciliation",
    "guess_schema",
    "guess_types",
    "issue_count",
    "join_on",
    "latest_period",
    "match_tally",
    "min_max_across",
    "missing_keys",
    "missing_profile",
    "month_on_month",
    "non_missing_sums",
    "numeric_profile",
    "order",
    "profile_report",
    "published_total_check",
    "qa_summary",
    "range_check",
    "rank_within",
    "reconciliation_summary",
    "region_compare",
    "rollup_measures",
    "rows_and_distinct",
    "sanity_counts",
    "schema_presence",
    "share_of_total",
    "stack",
    "stats_to_long",
    "status_tally",
    "sum_all_numeric",
    "table_counts",
    "text_equals",
    "type_profile",
    "unique_key_check",
    "valid_key",
    "wide_to_long",
]
