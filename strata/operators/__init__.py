"""Reusable relational operators of the pipeline."""

from strata.operators.dedup import latest_per_key, latest_per_key_agg, tiebreak_columns
from strata.operators.merge import (
    classify, merge, merged_table, merge_changes, update_where, src, tgt,
)
from strata.operators.changes import change_feed, has_changes
from strata.operators.flatten import unnest
from strata.operators import history

__all__ = ["latest_per_key", "latest_per_key_agg", "tiebreak_columns", "classify", "merge", "merged_table",
           "merge_changes", "update_where", "src", "tgt", "change_feed", "has_changes",
           "unnest", "history"]
