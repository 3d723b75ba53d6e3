"""Reusable DataFrame operators: anti joins, shares, rates, top-k, table checks,
uniqueness in two rounds, references by one grouping, fingerprints, watches."""

from remitlens.operators.checks import (
    column_checks,
    literal_checks,
    relationship_check,
    row_rule_checks,
    unique_check,
    unique_checks,
)
from remitlens.operators.fingerprint import fingerprint, same_values
from remitlens.operators.joins import anti_join
from remitlens.operators.metrics import grand_totals, scored_top_k, segment_rate, share_of_total, with_totals
from remitlens.operators.observed import Watch
from remitlens.operators.references import Relation, unmatched_by_relation, unmatched_counts, unmatched_keys
from remitlens.operators.uniqueness import repeated_values

__all__ = [
    "anti_join",
    "grand_totals", "scored_top_k", "segment_rate", "share_of_total", "with_totals",
    "column_checks", "literal_checks", "relationship_check", "row_rule_checks", "unique_check", "unique_checks",
    "fingerprint", "same_values", "repeated_values",
    "Relation", "unmatched_by_relation", "unmatched_counts", "unmatched_keys", "Watch",
]
