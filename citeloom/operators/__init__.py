"""Relational operators built from DataFrame primitives."""

from citeloom.operators.dedupe import drop_incomplete, drop_rows, keep_first, repeated_rows
from citeloom.operators.dimension import lookup_or_insert
from citeloom.operators.facts import bridge_rows, join_dimension, not_loaded, orphans, resolve_key
from citeloom.operators.keys import assign_keys
from citeloom.operators.upsert import merge_last_wins, merge_touched
from citeloom.operators.validate import (canonical_projection, first_reason, has_keys,
                                         required_non_null_reason, required_reason,
                                         required_reason_from_keys, split_quarantine)

__all__ = [
    "assign_keys", "bridge_rows", "canonical_projection", "drop_incomplete", "drop_rows",
    "first_reason", "has_keys", "join_dimension", "keep_first", "lookup_or_insert",
    "merge_last_wins", "merge_touched", "not_loaded", "orphans", "repeated_rows",
    "required_non_null_reason", "required_reason",
    "required_reason_from_keys", "resolve_key", "split_quarantine",
]
