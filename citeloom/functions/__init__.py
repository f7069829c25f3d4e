"""Scalar column functions (all JVM-side built-in expressions, no UDFs)."""

from citeloom.functions.dates import (date_parts, iso_utc_text, parse_day_month_year,
                                      parse_publication_date, parse_sensor_timestamp,
                                      publication_date_rejected, publication_date_text)
from citeloom.functions.jsonish import flatten, from_json_text, to_json_text
from citeloom.functions.polymorphic import (authors_array, decode_list, issn_value, journal_flag,
                                            json_array_elements, last_item_not_object,
                                            last_quartil, quartile_candidates,
                                            quartile_items, quartils_kind)
from citeloom.functions.quartiles import normalize_quartile, python_float, quartile_from_score
from citeloom.functions.text import (contains_ci, extract_journal_name, journal_line,
                                     mentions_not_indexed, py_strip, remove_all, too_long)

__all__ = [
    "authors_array", "contains_ci", "decode_list", "date_parts", "extract_journal_name", "flatten",
    "from_json_text", "iso_utc_text", "issn_value", "journal_flag", "journal_line",
    "json_array_elements", "last_item_not_object", "last_quartil", "mentions_not_indexed",
    "normalize_quartile", "parse_day_month_year", "parse_publication_date",
    "parse_sensor_timestamp", "publication_date_rejected", "publication_date_text",
    "py_strip", "python_float", "quartile_candidates", "quartile_from_score",
    "quartile_items", "quartils_kind", "remove_all", "to_json_text", "too_long",
]
