"""String functions with Python's text semantics, as JVM-side expressions.

Python's ``str.strip()`` and regex ``\\s`` treat every Unicode blank as
whitespace; Java's ``\\s`` and Spark's ``trim`` do not. ``PY_SPACE`` spells the
Python set out as a Java character class so the expressions below agree with
Python on non-breaking spaces, separators and the like.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.constants import (JOURNAL_LINE_PREFIX, NOT_INDEXED_MARKER)

# Characters for which Python's str.isspace() is true (Java regex syntax).
PY_SPACE = r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"

# What follows the prefix, up to a parenthesis or the end of the line.
_JOURNAL_RULE_JAVA = r"Published in:" + PY_SPACE + r"*([^(\n]+)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove leading and trailing Python whitespace."""
    return F.regexp_replace(_col(c), rf"^{PY_SPACE}+|{PY_SPACE}+$", "")


def remove_all(c, text: str) -> Column:
    """``str.replace(text, "")``: drop every occurrence of ``text``."""
    return F.replace(_col(c), F.lit(text), F.lit(""))


def journal_line(title) -> Column:
    """The journal line built from a title: prefix + title (concatenation)."""
    return F.concat(F.lit(JOURNAL_LINE_PREFIX), _col(title))


def extract_journal_name(line) -> Column:
    """First capture of the journal rule, stripped; NULL when it does not match."""
    c = _col(line)
    return F.when(c.rlike(_JOURNAL_RULE_JAVA),
                  py_strip(F.regexp_extract(c, _JOURNAL_RULE_JAVA, 1)))


def contains_ci(c, needle: str) -> Column:
    """Case-insensitive substring test (``needle in s.lower()``)."""
    return F.lower(_col(c)).contains(needle.lower())


def mentions_not_indexed(c) -> Column:
    return contains_ci(c, NOT_INDEXED_MARKER)


def too_long(c, limit: int) -> Column:
    """True when a string exceeds ``limit`` characters (code points)."""
    return F.length(_col(c)) > F.lit(limit)
