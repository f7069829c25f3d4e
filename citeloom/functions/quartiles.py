"""CiteScore -> quartile label, and normalisation of quartile values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.constants import CITESCORE_BANDS, LOWEST_BAND
from citeloom.functions.text import PY_SPACE

_DIGITS = r"[0-9](?:_?[0-9])*"
# Text Python's float() accepts: blanks, sign, digits with single underscores,
# optional fraction and exponent, or inf / infinity / nan in any case.
PY_FLOAT = (r"(?i)^" + PY_SPACE + r"*[+-]?(?:(?:" + _DIGITS + r"(?:\." + r"(?:" + _DIGITS
            + r")?)?|\." + _DIGITS + r")(?:e[+-]?" + _DIGITS + r")?|inf(?:inity)?|nan)"
            + PY_SPACE + r"*$")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quartile_from_score(score) -> Column:
    """>= 4 Q1, >= 2 Q2, >= 1 Q3, otherwise Q4. NaN is Q4 (every comparison
    with NaN is false in Python; Spark orders NaN above all numbers, so it is
    tested first). NULL stays NULL."""
    x = _col(score).cast("double")
    expr = F.when(x.isNull(), F.lit(None).cast("string")).when(F.isnan(x), F.lit(LOWEST_BAND))
    for bound, label in CITESCORE_BANDS:
        expr = expr.when(x >= F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(LOWEST_BAND))


def python_float(text) -> Column:
    """``float(text)`` for text Python accepts, NULL otherwise ('4d' is not a number)."""
    t = _col(text)
    cleaned = F.regexp_replace(F.regexp_replace(t, rf"^{PY_SPACE}+|{PY_SPACE}+$", ""), "_", "")
    return F.when(t.rlike(PY_FLOAT), cleaned.try_cast("double"))


def normalize_quartile(value) -> Column:
    """A numeric score becomes its quartile label; any other text is kept."""
    v = _col(value)
    num = python_float(v)
    return F.when(num.isNotNull(), quartile_from_score(num)).otherwise(v)
