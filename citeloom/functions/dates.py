"""Date and timestamp parsing with the acceptance rules of Python's ``strptime``.

``strptime`` accepts one- or two-digit days, any case of a full month name and
any run of whitespace where the format has a blank, and rejects trailing text,
impossible dates and year 0. Each parser first checks the text against an
anchored regular expression with those rules, then builds the value with a
``try_*`` constructor, so a bad value is NULL instead of an error under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.constants import DATE_PREFIX, MONTHS
from citeloom.functions.text import PY_SPACE, remove_all

# strptime field rules (Python's _strptime), ASCII digits.
_DAY = r"(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_MONTH_NUM = r"(1[0-2]|0[1-9]|[1-9])"
_YEAR = r"([0-9]{4})"
_HOUR = r"(2[0-3]|[01][0-9]|[0-9])"
_MINUTE = r"([0-5][0-9]|[0-9])"
_SECOND = r"(6[01]|[0-5][0-9]|[0-9])"
_MONTH_NAME = "(" + "|".join(MONTHS) + ")"
_GAP = PY_SPACE + "+"

DAY_MONTH_YEAR = "(?i)^" + _DAY + _GAP + _MONTH_NAME + _GAP + _YEAR + r"\z"
SENSOR_TS = ("^" + _YEAR + "-" + _MONTH_NUM + "-" + _DAY + _GAP + _HOUR + ":"
             + _MINUTE + ":" + _SECOND + r"\z")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int_group(c: Column, pattern: str, idx: int) -> Column:
    return F.trim(F.regexp_extract(c, pattern, idx)).cast("int")


def parse_day_month_year(c) -> Column:
    """``datetime.strptime(s, "%d %B %Y").date()``; NULL when Python would raise."""
    s = _col(c)
    month = F.array_position(F.array(*[F.lit(m.lower()) for m in MONTHS]),
                             F.lower(F.regexp_extract(s, DAY_MONTH_YEAR, 2))).cast("int")
    year = _int_group(s, DAY_MONTH_YEAR, 3)
    day = _int_group(s, DAY_MONTH_YEAR, 1)
    made = F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0))
    return F.when(s.rlike(DAY_MONTH_YEAR) & (year >= 1), made.cast("date"))


def publication_date_text(c) -> Column:
    """Publication date text with the label prefix removed; NULL becomes ''."""
    return remove_all(F.coalesce(_col(c), F.lit("")), DATE_PREFIX)


def parse_publication_date(c) -> Column:
    """Date of a publication: '' -> NULL; otherwise the parsed date or NULL."""
    text = publication_date_text(c)
    return F.when(text != "", parse_day_month_year(text))


def publication_date_rejected(c) -> Column:
    """True when the text is non-empty and does not parse (the record fails)."""
    text = publication_date_text(c)
    return (text != "") & parse_day_month_year(text).isNull()


def parse_sensor_timestamp(c) -> Column:
    """``datetime.strptime(s, "%Y-%m-%d %H:%M:%S")`` as TIMESTAMP_NTZ, else NULL.

    Seconds 60/61 pass the field rule but not ``datetime``; Spark's
    constructor would roll them into the next minute, so they are cut here.
    """
    s = _col(c)
    parts = [_int_group(s, SENSOR_TS, i) for i in range(1, 7)]
    made = F.try_make_timestamp_ntz(*parts)
    return F.when(s.rlike(SENSOR_TS) & (parts[0] >= 1) & (parts[5] <= 59), made)


def iso_utc_text(ts, source_tz: str | None = None) -> Column:
    """ISO-8601 text with a literal 'Z'. The wall-clock time is kept as is
    unless ``source_tz`` names the zone it was written in."""
    t = _col(ts)
    if source_tz:
        t = F.to_utc_timestamp(t.cast("timestamp"), source_tz).cast("timestamp_ntz")
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_parts(c) -> list[Column]:
    d = _col(c)
    return [F.year(d).alias("year"), F.month(d).alias("month"),
            F.dayofmonth(d).alias("day")]
