"""Scalar column functions (all JVM built-ins, so they stay in codegen)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow import schema as S

# The characters Python's str.split() treats as whitespace
# (TAB..CR, FS..US, space, NEL, NBSP, OGHAM SPACE, EN QUAD..HAIR SPACE,
# LINE/PARAGRAPH SEPARATOR, NNBSP, MMSP, IDEOGRAPHIC SPACE), written with
# \x{..} escapes that both Java regex and RE2 understand.
PY_WHITESPACE_CLASS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
FIRST_WORD_PATTERN = "([^" + PY_WHITESPACE_CLASS + "]+)"

# Dashboard durations and their look-back (None = all time);
# any other choice falls back to 24 hours.
DURATIONS = {
    "30 minutes": dt.timedelta(minutes=30),
    "1 hour": dt.timedelta(hours=1),
    "3 hours": dt.timedelta(hours=3),
    "6 hours": dt.timedelta(hours=6),
    "24 hours": dt.timedelta(hours=24),
    "All time": None,
}
DEFAULT_DURATION = "24 hours"
# Fixed value: the dashboard pins "now" to this calendar day, keeping the time.
ANCHOR_DAY = dt.date(2010, 12, 1)
# Time text in the wire's format with every digit written.
FULL_TS_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_invoice_ts(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> timestamp_ntz, bad -> NULL.

    Month, day and time fields may have one digit.  Times outside the
    reference parser's range (nanoseconds in 64 bits around 1970) are bad dates.
    Text with all its digits is cast, which gives the same time without the slow pattern parser; its order
    is that of its time, so the range is tested on the text and the time is read once, not for each bound.
    """
    text = _c(c)
    cast = F.when((text >= S.TS_RANGE[0]) & (text <= S.TS_RANGE[1]), text.try_cast("timestamp_ntz"))
    ts = F.try_to_timestamp(text, F.lit(S.WIRE_TS_PARSE_FORMAT)).cast("timestamp_ntz")
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in S.TS_RANGE)
    return F.when(text.rlike(FULL_TS_TEXT), cast).otherwise(F.when((ts >= lo) & (ts <= hi), ts))


def customer_id_text(c) -> Column:
    """float id -> text without the ``.0`` of an integral value."""
    x = _c(c)
    integral = (x % 1 == 0) & (F.abs(x) < F.lit(1e18))
    return F.when(integral, x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def first_word(c) -> Column:
    """first whitespace-separated word (Python split semantics), blank -> NULL."""
    return F.nullif(F.regexp_extract(_c(c), FIRST_WORD_PATTERN, 1), F.lit(""))


def hour_of_day(c) -> Column:
    """F4."""
    return F.hour(_c(c))


def money_text(c) -> Column:
    """``$1,234.56``."""
    return F.concat(F.lit("$"), F.format_number(_c(c), 2))


def count_text(c) -> Column:
    """integer with thousands separators."""
    return F.format_number(_c(c), 0)


def percent_text(c) -> Column:
    """one-decimal percent text (Java rounds half-up)."""
    return F.format_string("%.1f%%", _c(c))


def row_to_json(*cols) -> Column:
    """F8: row -> JSON object text, nulls kept."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def iso_timestamp_text(c) -> Column:
    """ISO-8601 text with a ``T`` separator."""
    return F.date_format(_c(c), S.ISO_TS_FORMAT)


def month_label(c) -> Column:
    """``YYYY_MM``."""
    return F.date_format(_c(c), "yyyy_MM")


def month_text(t: dt.datetime) -> str:
    """F10 of a driver-side time: the label that :func:`month_label` stores."""
    return f"{t.year:04d}_{t.month:02d}"


def add_month(c, n: int = 1) -> Column:
    """F11."""
    return F.add_months(_c(c), n)


def anchor_now(now: dt.datetime | None = None, day: dt.date = ANCHOR_DAY) -> dt.datetime:
    """Move "now" onto the anchor day, keeping the time of day."""
    now = now or dt.datetime.now()
    return now.replace(year=day.year, month=day.month, day=day.day)


def window_bounds(duration: str, now: dt.datetime):
    """Duration choice -> inclusive (lower, upper) or None for all time."""
    if duration not in DURATIONS:
        duration = DEFAULT_DURATION
    delta = DURATIONS[duration]
    if delta is None:
        return None
    return now - delta, now
