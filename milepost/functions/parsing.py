"""Text to typed values. Nothing here raises on bad input: unreadable text is NULL."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from milepost.constants import EVENT_TIME_FORMATS, FILE_DATE_STYLES


WHOLE_NUMBER = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"
DECIMAL_NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"
# the usual shapes, which one cheap test tells and no text rule changes
BARE_LONG = r"^\d{1,18}\z"
BARE_NUMBER = r"^\d{1,15}(?:\.\d{1,15})?\z"
BARE_COMMA_NUMBER = r"^\d{1,15}(?:[.,]\d{1,15})?\z"
BARE_TIME = re.compile(r"(yyyy-MM-dd|dd/MM/yyyy)(?: |'T')HH:mm:ss(\.SSS)?('Z')?")

Rule = Callable[[Column], Column]


def _as_is(text: Column) -> Column:
    return text


def _point(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("."))


def to_long(text: Column) -> Column:
    """Whole number; a decimal tail is cut, so ``12.7`` reads 12 without losing long ids.

    Text of another shape never reaches the cast, whose failure path is slow.
    """
    other = F.when(text.rlike(WHOLE_NUMBER), F.regexp_extract(text, WHOLE_NUMBER, 1).try_cast("bigint"))
    return F.when(text.rlike(BARE_LONG), text.try_cast("bigint")).otherwise(other)


def _decimal(text: Column) -> Column:
    return F.when(text.rlike(DECIMAL_NUMBER), text.try_cast("double"))


def plain_double(text: Column, rule: Rule = _as_is) -> Column:
    """Double written with a decimal point. Text other than bare digits goes through ``rule`` first."""
    return F.when(text.rlike(BARE_NUMBER), text.try_cast("double")).otherwise(_decimal(rule(text)))


def to_double(text: Column, rule: Rule = _as_is) -> Column:
    """Double written with a decimal comma or point; ``rule`` as in ``plain_double``."""
    bare = F.when(text.rlike(BARE_COMMA_NUMBER), _point(text).try_cast("double"))
    return bare.otherwise(_decimal(_point(rule(text))))


def to_truncated_long(text: Column) -> Column:
    """Whole part of a decimal text (``2,9`` reads 2)."""
    return to_double(text).try_cast("bigint")


def _shape(time_format: str) -> str:
    """Pattern that every text readable by a format has.

    Digits stand for field letters; a fraction may be shorter than its field and a
    year longer, as in the format itself.
    """
    shape = re.sub(r"'([^']*)'|([.])|(S+)|(y+)|([A-Za-z])", _shape_part, time_format)
    return f"^{shape}$"


def _shape_part(match: re.Match) -> str:
    literal, dot, fraction, year, _ = match.groups()
    if literal is not None:
        return literal
    if dot:
        return r"\."
    if fraction:
        return rf"\d{{1,{len(fraction)}}}"
    return r"[+-]?\d{4,}" if year else r"\d"


def _bare_time(text: Column, time_format: str) -> tuple[str, Column] | None:
    """Shape of a text with every digit of a format in place, and that text as a cast reads it.

    A cast costs a fraction of a format and reads the same; None for formats of other layouts.
    Year 0 is left to the format, which has no such year.
    """
    found = BARE_TIME.fullmatch(time_format)
    if not found:
        return None
    date, fraction, zone = found.groups()
    shape = time_format.replace("'", "").replace(".", r"\.")
    shape = re.sub("[MdHmsS]", r"\\d", shape).replace("yyyy", r"(?!0000)\d{4}")
    end = 23 if fraction else 19
    if date == "yyyy-MM-dd":
        return shape, F.substring(text, 1, end) if zone else text
    year, month, day = (F.substring(text, at, n) for at, n in ((7, 4), (4, 2), (1, 2)))
    return shape, F.concat_ws("-", year, month, F.concat(day, F.substring(text, 11, end - 10)))


def parse_time(text: Column, formats: Sequence[str] = EVENT_TIME_FORMATS, rule: Rule = _as_is) -> Column:
    """Wall-clock timestamp by the first format that fits.

    Text with every digit in place is cast. Other text goes through ``rule``, and a format is
    tried only on text of its shape: a failed attempt costs far more than the shape test.
    """
    bare = [_bare_time(text, f) for f in formats]
    ruled = rule(text)
    shapes = [_shape(f) for f in formats]
    attempts = [
        F.when(ruled.rlike(s), F.try_to_timestamp(ruled, F.lit(f))) for s, f in zip(shapes, formats, strict=True)
    ]
    tried = F.when(ruled.rlike("|".join(shapes)), F.coalesce(*attempts))
    if None in bare:
        return tried.cast("timestamp_ntz")
    written = {}
    for shape, value in bare:
        written.setdefault(str(value), (value, []))[1].append(shape)
    read = [F.when(text.rlike(rf"^(?:{'|'.join(s)})\z"), v.try_cast("timestamp")) for v, s in written.values()]
    return F.coalesce(*read, tried).cast("timestamp_ntz")


def file_date(
    name: Column,
    style: str = "loose",
    fallback: Column | dt.date | None = None,
) -> Column:
    """Date written inside a file name or path.

    ``padded`` needs two-digit months and days, ``loose`` takes one or two digits,
    ``any_sep`` also takes dashes. A name without a date gives ``fallback`` or NULL.
    """
    pattern, date_format = FILE_DATE_STYLES[style]
    found = F.replace(F.regexp_extract(name, pattern, 1), F.lit("-"), F.lit("_"))
    parsed = F.when(name.rlike(pattern), F.try_to_date(found, date_format))
    if fallback is None:
        return parsed
    return F.coalesce(parsed, fallback if isinstance(fallback, Column) else F.lit(fallback))


def as_date(as_of: dt.date | Column | None) -> Column:
    """Run date as a column; today when none is given."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def month_start(ts: Column) -> Column:
    """First day of the month of a timestamp."""
    return F.date_trunc("month", ts).cast("date")
