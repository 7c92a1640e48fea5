"""Date expressions over scraped text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from edictum.functions.text import let

# Fixed value: a date as it is printed on list and document pages.
DATE = r"[0-9]{4}[-/年.][0-9]{1,2}[-/月.][0-9]{1,2}"

# Status words.
VALID, NOT_YET, REPEALED = "有效", "未生效", "废止"
REPEAL_WORDS = ("废止", "失效")


def as_date(value) -> Column:
    """A literal date from a ``date``, an ISO string or a column."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def iso_date(found: Column) -> Column:
    """A matched date text as zero-padded ``YYYY-MM-DD``."""
    return let(
        F.split(found, "[-/年月.]"),
        lambda p: F.concat_ws("-", F.get(p, F.lit(0)), F.lpad(F.get(p, F.lit(1)), 2, "0"), F.lpad(F.get(p, F.lit(2)), 2, "0")),
    )


def first_valid_date(text: Column) -> Column:
    """First date whose month is 1-12 and day 1-31, NULL if none; index numbers are passed over."""

    def plausible(found: Column) -> Column:
        parts = F.split(found, "[-/年月.]")
        return F.try_element_at(parts, F.lit(2)).cast("int").between(1, 12) & F.try_element_at(
            parts, F.lit(3)
        ).cast("int").between(1, 31)

    found = F.regexp_extract_all(text, F.lit(DATE), F.lit(0))
    return iso_date(F.get(F.filter(found, plausible), F.lit(0)))


def parse_date(c: Column) -> Column:
    """Strict ``yyyy-MM-dd``; anything else is NULL."""
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_date(c, "yyyy-M-d"))


def is_recent(date_text: Column, days: int, as_of) -> Column:
    """Undated, unreadable and future dates count as recent; ``days <= 0`` keeps everything."""
    if days <= 0:
        return F.lit(True)
    day = parse_date(date_text)
    return day.isNull() | (F.datediff(as_date(as_of), day) <= days)


def validity_status(title: Column, publish_date: Column, as_of) -> Column:
    """Repealed by title, not yet in force by date, in force otherwise."""
    title = F.coalesce(title, F.lit(""))
    repealed = F.lit(False)
    for word in REPEAL_WORDS:
        repealed = repealed | F.contains(title, F.lit(word))
    text = publish_date.cast("string")
    future = F.when(F.length(text) >= 10, parse_date(F.substring(text, 1, 10))) > as_date(as_of)
    return F.when(repealed, REPEALED).when(future, NOT_YET).otherwise(VALID)


def clamp_int(c: Column, default: int, low: int, high: int) -> Column:
    """Integer held in text, kept within bounds; unreadable text gives the default."""

    def within(text: Column) -> Column:
        digits = F.regexp_replace(text, "^([+-]?)0+(?=[0-9])", "$1")
        far = F.when(F.startswith(text, F.lit("-")), F.lit(low)).otherwise(F.lit(high))
        near = F.greatest(F.lit(low), F.least(F.lit(high), digits.try_cast("decimal(38,0)"))).cast("int")
        return F.when(text.rlike("^[+-]?[0-9]+$"), F.when(F.length(digits) > 38, far).otherwise(near))

    return F.coalesce(let(F.trim(c), within), F.lit(max(low, min(high, default))))


def clamp(value, default: int, low: int, high: int) -> int:
    """The same for a request parameter."""
    try:
        number = int(str(value).strip())
    except ValueError:
        number = default
    return max(low, min(high, number))
