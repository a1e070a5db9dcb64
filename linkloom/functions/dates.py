"""Date expressions.  Wall-clock values only: nothing here reads the session time zone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.binding import bind

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_PUBDATE = (
    r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun),\s+(\d{1,2})\s+(" + "|".join(MONTHS) + r")\s+(\d{4})"
    r"\s+(\d{1,2}):(\d{1,2}):(\d{1,2})\s+(?:z|[+-]\d{2}:?\d{2}(?::?\d{2}(?:\.\d{1,6})?)?)$"
)
_STAMP = r"^(\d{4})-(\d{1,2})-(\d{1,2})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})$"


def _timestamp(
    text: Column,
    pattern: str,
    breaks: str,
    places: tuple[int, ...],
    month_number: Callable[[Column], Column],
) -> Column:
    """Wall clock from the parts of a matching text; null when there is no such time.

    Impossible hours and days are tested for, because a failed cast or a refused
    timestamp raises and catches an exception for each row.
    """

    def build(parts: Column) -> Column:
        year, month, *rest = [F.get(parts, F.lit(i)) for i in places]
        number = month_number(month)
        day, hour, minute, second = [part.try_cast("int") for part in rest]
        possible = (
            number.between(1, 12) & day.between(1, 31)
            & (hour < 24) & (minute < 60) & (second < 60)
        )
        stamp = F.try_make_timestamp_ntz(
            year.try_cast("int"), number, day, hour, minute, second
        )
        return F.when(possible, stamp)

    return bind(F.split(F.regexp_extract(text, pattern, 0), breaks), build)


def _month_by_name(name: Column) -> Column:
    months = F.array(*[F.lit(m) for m in MONTHS])
    return F.array_position(months, F.lower(name)).cast("int")


def pubdate_timestamp(text: Column) -> Column:
    """RFC-2822 text to the sender's wall clock; null when malformed."""
    return _timestamp(text, _PUBDATE, r"[\s,:]+", (3, 2, 1, 4, 5, 6), _month_by_name)


def pubdate_norm(text: Column) -> Column:
    """RFC-2822 text to ``yyyy-MM-dd: HH:mm:ss``, offset dropped without conversion."""
    return F.replace(run_stamp(pubdate_timestamp(text)), F.lit(" "), F.lit(": "))


def stamp_timestamp(text: Column) -> Column:
    """``yyyy-MM-dd[:] HH:mm:ss`` to a wall-clock timestamp; null when malformed."""
    plain = F.replace(text, F.lit(": "), F.lit(" "))
    return _timestamp(
        plain, _STAMP, r"[-\s:]+", (0, 1, 2, 3, 4, 5), lambda month: month.try_cast("int")
    )


def date_int(text: Column) -> Column:
    """``yyyy-MM-dd[:] HH:mm:ss`` to the integer yyyymmdd."""
    return bind(
        F.to_date(stamp_timestamp(text)),
        lambda day: (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int"),
    )


def seoul_date(utc: Column) -> Column:
    """Calendar date in Seoul of a UTC wall-clock timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("Asia/Seoul"), utc))


def run_stamp(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp.

    A cast, because ``date_format`` would first move a wall clock into the session
    time zone, where some hours of the year do not exist.
    """
    return F.substring_index(ts.cast("string"), ".", 1)
