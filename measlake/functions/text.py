"""Text, number and time helpers shared by the readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits with single underscores between them, as number literals allow.
_DIGITS = r"\d(?:_?\d)*"
_NUMBER = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` only knows spaces)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def capture(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, null where the pattern does not occur."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def capture_text(text: Column, pattern: str, group: int = 1) -> Column:
    """As ``capture`` for groups that cannot be empty: one regex pass."""
    return non_empty(F.regexp_extract(text, pattern, group))


def to_number(token: Column) -> Column:
    """A token as a double, or null if it is not a number.

    The plain spelling is cast at once. Everything else is checked first,
    because a cast alone takes ``1.0d`` and refuses ``1_0``.
    """
    word = F.lower(F.regexp_replace(token, r"^[+-]", ""))
    return (
        F.when(~token.rlike(r"[^0-9.eE+-]"), token.try_cast("double"))
        .when(token.rlike(_NUMBER), F.replace(token, F.lit("_"), F.lit("")).try_cast("double"))
        .when(word == "nan", F.lit(float("nan")))
        .when(
            word.isin("inf", "infinity"),
            F.when(F.startswith(token, F.lit("-")), F.lit(float("-inf"))).otherwise(
                F.lit(float("inf"))
            ),
        )
    )


def iso_time(text: Column) -> Column:
    """ISO 8601 date or date-time; without a zone it is UTC. Null otherwise."""
    return F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}(?:$|[T ]\d{2}(?::\d{2})?)"), text.try_cast("timestamp")
    ).when(
        text.rlike(r"^\d{8}T\d{6}$"),
        F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmmss")),
    )


# Date spellings found in instrument headers, weekday removed, and
# the shape that tells them apart.
_CLOCK = r" \d{1,2}:\d{2}:\d{2}"
_TIME_FORMATS = (
    (rf"^[A-Za-z]{{3}} \d{{1,2}}{_CLOCK} \d{{4}}$", "MMM d H:mm:ss yyyy"),
    (rf"^[A-Za-z]{{3}} \d{{1,2}}, \d{{4}}{_CLOCK}$", "MMM d, yyyy H:mm:ss"),
    (rf"^\d{{1,2}} [A-Za-z]{{3}} \d{{4}}{_CLOCK}$", "d MMM yyyy H:mm:ss"),
    (rf"^\d{{4}}/\d{{1,2}}/\d{{1,2}}{_CLOCK}$", "yyyy/M/d H:mm:ss"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}}{_CLOCK}$", "M/d/yyyy H:mm:ss"),
    (rf"^\d{{1,2}}-[A-Za-z]{{3}}-\d{{4}}{_CLOCK}$", "d-MMM-yyyy H:mm:ss"),
    (r"^[A-Za-z]{3} \d{1,2},? \d{4}$", "MMM d[,] yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
)
_WEEKDAY = r"^(?i)(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+"


def any_time(text: Column) -> Column:
    """A time in ISO or in one of the usual header spellings, else null."""

    def spelled(plain: Column) -> Column:
        pick = F
        for shape, fmt in _TIME_FORMATS:
            pick = pick.when(plain.rlike(shape), F.try_to_timestamp(plain, F.lit(fmt)))
        return pick

    plain = F.regexp_replace(F.regexp_replace(text, _WEEKDAY, ""), r"\s+", " ")
    return F.coalesce(iso_time(text), let(plain, spelled))


def not_json(text: Column) -> Column:
    """Whether a text is there but is not one JSON value."""
    return text.isNotNull() & F.try_parse_json(text).isNull()
