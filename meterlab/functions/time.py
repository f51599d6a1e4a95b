"""Time arithmetic on TIMESTAMP_NTZ that never looks at the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SECOND = 1_000_000
_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": _SECOND,
    "minute": 60 * _SECOND,
    "hour": 3_600 * _SECOND,
    "day": 86_400 * _SECOND,
    "week": 7 * 86_400 * _SECOND,
}
_CALENDAR_STEPS = {"month": 1, "quarter": 3, "year": 12}

# 1970-01-05, the first Monday after the epoch: weeks start on Monday.
_FIRST_MONDAY = 4 * 86_400 * _SECOND


def _parse(step: str) -> tuple[int, str]:
    words = step.strip().lower().split()
    amount, unit = (1, words[0]) if len(words) == 1 else (int(words[0]), words[1])
    unit = unit.removesuffix("s")
    if len(words) > 2 or amount < 1 or unit not in (*_UNIT_MICROS, *_CALENDAR_STEPS):
        raise ValueError(f"not a time step: {step!r}")
    return amount, unit


def is_fixed_width(step: str) -> bool:
    """True for steps of constant length; months, quarters and years are not."""
    return _parse(step)[1] in _UNIT_MICROS


def width_micros(step: str) -> int:
    """Length in microseconds of a step such as ``"hour"`` or ``"15 minutes"``."""
    amount, unit = _parse(step)
    if unit not in _UNIT_MICROS:
        raise ValueError(f"{step!r} has no fixed length")
    return amount * _UNIT_MICROS[unit]


def months(step: str) -> int:
    """Number of months in a calendar step of one or more months, quarters or years."""
    amount, unit = _parse(step)
    if unit not in _CALENDAR_STEPS:
        raise ValueError(f"{step!r} is not made of months, quarters or years")
    return amount * _CALENDAR_STEPS[unit]


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ.

    Put together from date and clock: ``timestampdiff`` would read the time in
    the session zone and shift hours that the zone skips.
    """
    day = F.unix_date(ts.cast("date")).cast("bigint") * _UNIT_MICROS["day"]
    clock = F.hour(ts).cast("bigint") * _UNIT_MICROS["hour"]
    clock += F.minute(ts).cast("bigint") * _UNIT_MICROS["minute"]
    return day + clock + (F.extract(F.lit("SECOND"), ts) * _SECOND).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from one TIMESTAMP_NTZ to another."""
    return F.call_function("div", micros(end) - micros(start), F.lit(_SECOND))


def from_micros(value: Column) -> Column:
    """The TIMESTAMP_NTZ that lies so many microseconds after 1970-01-01 00:00."""
    return F.timestamp_add("MICROSECOND", value, F.expr("timestamp_ntz'1970-01-01'"))


def bucket(ts: Column, step: str) -> Column:
    """Start of the step that contains ``ts``, as TIMESTAMP_NTZ.

    ``date_trunc`` would go through the session time zone; dates and
    microseconds do not.
    """
    amount, unit = _parse(step)
    if unit in _CALENDAR_STEPS:
        if amount != 1:
            raise ValueError(f"{step!r} is not one month, quarter or year")
        return F.trunc(ts.cast("date"), unit).cast("timestamp_ntz")
    day = ts.cast("date").cast("timestamp_ntz")
    if (amount, unit) == (1, "day"):
        return day
    if (amount, unit) == (1, "hour"):
        return F.timestamp_add("HOUR", F.hour(ts), day)
    instant = micros(ts)
    offset = F.pmod(instant - F.lit(_FIRST_MONDAY), F.lit(width_micros(step)))
    return from_micros(instant - offset)


def parse_time(text: Column, pattern: str) -> Column:
    """Parse text by pattern to TIMESTAMP_NTZ; text that does not fit gives NULL.

    The text is read as UTC and the instant turned back by arithmetic, so hours
    that a session time zone skips or repeats survive.
    """
    instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(pattern + " xx"))
    return from_micros(F.unix_micros(instant))
