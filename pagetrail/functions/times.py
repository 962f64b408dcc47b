"""Instants and civil times from integer microseconds, independent of the session time zone.

Each takes and gives SQL expression text.
"""

from __future__ import annotations

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND


def instant(micros: str) -> str:
    """Microseconds since the epoch as a TIMESTAMP."""
    return f"timestamp_micros({micros})"


def civil(micros: str) -> str:
    """Microseconds since the epoch as a UTC wall-clock TIMESTAMP_NTZ."""
    return f"timestampadd(MICROSECOND, {micros}, TIMESTAMP_NTZ'1970-01-01 00:00:00')"


def utc_day(micros: str) -> str:
    """UTC calendar day of an instant."""
    return f"to_date({civil(micros)})"


def parse_day(text: str) -> str:
    """``YYYYMMDD`` text as a DATE; bad text is an error under ANSI mode."""
    return f"to_date({text}, 'yyyyMMdd')"


def whole_seconds(start: str, end: str) -> str:
    """Whole seconds between two instants given in microseconds."""
    return f"(({end}) - ({start})) div {MICROS_PER_SECOND}"


def floor_to(number: str, width: int) -> str:
    """Largest multiple of ``width`` that is not above the number."""
    return f"({number}) - pmod({number}, {width}L)"


def second_steps(start: str, end: str) -> str:
    """Beginnings of seconds passed between two instants given in microseconds."""
    return f"({floor_to(end, MICROS_PER_SECOND)} - ({floor_to(start, MICROS_PER_SECOND)})) div {MICROS_PER_SECOND}"
