"""Sets of days as bits of one BIGINT, in SQL text.

A month and its look-back fit into 63 bits, so a device's whole month travels
through a shuffle as one number, and ``bit_or`` combines such numbers map-side.
"""

from __future__ import annotations

# 63 usable bits less the 31 days of the longest month.
MAX_WINDOW_DAYS = 32


def bit(position: str) -> str:
    return f"shiftleft(1L, {position})"


def has_bit(days: str, position: str) -> str:
    return f"(shiftright({days}, {position}) & 1L) = 1L"


def any_of_preceding(days: str, window_days: int, month_length: int) -> str:
    """Month days that have a set bit among their preceding days.

    Bit 0 of ``days`` is the first look-back day; bit 0 of the result is the
    first day of the month.
    """
    if window_days == 0:
        return f"({days} & 0L)"
    either = " | ".join(f"shiftright({days}, {i})" for i in range(window_days))
    return f"(({either}) & {(1 << month_length) - 1}L)"


def without(days: str, taken: str) -> str:
    return f"({days} & ~({taken}))"
