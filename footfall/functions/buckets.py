"""Bucketing rules: age ranges, visit length, group size and time offset bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions import clock

# Fixed values. -------------------------------------------------------------
AGE_RANGES = [(0, 20, "0-20"), (21, 39, "21-39"), (40, 65, "40-65")]
AGE_OVER = (65, "65+")
SHORT_STAY_SECONDS = 15 * 60

# Legal offset bins, in minutes before or after the base capture.
OFFSET_BINS = [-60, -45, -30, -15, -10, -5, 0, 5, 10, 15, 30, 45, 60]

# Closed range of time differences that lands in each bin. "boundary" and
# "elapsed" are in minutes (boundaries crossed / floor of elapsed), "fractional"
# is in seconds. A difference in no range belongs to no bin. Bin 0 and the
# same-time part of bin 5 depend on more than the difference: see offset_bin.
OFFSET_RANGES = {
    "boundary": {
        -60: (-59, -45), -45: (-44, -30), -30: (-29, -16),
        -15: (-14, -10), -10: (-9, -5), -5: (-4, -1),
        5: (0, 4), 10: (5, 9), 15: (10, 14),
        30: (16, 29), 45: (30, 44), 60: (45, 59),
    },
    "elapsed": {
        -60: (-60, -46), -45: (-45, -31), -30: (-30, -16),
        -15: (-15, -11), -10: (-10, -6), -5: (-5, -1),
        5: (0, 4), 10: (5, 9), 15: (10, 14),
        30: (16, 29), 45: (30, 44), 60: (45, 59),
    },
    "fractional": {
        -60: (-3600, -2701), -45: (-2700, -1801), -30: (-1800, -960),
        -15: (-900, -601), -10: (-600, -301), -5: (-300, -1),
        5: (1, 299), 10: (300, 599), 15: (600, 899),
        30: (960, 1799), 45: (1800, 2699), 60: (2700, 3599),
    },
}
# ---------------------------------------------------------------------------


def age_range(age: Column, unknown: str | None = None) -> Column:
    bucket = F.when(age > AGE_OVER[0], AGE_OVER[1])
    for low, high, label in AGE_RANGES:
        bucket = bucket.when(age.between(low, high), label)
    return bucket.otherwise(F.lit(unknown))


def is_short_stay(stay_seconds: Column) -> Column:
    """Less than 15 minutes."""
    return stay_seconds < SHORT_STAY_SECONDS


def group_size_label(size: Column) -> Column:
    """1, 2, 3, 4, 5 or ``5+``."""
    return F.when(size > 5, "5+").when(size >= 0, F.greatest(size, F.lit(1)).cast("string"))


def offset_diff(base: Column, other: Column, mode: str) -> Column:
    """Time from ``base`` to ``other`` in the unit of ``OFFSET_RANGES[mode]``."""
    measure = {
        "boundary": clock.boundary_minutes,
        "elapsed": clock.elapsed_minutes,
        "fractional": clock.elapsed_seconds,
    }
    return measure[mode](base, other)


def offset_bin(base: Column, other: Column, mode: str, same_row: Column | None = None) -> Column:
    """Bin of a capture at ``other`` seen from one at ``base``; null if it has none.

    ``boundary`` and ``fractional`` put every capture at the very same time in
    bin 0. ``elapsed`` does so for the base row alone (``same_row``) and puts
    other captures of that second in bin 5.
    """
    own = base == other if mode != "elapsed" or same_row is None else same_row
    diff = offset_diff(base, other, mode)
    result = F.when(own, F.lit(0))
    for offset, (low, high) in OFFSET_RANGES[mode].items():
        result = result.when(diff.between(low, high), F.lit(offset))
    return result
