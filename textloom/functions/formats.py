"""Report columns: ratios, sizes, durations, status words and quality bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size units, each 1,024 of the one before.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")
# Status words of a progress record.
COMPLETE, FAILED, IN_PROGRESS = "Complete", "Failed", "In Progress"
# Upper bounds (inclusive) of the bands for tokens per word.
EXCELLENT_MAX, GOOD_MAX = 2.5, 3.5


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, or 0 when ``whole`` is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def format_size(n_bytes: Column) -> Column:
    """Bytes as text with two decimals, ties to even, in the largest unit that keeps it under 1,024."""
    value = n_bytes.cast("double")
    last = len(SIZE_UNITS) - 1
    shown = None
    for power, unit in enumerate(SIZE_UNITS):
        scaled = F.bround(value / float(1024**power), 2)
        text = F.format_string(f"%.2f {unit}", scaled)
        fits = value < float(1024 ** (power + 1))
        if shown is None:
            shown = F.when(fits, text)
        elif power < last:
            shown = shown.when(fits, text)
        else:
            shown = shown.otherwise(text)
    return F.when(value.isNotNull(), shown)


def format_duration(seconds: Column) -> Column:
    """Whole seconds as ``[D day[s], ]H:MM:SS``; a fraction is cut toward zero."""
    whole = seconds.cast("double").cast("bigint")
    days = F.floor(whole / F.lit(86400)).cast("bigint")
    rest = whole - days * 86400
    clock = F.format_string(
        "%d:%02d:%02d",
        F.floor(rest / 3600).cast("bigint"),
        F.floor((rest % 3600) / 60).cast("bigint"),
        (rest % 60).cast("bigint"),
    )
    unit = F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, "))
    return F.when(days == 0, clock).otherwise(F.concat(days.cast("string"), unit, clock))


def status_text(completed: Column, failed: Column) -> Column:
    """Complete wins over failed; neither means in progress."""
    return (
        F.when(F.coalesce(completed, F.lit(False)), COMPLETE)
        .when(F.coalesce(failed, F.lit(False)), FAILED)
        .otherwise(IN_PROGRESS)
    )


def fertility_band(fertility: Column) -> Column:
    """Band of a tokens-per-word figure."""
    return (
        F.when(fertility <= EXCELLENT_MAX, "EXCELLENT")
        .when(fertility <= GOOD_MAX, "GOOD")
        .otherwise("POOR")
    )


def elapsed_micros(start: Column, end: Column) -> Column:
    """Microseconds from one ISO timestamp text to another; null when either is missing or malformed."""
    return F.unix_micros(F.try_to_timestamp(end)) - F.unix_micros(F.try_to_timestamp(start))
