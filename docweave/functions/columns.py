"""Column expressions used by more than one operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FUTURE_TOLERANCE_MS = 60_000

# Fixed patterns: Unicode white space, ISO instants with a zone, plain numbers.
_BLANK = r"^[\s\x1C-\x1F\p{Z}]*\z"
_INSTANT = r"^[+-]?\d{4,6}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d{1,9})?)?([zZ]|[+-]\d\d(:?\d\d)?)\z"
NUMBER = r"^-?\d+(\.\d+)?([eE][+-]?\d+)?\z"
WHOLE = r"^-?\d+\z"


def is_blank(text: Column) -> Column:
    """Empty or white space only; null for null."""
    return text.rlike(_BLANK)


def instant(text: Column) -> Column:
    """Wire time: an ISO instant with a zone, or seconds since the epoch."""
    seconds = text.try_cast("decimal(20,6)")
    return F.when(text.rlike(_INSTANT), text.try_cast("timestamp")).when(
        text.rlike(NUMBER) & (F.abs(seconds) < F.lit(10**11)),
        F.timestamp_micros((seconds * 1_000_000).cast("bigint")),
    )


def epoch_ms(text: Column) -> Column:
    """A number or numeric text as whole milliseconds; null for anything else."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"))


def is_future(at: Column, clock: Column) -> Column:
    """Strictly later than the clock plus the tolerance, in whole milliseconds."""
    return F.unix_millis(at) > F.unix_millis(clock) + FUTURE_TOLERANCE_MS


def whole_ms(at: Column) -> Column:
    return F.date_trunc("MILLISECOND", at)


def completeness(name: Column, price: Column, total_stock: Column) -> Column:
    present = [c.isNotNull().cast("int") for c in (name, price, total_stock)]
    return (present[0] + present[1] + present[2]) / F.lit(3.0)


def sorted_entries(stock: Column) -> Column:
    """A stock map as an array ordered by warehouse, which can be compared."""
    return F.array_sort(F.map_entries(stock))


def stock_text(stock: Column) -> Column:
    """A stock map as ``warehouse=quantity`` pairs ordered by warehouse."""
    pairs = F.transform(
        sorted_entries(stock), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return F.array_join(pairs, ",")


def elapsed_ms(later: Column, earlier: Column) -> Column:
    """Whole milliseconds between two times, rounded towards zero."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.call_function("div", micros, F.lit(1000))
