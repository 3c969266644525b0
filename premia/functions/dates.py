"""Date expressions. The session zone is UTC (see ``premia.session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_DAY = 86_400_000_000


def canonical_date(raw: Column, invalid: str = "null") -> Column:
    """Any ISO date, timestamp (with or without zone) or bare year as zone-less UTC midnight.

    Text that is no date gives NULL, or fails the job with ``invalid='raise'``.
    """
    if invalid not in ("null", "raise"):
        raise ValueError(f"invalid must be 'null' or 'raise', not {invalid!r}")
    day = F.to_date(raw.try_cast("timestamp")).cast("timestamp_ntz")
    if invalid == "null":
        return day
    failure = F.raise_error(F.concat(F.lit("not a date: "), raw)).cast("timestamp_ntz")
    return F.when(raw.isNull(), None).otherwise(F.coalesce(day, failure))


def days_between(later: Column, earlier: Column) -> Column:
    """Difference in calendar days."""
    return F.datediff(later, earlier)


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Full 24-hour periods between two instants, rounded down."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    rest = F.pmod(micros, F.lit(_MICROS_PER_DAY))
    return ((micros - rest) / _MICROS_PER_DAY).cast("long")


def whole_second(instant: Column) -> Column:
    """The instant without its fraction of a second."""
    return F.date_trunc("second", instant).cast("timestamp_ntz")
