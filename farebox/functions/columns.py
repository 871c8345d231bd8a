"""Row-level expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.  Session ANSI mode is left on, so every
division that may see a zero goes through :func:`safe_div`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.schemas import DAY_PERIODS, MAX_ZONE_ID, MIN_ZONE_ID

ColumnOrName = Column | str

MICROS_PER_MINUTE = 60_000_000.0


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_div(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator / nullif(denominator, 0)`` — NULL instead of an ANSI error."""
    return _c(numerator) / F.nullif(_c(denominator), F.lit(0))


def surrogate_key(*parts: ColumnOrName) -> Column:
    """md5 of the '|'-joined text of the parts; NULL parts are skipped."""
    return F.md5(F.concat_ws("|", *[_c(p).cast("string") for p in parts]))


def trip_id(kind: ColumnOrName = "source_kind", file_id: ColumnOrName = "source_file_id",
            row_number: ColumnOrName = "source_row_number") -> Column:
    return surrogate_key(kind, file_id, row_number)


def duration_minutes(pickup: ColumnOrName = "pickup_datetime",
                     dropoff: ColumnOrName = "dropoff_datetime") -> Column:
    """Elapsed minutes with sub-second precision (integer microseconds / 6e7)."""
    return F.timestamp_diff("MICROSECOND", _c(pickup), _c(dropoff)) / F.lit(MICROS_PER_MINUTE)


def invalid_reason(pickup: ColumnOrName = "pickup_datetime",
                   dropoff: ColumnOrName = "dropoff_datetime",
                   pickup_zone: ColumnOrName = "pickup_location_id",
                   dropoff_zone: ColumnOrName = "dropoff_location_id",
                   distance: ColumnOrName = "trip_distance",
                   amount: ColumnOrName = "total_amount") -> Column:
    """First failing rule wins; NULL means the trip is valid.

    A zero-minute trip is valid (strict ``<``); NULL distance or amount is valid.
    """
    p, d, pz, dz = _c(pickup), _c(dropoff), _c(pickup_zone), _c(dropoff_zone)
    return (
        F.when(p.isNull(), "missing_pickup_datetime")
        .when(d.isNull(), "missing_dropoff_datetime")
        .when(d < p, "dropoff_before_pickup")
        .when(pz.isNull(), "missing_pickup_location")
        .when(dz.isNull(), "missing_dropoff_location")
        .when(~pz.between(MIN_ZONE_ID, MAX_ZONE_ID), "invalid_pickup_location")
        .when(~dz.between(MIN_ZONE_ID, MAX_ZONE_ID), "invalid_dropoff_location")
        .when(_c(distance) < 0, "negative_trip_distance")
        .when(_c(amount) < 0, "negative_total_amount")
    )


def average_speed_mph(duration: ColumnOrName = "duration_minutes",
                      distance: ColumnOrName = "trip_distance") -> Column:
    """miles / hours, only for positive duration and known distance."""
    dur, dist = _c(duration), _c(distance)
    return F.when((dur > 0) & dist.isNotNull(), dist / (dur / F.lit(60.0)))


def date_key(ts: ColumnOrName) -> Column:
    """yyyymmdd as INT, computed arithmetically (no string formatting)."""
    t = _c(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def date_of_key(key: ColumnOrName) -> Column:
    """The date of a yyyymmdd key."""
    k = _c(key)
    return F.make_date(F.floor(k / 10000).cast("int"), (F.floor(k / 100) % 100).cast("int"), (k % 100).cast("int"))


def day_period(hour: ColumnOrName) -> Column:
    """Operating period of an hour of the day."""
    h, out = _c(hour), None
    for name, first, last in DAY_PERIODS:
        out = F.when(h.between(first, last), name) if out is None else out.when(h.between(first, last), name)
    return out


def hour_key(ts: ColumnOrName) -> Column:
    return F.hour(_c(ts)).cast("short")


def floor_round(col: ColumnOrName, digits: int = 6) -> Column:
    """Round a double to ``digits`` decimals via floor, for presentation.

    The rounding boundary sits at 0.499 of the last unit instead of 0.5: an
    exact decimal tie (e.g. an average of 3-decimal values ending in ...5 at
    the 7th decimal) then rounds the same way whatever the summation order of
    the engine, while no value with few decimals lands on the boundary itself.
    """
    scale = float(10 ** digits)
    return F.floor(_c(col) * F.lit(scale) + F.lit(0.501)) / F.lit(scale)
