"""Scalar column helpers (survey 2.C).

Every helper returns a ``Column`` built from native Spark expressions, so it
stays inside whole-stage codegen.  Time helpers work on ``timestamp_ntz``
columns by field arithmetic only, which makes them independent of the
session time zone (a ``date_trunc`` round trip through a zoned timestamp is
not: it shifts wall-clock times that fall into a DST gap).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius used by the haversine distance, in km.
EARTH_RADIUS_KM = 6371.0088


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hours(n) -> Column:
    """Day-time interval of ``n`` whole hours."""
    return F.make_dt_interval(F.lit(0), _c(n).cast("int"))


def days(n) -> Column:
    """Day-time interval of ``n`` whole days."""
    return F.make_dt_interval(_c(n).cast("int"))


def trunc_second(ts) -> Column:
    """Drop the fractional seconds of a timestamp_ntz."""
    ts = _c(ts)
    frac = F.extract(F.lit("SECOND"), ts) - F.second(ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), frac)


def day_start(ts) -> Column:
    """Midnight of the day of ``ts`` as timestamp_ntz."""
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def hours_between(a, b, mode: str = "boundary") -> Column:
    """``DATEDIFF('hour', a, b)``.

    ``boundary`` counts hour boundaries crossed (00:59 -> 01:01 is 1), the
    warehouse semantics; ``elapsed`` counts whole elapsed hours.
    """
    a, b = _c(a), _c(b)
    if mode == "boundary":
        return (F.datediff(F.to_date(b), F.to_date(a)).cast("long") * 24
                + F.hour(b) - F.hour(a))
    if mode == "elapsed":
        return F.timestamp_diff("HOUR", a, b)
    raise ValueError(f"unknown mode {mode!r}")


def minutes_between(a, b) -> Column:
    """``DATEDIFF('minute', a, b)`` as boundary count."""
    a, b = _c(a), _c(b)
    return (F.datediff(F.to_date(b), F.to_date(a)).cast("long") * 1440
            + (F.hour(b) * 60 + F.minute(b)) - (F.hour(a) * 60 + F.minute(a)))


def null_greatest0(x) -> Column:
    """``GREATEST(0, x)`` that keeps NULL for a NULL input."""
    x = _c(x)
    return F.when(x.isNotNull(), F.greatest(F.lit(0).cast("long"), x.cast("long")))


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)`` (ANSI mode raises on a zero divisor)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def pct(part, whole, scale: int = 1) -> Column:
    """``ROUND(part::FLOAT / NULLIF(whole, 0) * 100, scale)``."""
    return F.round(safe_div(_c(part).cast("double"), whole) * 100, scale)


def count_if(pred) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)`` as bigint."""
    return F.sum(F.when(pred, 1).otherwise(0)).cast("long")


def week_start(d) -> Column:
    """``DATE_TRUNC('week', d)`` as a date, weeks starting on Monday."""
    d = F.to_date(_c(d))
    # dayofweek: 1 = Sunday .. 7 = Saturday; Monday offset 0.
    return F.date_sub(d, (F.dayofweek(d) + 5) % 7)


def dow_sunday0(d) -> Column:
    """``DAYOFWEEK`` with 0 = Sunday."""
    return F.dayofweek(_c(d)) - 1


def ts_key_text(ts) -> Column:
    """Fixed text form of a timestamp inside hashed keys."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss.SSS")


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km on a sphere of radius EARTH_RADIUS_KM."""
    lat1, lon1, lat2, lon2 = (F.radians(_c(v)) for v in (lat1, lon1, lat2, lon2))
    h = (F.pow(F.sin((lat2 - lat1) / 2), 2)
         + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2))
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def grid_cell(lat, lon, res: int) -> Column:
    """Stable square-grid cell id for a point.

    Cell edge in degrees is ``2**(2 - res)`` (res 5: 1/8 deg, res 7: 1/32 deg); the id is
    ``r{res}:{row}:{col}``.  This is a binning key, not an H3 index.
    """
    size = 1.0 / (2 ** (res - 2))
    row = F.floor((_c(lat) + 90.0) / size).cast("long")
    col = F.floor((_c(lon) + 180.0) / size).cast("long")
    return F.concat_ws(":", F.lit(f"r{res}"), row.cast("string"), col.cast("string"))


def lit_ntz(value) -> Column:
    """A timestamp_ntz literal from a naive ``datetime`` (via text, so neither
    the Python process zone nor the session zone shifts it)."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
