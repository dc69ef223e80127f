"""Scalar expressions of the telemetry domain (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- numbers ------------------------------------------------------------------

def clamp(x, lo, hi) -> Column:
    """``min(max(x, lo), hi)``."""
    return F.least(F.greatest(_c(x), F.lit(lo)), F.lit(hi))


def aqi_from_pm25(pm25, factor: float = 2.5, lo: int = 0, hi: int = 500) -> Column:
    """AQI estimate from PM2.5: ``clamp(int(pm25 * factor), 0, 500)``.

    Clamped before the cast (same result, since the cast truncates toward
    zero like Python's ``int``) so that wild readings cannot overflow it.
    """
    return clamp(_c(pm25) * F.lit(factor), float(lo), float(hi)).cast("int")


def round_half_even(x, digits: int) -> Column:
    """Banker's rounding (Python ``round``) -- ``bround`` on the decimal text."""
    return F.bround(_c(x), digits)


#: decimals a measurement is summed with: 16 digits before the point, 12 after
EXACT = "decimal(28,12)"


def fixed_sum(x) -> Column:
    """Sum of a measurement as double, exact and independent of the order
    wherever every value fits ``EXACT`` without loss.

    Double sums differ in the last bits between runs because partitions are
    added in arrival order; the decimal sum makes every re-run (and every
    engine) return the same number.  If any value of the group is finer or
    larger than the decimal holds (or is not finite), the group's sum is the
    plain double sum: no value is rounded, dropped or an error.
    """
    v = _c(x).cast("double")
    d = v.try_cast(EXACT)
    exact = F.count_if(v.isNotNull() & ~F.coalesce(d.cast("double") == v, F.lit(False))) == 0
    return F.when(exact, F.try_sum(d).cast("double")).otherwise(F.sum(v))


def fixed_avg(x) -> Column:
    """Mean by ``fixed_sum`` over the count."""
    return fixed_sum(x) / F.count(_c(x))


def number_text(x) -> Column:
    """A number as a message prints it: whole ones without a decimal point."""
    v = _c(x).cast("double")
    return F.when((v == F.floor(v)) & (F.abs(v) < 1e15), v.cast("long").cast("string")).otherwise(v.cast("string"))


# -- time ---------------------------------------------------------------------

def epoch_seconds(ts) -> Column:
    """Event time as fractional epoch seconds (double), microsecond exact."""
    return F.unix_micros(_c(ts).cast("timestamp")) / F.lit(1_000_000.0)


def epoch_micros(ts) -> Column:
    return F.unix_micros(_c(ts).cast("timestamp"))


def parse_iso_ts(s) -> Column:
    """ISO-8601 text (``Z`` or ``+00:00`` suffix, optional fraction) to
    timestamp; NULL when unparsable (the caller decides skip vs dead-letter)."""
    txt = F.regexp_replace(F.trim(_c(s)), "Z$", "+00:00")
    return F.coalesce(
        F.try_to_timestamp(txt, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
        F.try_to_timestamp(txt, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")),
        F.try_to_timestamp(txt, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(txt, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        F.try_to_timestamp(txt, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
    )


def bucket_label(ts, seconds: int) -> Column:
    """Start of the epoch-aligned bucket, formatted ``yyyy-MM-ddTHH:mm``."""
    start = F.timestamp_seconds(F.floor(epoch_seconds(ts) / seconds) * seconds)
    return F.date_format(start, "yyyy-MM-dd'T'HH:mm")


def iso_ms(ts) -> Column:
    """Timestamp rendered as ISO-8601 UTC with milliseconds."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def fixed(x, decimals: int) -> Column:
    """Number as text with ``decimals`` digits, no grouping, rounded half-even
    on the exact binary value (Python's ``f"{x:.{n}f}"``; Java's ``%.nf``
    would round half-up)."""
    pattern = "0" + ("." + "0" * decimals if decimals else "")
    return F.call_function("format_number", _c(x), F.lit(pattern))


def py_round(x, decimals: int) -> Column:
    """Python's ``round(x, n)`` on a double: half-even on the exact binary
    value (``round(2.675, 2) == 2.67``), unlike ``round`` (half-up) and
    ``bround`` (half-even on the shortest decimal text)."""
    return fixed(x, decimals).cast("double")


# -- advisories ---------------------------------------------------------------

def advisory_level(avg_aqi, hazardous_above: float = 300.0) -> Column:
    return F.when(_c(avg_aqi) > hazardous_above, F.lit("HAZARDOUS")).otherwise(F.lit("UNHEALTHY"))


def advisory_text(zone_name, level, avg_aqi, schools, hospitals, population) -> Column:
    """Human text of a health advisory.

    Missing profile values print as ``?`` (schools, hospitals) and ``0``
    (population), with thousands separators on the population.
    """
    return F.format_string(
        "Air quality in %s is %s. Rolling 10-min AQI = %s. %s schools and %s hospitals affected. "
        "Population at risk: %s.",
        _c(zone_name), _c(level), fixed(avg_aqi, 0),
        F.coalesce(_c(schools).cast("string"), F.lit("?")),
        F.coalesce(_c(hospitals).cast("string"), F.lit("?")),
        F.format_number(F.coalesce(_c(population), F.lit(0)), 0),
    )
