"""Column expressions (JVM-side, stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stintlake import DNF_POSITION_ORDER


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def full_name(forename="forename", surname="surname", null_safe: bool = True) -> Column:
    """``forename || ' ' || surname``.

    ``null_safe=True`` replaces a missing part by '' (never null, the catalog
    form); ``False`` propagates null (the mart form).
    """
    f, s = _c(forename), _c(surname)
    if null_safe:
        return F.concat(F.coalesce(f, F.lit("")), F.lit(" "), F.coalesce(s, F.lit("")))
    return F.concat(f, F.lit(" "), s)


def surname_of(name) -> Column:
    """Last whitespace-separated token of a display name."""
    return F.element_at(F.split(F.trim(_c(name)), r"\s+"), -1)


def race_id(year="year", round_="round") -> Column:
    """``year * 100 + round`` as BIGINT (same as the zero-padded concat) for
    rounds up to 99; ``year * 10^10 + round`` beyond, so that no two races
    share a key."""
    y, r = _c(year).cast("bigint"), _c(round_).cast("bigint")
    return F.when(r <= 99, y * 100 + r).otherwise(y * F.lit(10 ** 10) + r)


def round_half_up(x, digits: int = 0) -> Column:
    """Half away from zero on the binary value, as SQL's ROUND: the rounded
    absolute value with the sign of ``x``; NaN stays NaN.

    Written the same way in the SQL twins so both engines agree bit for bit.
    """
    scale = float(10 ** digits)
    d = _c(x).cast("double")
    v = F.floor(F.abs(d) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.isnan(d), d).otherwise(F.when(d < 0, F.lit(0.0) - v).otherwise(v))


def round_even(x, digits: int = 0) -> Column:
    """Half-to-even rounding on the binary value (as Python's ``round`` in
    the statistical models): ties (fraction exactly .5 after scaling) go to
    the even neighbour. Same expression in the SQL twins."""
    scale = F.lit(float(10 ** digits))
    y = _c(x).cast("double") * scale
    f = F.floor(y).cast("double")
    frac = y - f
    up = f + F.lit(1.0)
    v = (F.when(frac > 0.5, up).when(frac < 0.5, f)
         .when(f % 2 == 0, f).otherwise(up))
    return v / scale


def count_where(cond: Column) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)`` as BIGINT."""
    return F.count(F.when(cond, F.lit(1)))


def pct(cond: Column, digits: int = 2) -> Column:
    """Share of rows (in percent) for which ``cond`` holds, rounded half-up."""
    return round_half_up(count_where(cond) * F.lit(100.0) / F.count(F.lit(1)), digits)


def is_dnf(position_order="position_order", sentinel: int = DNF_POSITION_ORDER) -> Column:
    return _c(position_order) == F.lit(sentinel)


def finished(position_order="position_order", sentinel: int = DNF_POSITION_ORDER) -> Column:
    return _c(position_order) < F.lit(sentinel)


def avg_where(cond: Column, value) -> Column:
    """``AVG(CASE WHEN cond THEN value END)``."""
    return F.avg(F.when(cond, _c(value)))


def avg_finish(position_order="position_order", digits: int = 2) -> Column:
    """Mean finishing order over classified results."""
    po = _c(position_order)
    return round_half_up(avg_where(finished(po), po), digits)


def duration_ms(text) -> Column:
    """Duration text to milliseconds, truncating.

    ``"25.123"`` (plain seconds) and ``"1:02.5"`` (minutes:seconds) parse;
    anything else is null. Pure built-ins, no UDF.
    """
    t = F.trim(_c(text))
    plain = t.try_cast("double")
    parts = F.split(t, ":")
    mins = F.element_at(parts, 1).try_cast("bigint")
    secs = F.element_at(parts, 2).try_cast("double")
    two = (F.size(parts) == 2) & mins.isNotNull() & secs.isNotNull()
    return (
        F.when(t.isNull() | (t == ""), F.lit(None).cast("bigint"))
        .when(plain.isNotNull(), F.floor(plain * 1000).cast("bigint"))
        .when(two, F.floor((mins * 60 + secs) * 1000).cast("bigint"))
    )


def interval_seconds(iv) -> Column:
    """Day-time interval to DOUBLE seconds (microsecond precision)."""
    return F.unix_micros(F.lit("1970-01-01 00:00:00").cast("timestamp") + _c(iv)).cast("double") / 1e6


def is_digits(x) -> Column:
    return _c(x).rlike(r"^[0-9]+$")


def period_label(from_yr="from_yr", to_yr="to_yr") -> Column:
    """``2020–25``: first year, en dash, two-digit last year."""
    return F.concat(_c(from_yr).cast("string"), F.lit("–"),
                    F.lpad(F.pmod(_c(to_yr), F.lit(100)).cast("string"), 2, "0"))


def position_label(position="position") -> Column:
    return F.concat(F.lit("P"), _c(position).cast("string"))


def round_label(year="year", round_="round") -> Column:
    """``2024·R05``."""
    return F.concat(_c(year).cast("string"), F.lit("·R"),
                    F.lpad(_c(round_).cast("string"), 2, "0"))


def significance_label(p="p_value") -> Column:
    """Fixed p-value stars: < .001 ***, < .01 **, < .05 *, else ns."""
    pv = _c(p)
    return (F.when(pv < 0.001, "***").when(pv < 0.01, "**")
            .when(pv < 0.05, "*").otherwise("ns"))


def sign_bucket(x) -> Column:
    """gain / loss / same by the sign of ``x``."""
    v = _c(x)
    return F.when(v > 0, "gain").when(v < 0, "loss").otherwise("same")


def clip(x, lo=None, hi=None) -> Column:
    v = _c(x)
    if lo is not None:
        v = F.greatest(v, F.lit(lo))
    if hi is not None:
        v = F.least(v, F.lit(hi))
    return v
