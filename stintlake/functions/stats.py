"""Distribution functions Spark lacks: Student-t and chi-square.

numpy only (scipy is not available). They run as Arrow-batched pandas
UDFs over *aggregated* rows (one row per driver pair, per driver, per
distinct count), never per input row.

* ``t_sf2(t, df)``      two-sided p-value ``P(|T| > |t|)``
* ``t_ppf(p, df)``      quantile of Student's t
* ``chi2_ppf(p, df)``   quantile of chi-square (any positive df)

Method: regularised incomplete beta by Lentz's continued fraction, the
regularised lower incomplete gamma by its series / continued fraction,
and safeguarded Newton steps on the CDF for quantiles.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

_lgamma = np.frompyfunc(math.lgamma, 1, 1)


def _lg(x):
    return np.asarray(_lgamma(np.asarray(x, dtype=float)), dtype=float)


def _stirling(z):
    """What Stirling's formula leaves out of ln Gamma(z), for z >= 20."""
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / z ** 2) / z ** 2) / z ** 2) / z


def _lg_ratio(a, b):
    """ln Gamma(a + b) - ln Gamma(a), without cancellation where a is large."""
    big = a >= 20
    z = np.where(big, a, 20.0)
    far = (z - 0.5) * np.log1p(b / z) + b * np.log(z + b) - b + _stirling(z + b) - _stirling(z)
    return np.where(big, far, _lg(a + b) - _lg(a))


def _until(step, bound: int, what: str):
    """Call ``step(i)`` until it says that every element has converged. The
    bound is far beyond what the expansion needs for its arguments; reaching
    it is an error, never a truncated sum."""
    for i in range(1, bound + 1):
        if step(i):
            return
    raise ArithmeticError(f"{what} did not converge in {bound} steps")


def _betacf(a, b, x):
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    lentz = {"c": np.ones_like(x), "d": 1.0 / np.where(np.abs(1.0 - qab * x / qap) < tiny, tiny, 1.0 - qab * x / qap)}
    lentz["h"] = lentz["d"].copy()

    def factor(aa):
        d, c = 1.0 + aa * lentz["d"], 1.0 + aa / lentz["c"]
        lentz["d"] = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
        lentz["c"] = np.where(np.abs(c) < tiny, tiny, c)
        lentz["h"] = lentz["h"] * lentz["d"] * lentz["c"]
        return lentz["d"] * lentz["c"]

    def step(m):
        factor(m * (b - m) * x / ((qam + 2 * m) * (a + 2 * m)))
        delta = factor(-(a + m) * (qab + m) * x / ((a + 2 * m) * (qap + 2 * m)))
        return np.all(np.abs(delta - 1.0) < 1e-15)

    _until(step, 10_000 + int(100 * math.sqrt(float(np.max(qab)))), "incomplete beta")
    return lentz["h"]


def betainc(a, b, x, rest=None):
    """Regularised incomplete beta ``I_x(a, b)`` (vectorised). ``rest`` is
    1 - x where the caller knows it better than that difference."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    rest = 1.0 - x if rest is None else np.broadcast_to(np.asarray(rest, float), x.shape)
    out = np.full(x.shape, np.nan)
    ok = (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    out[ok & (x == 0)] = 0.0
    out[ok & (rest == 0)] = 1.0
    mid = ok & (x > 0) & (rest > 0)
    if mid.any():
        aa, bb, xx, yy = a[mid], b[mid], x[mid], rest[mid]
        large, small = np.maximum(aa, bb), np.minimum(aa, bb)
        log_x = np.where(yy < 0.5, np.log1p(-np.minimum(yy, 0.5)), np.log(xx))
        with np.errstate(divide="ignore"):
            log_y = np.where(yy < 0.5, np.log(yy), np.log1p(-np.minimum(xx, 0.5)))
        lbt = _lg_ratio(large, small) - _lg(small) + aa * log_x + bb * log_y
        bt = np.exp(lbt)
        direct = xx < (aa + 1.0) / (aa + bb + 2.0)
        res = np.empty_like(xx)
        if direct.any():
            res[direct] = bt[direct] * _betacf(aa[direct], bb[direct], xx[direct]) / aa[direct]
        if (~direct).any():
            flip = ~direct
            res[flip] = 1.0 - bt[flip] * _betacf(bb[flip], aa[flip], yy[flip]) / bb[flip]
        out[mid] = res
    return out


def t_sf2(t, df):
    """Two-sided tail probability of Student's t."""
    t, df = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    out = np.full(t.shape, np.nan)
    ok = np.isfinite(df) & (df > 0) & ~np.isnan(t)
    inf = ok & np.isinf(t)
    out[inf] = 0.0
    fin = ok & np.isfinite(t)
    if fin.any():
        v, tt = df[fin], t[fin]
        out[fin] = betainc(v / 2.0, 0.5, v / (v + tt * tt), tt * tt / (v + tt * tt))
    return out


def t_cdf(t, df):
    t = np.asarray(t, float)
    tail = t_sf2(t, df) / 2.0
    return np.where(t >= 0, 1.0 - tail, tail)


def _solve(cdf, pdf, p, lo, hi, x0, tol: float = 1e-13):
    """Safeguarded Newton: keep a bracket [lo, hi] with cdf(lo) < p <= cdf(hi);
    take the Newton step when it stays inside, else bisect. Every step halves
    some bracket or is a Newton step, so it ends; an error if it doesn't."""
    at = {"lo": np.array(lo, dtype=float), "hi": np.array(hi, dtype=float)}
    at["x"] = np.clip(np.array(x0, dtype=float), at["lo"], at["hi"])

    def step(_):
        x = at["x"]
        fx = cdf(x) - p
        at["lo"] = np.where(fx < 0, x, at["lo"])
        at["hi"] = np.where(fx >= 0, x, at["hi"])
        with np.errstate(divide="ignore", invalid="ignore"):
            newton = x - fx / pdf(x)
        ok = np.isfinite(newton) & (newton > at["lo"]) & (newton < at["hi"])
        at["x"] = np.where(ok, newton, (at["lo"] + at["hi"]) / 2.0)
        scale = tol * np.maximum(1.0, np.abs(at["x"]))
        return np.all((np.abs(at["x"] - x) <= scale) | (at["hi"] - at["lo"] <= scale))

    _until(step, 5000, "quantile")
    return at["x"]


def t_pdf(t, df):
    t, v = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    lc = _lg_ratio(v / 2.0, 0.5) - 0.5 * np.log(v * np.pi)
    return np.exp(lc - (v + 1.0) / 2.0 * np.log1p(t * t / v))


def t_ppf(p, df):
    """Quantile of Student's t (bracketed Newton from 0; the CDF is concave
    above 0, so the iteration climbs monotonically to the root)."""
    p, df = np.broadcast_arrays(np.asarray(p, float), np.asarray(df, float))
    out = np.full(p.shape, np.nan)
    ok = (df > 0) & (p > 0) & (p < 1)
    if ok.any():
        pp, vv = p[ok], df[ok]
        upper = pp >= 0.5
        q = np.where(upper, pp, 1.0 - pp)
        hi = np.full(q.shape, 1.0)
        while True:  # grow the bracket until it covers every quantile
            need = t_cdf(hi, vv) < q
            if not need.any():
                break
            hi = np.where(need, hi * 4.0, hi)
        x = _solve(lambda z: t_cdf(z, vv), lambda z: t_pdf(z, vv), q, np.zeros_like(q), hi, np.zeros_like(q))
        out[ok] = np.where(upper, x, -x)
    return out


def gammainc_lower(a, x):
    """Regularised lower incomplete gamma ``P(a, x)`` (vectorised): series
    below a + 1, continued fraction above, both until every element has
    converged (some times sqrt(a) terms)."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    out = np.full(x.shape, np.nan)
    ok = (a > 0) & (x >= 0)
    out[ok & (x == 0)] = 0.0
    out[ok & np.isinf(x)] = 1.0
    pos = ok & (x > 0) & np.isfinite(x)
    if not pos.any():
        return out
    aa, xx = a[pos], x[pos]
    # x**a exp(-x) / Gamma(a + 1); by Stirling's formula where a is large, as the terms would cancel
    z = np.where(aa >= 20, aa, 20.0)
    mu = (xx - z) / z
    lead = np.where(aa >= 20, z * (np.log1p(mu) - mu) - 0.5 * np.log(2 * np.pi * z) - _stirling(z), aa * np.log(xx) - xx - _lg(aa + 1.0))
    lead = np.exp(lead)
    res = np.empty_like(xx)
    ser = xx < aa + 1.0
    bound = 10_000 + int(200 * math.sqrt(float(aa.max())))
    if ser.any():
        s_a, s_x = aa[ser], xx[ser]
        term = np.ones_like(s_a)
        total = term.copy()

        def series(n):
            nonlocal term, total
            term = term * s_x / (s_a + n)
            total = total + term
            return np.all(term < total * 1e-17)

        _until(series, bound, "incomplete gamma")
        res[ser] = total * lead[ser]
    cf = ~ser
    if cf.any():
        c_a, c_x = aa[cf], xx[cf]
        tiny = 1e-300
        b = c_x + 1.0 - c_a
        c = np.full(c_x.shape, 1.0 / tiny)
        d = 1.0 / b
        h = d.copy()

        def fraction(i):
            nonlocal b, c, d, h
            an = -i * (i - c_a)
            b = b + 2.0
            d = an * d + b
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = b + an / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
            return np.all(np.abs(d * c - 1.0) < 1e-15)

        _until(fraction, bound, "incomplete gamma")
        res[cf] = 1.0 - lead[cf] * c_a * h
    out[pos] = res
    return out


def chi2_cdf(x, df):
    return gammainc_lower(np.asarray(df, float) / 2.0, np.asarray(x, float) / 2.0)


def chi2_pdf(x, df):
    x, k = np.broadcast_arrays(np.asarray(x, float), np.asarray(df, float))
    with np.errstate(divide="ignore", invalid="ignore"):
        a, h = k / 2.0, x / 2.0
        z = np.where(a >= 20, a, 20.0)
        mu = (h - z) / z
        lead = np.where(a >= 20, z * (np.log1p(mu) - mu) - 0.5 * np.log(2 * np.pi * z) - _stirling(z), a * np.log(h) - h - _lg(a + 1.0))
    return np.where(x > 0, np.exp(lead) * k / (2.0 * np.where(x > 0, x, 1.0)), 0.0)


def chi2_ppf(p, df):
    """Quantile of chi-square: bracketed Newton started at the
    Wilson–Hilferty approximation."""
    p, df = np.broadcast_arrays(np.asarray(p, float), np.asarray(df, float))
    out = np.full(p.shape, np.nan)
    ok = (df > 0) & (p > 0) & (p < 1)
    if ok.any():
        pp, vv = p[ok], df[ok]
        hi = vv + 10.0 * np.sqrt(2.0 * vv) + 50.0
        while True:
            need = chi2_cdf(hi, vv) < pp
            if not need.any():
                break
            hi = np.where(need, hi * 2.0, hi)
        z = norm_ppf(pp)
        c = 2.0 / (9.0 * vv)
        x0 = np.maximum(vv * (1.0 - c + z * np.sqrt(c)) ** 3, 1e-8)
        out[ok] = _solve(lambda x: chi2_cdf(x, vv), lambda x: chi2_pdf(x, vv), pp,
                         np.zeros_like(pp), hi, x0)
    return out


_normal = np.frompyfunc(NormalDist().inv_cdf, 1, 1)


def norm_ppf(p):
    """Standard normal quantile."""
    return np.asarray(_normal(np.asarray(p, float)), dtype=float)


# --- pandas UDFs (Arrow batches of aggregated rows) ---------------------

@F.pandas_udf(DoubleType())
def t_sf2_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_sf2(t.to_numpy(dtype=float, na_value=np.nan),
                           df.to_numpy(dtype=float, na_value=np.nan)))


@F.pandas_udf(DoubleType())
def chi2_ppf_udf(p: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(chi2_ppf(p.to_numpy(dtype=float, na_value=np.nan),
                              df.to_numpy(dtype=float, na_value=np.nan)))


@F.pandas_udf(StructType([StructField("p_value", DoubleType()), StructField("half_width", DoubleType())]))
def t_test_udf(mean: pd.Series, sd: pd.Series, n: pd.Series) -> pd.DataFrame:
    """One-sample t-test against 0 and the 95 % interval half-width, in one
    Arrow pass over the aggregated rows. Zero spread: p = 0 unless the mean
    is 0 (then undefined), no interval."""
    m = mean.to_numpy(dtype=float, na_value=np.nan)
    s = sd.to_numpy(dtype=float, na_value=np.nan)
    k = n.to_numpy(dtype=float, na_value=np.nan)
    dof = k - 1.0
    with np.errstate(divide="ignore", invalid="ignore"):
        sem = s / np.sqrt(k)
        t = m / sem
    ok = sem > 0
    p = np.full(m.shape, np.nan)
    hw = np.full(m.shape, np.nan)
    if ok.any():
        p[ok] = t_sf2(t[ok], dof[ok])
        hw[ok] = t_ppf(np.full(ok.sum(), 0.975), dof[ok]) * sem[ok]
    zero = (sem == 0) & (m != 0)
    p[zero] = 0.0
    return pd.DataFrame({"p_value": p, "half_width": hw})
