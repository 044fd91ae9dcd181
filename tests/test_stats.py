"""t and chi-square helpers against printed table values."""

import numpy as np
import pytest

from stintlake.functions import stats as S


@pytest.mark.parametrize("df,q", [(1, 12.7062), (5, 2.5706), (30, 2.0423), (1000, 1.9623)])
def test_t_quantile(df, q):
    assert S.t_ppf(0.975, df) == pytest.approx(q, abs=1e-4)


@pytest.mark.parametrize("p,df,q", [(0.975, 2, 7.3778), (0.975, 12, 23.3367), (0.025, 10, 3.2470),
                                    (0.025, 2, 0.0506)])
def test_chi2_quantile(p, df, q):
    assert S.chi2_ppf(p, df) == pytest.approx(q, abs=1e-4)


def test_chi2_large_df_no_underflow():
    x = S.chi2_ppf(np.array([0.025, 0.975]), np.array([2000.0, 2000.0]))
    assert np.all(np.isfinite(x)) and x[0] < 2000 < x[1]


def test_chi2_cdf_at_its_df_for_large_df():
    """P(a, a) = 1/2 + 1 / (3 sqrt(2 pi a)) + O(a^-1.5)."""
    for df in (1e4, 1e5, 2e5, 1e6, 1e7, 1e8):
        a = df / 2
        assert float(S.chi2_cdf(df, df)) == pytest.approx(0.5 + 1 / (3 * np.sqrt(2 * np.pi * a)), abs=3e-9 if a < 1e5 else 1e-9)
    assert float(S.chi2_ppf(0.025, 1e6)) == pytest.approx(997230.087, abs=0.01)


def test_not_converged_is_an_error():
    with pytest.raises(ArithmeticError):
        S._until(lambda i: False, 10, "test")


def test_t_with_large_df_is_normal():
    assert float(S.t_ppf(0.975, 1e8)) == pytest.approx(1.959964, abs=1e-6)
    assert float(S.t_sf2(2.0, 1e8)) == pytest.approx(0.0455002639, abs=1e-8)


def test_t_two_sided_p():
    assert S.t_sf2(2.5706, 5) == pytest.approx(0.05, abs=1e-4)
    assert S.t_sf2(0.0, 3) == pytest.approx(1.0)


def test_udfs_on_spark(spark):
    df = spark.createDataFrame([(0.975, 5.0), (0.975, 30.0)], "p double, df double")
    got = [r[0] for r in df.select(S.chi2_ppf_udf("p", "df")).collect()]
    assert got == pytest.approx([12.8325, 46.9792], abs=1e-4)


def _t_cdf_by_integration(t, v, steps=20000):
    """Independent check: Simpson integration of the t density from 0."""
    import math
    c = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
    f = lambda x: c * (1 + x * x / v) ** (-(v + 1) / 2)
    h = abs(t) / steps
    s = f(0) + f(abs(t)) + sum((4 if i % 2 else 2) * f(i * h) for i in range(1, steps))
    half = s * h / 3
    return 0.5 + half if t >= 0 else 0.5 - half


def test_t_test_udf_matches_integration(spark):
    import math
    d = [1, -1, 2, 0, 1, 3, -2, 1]
    n = len(d)
    mean = sum(d) / n
    sd = math.sqrt(sum((x - mean) ** 2 for x in d) / (n - 1))
    t = mean / (sd / math.sqrt(n))
    p_expected = 2 * (1 - _t_cdf_by_integration(abs(t), n - 1))
    df = spark.createDataFrame([(mean, sd, float(n))], "m double, s double, n double")
    r = df.select(S.t_test_udf("m", "s", "n").alias("x")).collect()[0].x
    assert r.p_value == pytest.approx(p_expected, abs=1e-6)
    # the half width makes the interval cover 95 %: cdf(q) = 0.975
    q = r.half_width / (sd / math.sqrt(n))
    assert _t_cdf_by_integration(q, n - 1) == pytest.approx(0.975, abs=1e-6)


def test_teammate_delta_non_degenerate(spark):
    """Alternating finishing orders: mean 0 over an even count, p = 1."""
    import datetime
    from stintlake.plans import models as M
    from stintlake.schemas import SCHEMAS
    from stintlake.sources.binding import Star

    res = []
    for r in range(1, 9):
        a, b = (1, 2) if r % 2 else (2, 1)
        res.append((r, 1, 9, 1, 1, a, str(a), a, 0.0, 50, None, 0, 1, 1, None, "", "Finished"))
        res.append((r, 2, 9, 2, 2, b, str(b), b, 0.0, 50, None, 0, 1, 1, None, "", "Finished"))
    star = Star(
        results=spark.createDataFrame(res, SCHEMAS["results"]),
        constructors=spark.createDataFrame([(9, "team", "Team", "x", "")], SCHEMAS["constructors"]),
        drivers=spark.createDataFrame([(1, "a", 1, "AAA", "A", "One", datetime.date(2000, 1, 1), "x", ""),
                                       (2, "b", 2, "BBB", "B", "Two", datetime.date(2000, 1, 1), "x", "")],
                                      SCHEMAS["drivers"]))
    r = M.teammate_delta(star, refs=["team"]).collect()[0]
    assert (r.n, r.mean_delta, r.p_value) == (8, 0.0, 1.0)
    assert r.ci_lower == -r.ci_upper and r.ci_upper > 0
