"""Statistical models on the two-driver fixture (expected values derived
from the fixture by hand)."""

import pytest

from stintlake.plans import models as M
from stintlake.plans import series as K
from tests.fixtures import PIT_MS, model_star


@pytest.fixture(scope="module")
def star(spark):
    return model_star(spark)


def test_teammate_delta_zero_spread(star):
    rows = M.teammate_delta(star, refs=["red_bull"]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.driver_a, r.driver_b) == ("Max Verstappen", "Sergio Perez")
    assert r.mean_delta == -1.0 and r.n == 6
    assert r.p_value == 0.0 and r.ci_lower is None and r.ci_upper is None


def test_teammate_delta_min_shared_races(star):
    assert M.teammate_delta(star, refs=["red_bull"], min_shared_races=7).count() == 0


def test_unknown_team_is_empty(star):
    assert M.teammate_delta(star, refs=["no_such_team"]).count() == 0
    assert M.dnf_rate(star, refs=["no_such_team"], min_races=1).count() == 0
    assert M.grid_finish_ols(star, refs=["no_such_team"]).count() == 0


def test_ols_exact_line(star):
    r = M.grid_finish_ols(star, refs=["red_bull"]).collect()[0]
    assert r.slope == pytest.approx(-1.0) and r.intercept == pytest.approx(3.0)
    assert r.r2 == pytest.approx(1.0) and r.n == 12 and r.p_value == 0.0


def test_dnf_rate_zero(star):
    r = M.dnf_rate(star, refs=["red_bull"], min_races=1).collect()
    assert {x.rate for x in r} == {0.0}
    assert all(x.ci_lower == 0.0 for x in r)
    # upper bound for k = 0 over n = 6: chi2(.975; 2) / 12
    assert r[0].ci_upper == pytest.approx(7.377759 / 12, abs=1e-6)
    assert M.dnf_rate(star, refs=["red_bull"], min_races=999).count() == 0


def test_pit_z_threshold(star):
    z = M.pit_z(star, refs=["red_bull"], min_stops=5).collect()
    assert len(z) == 1 and z[0].n_stops == len(PIT_MS)
    assert abs(z[0].mean_z) < 1e-9  # the team's stops are the whole field
    assert M.pit_z(star, refs=["red_bull"], min_stops=99).count() == 0


def test_two_stints_per_driver(star):
    s = M.stints(star, refs=["red_bull"]).collect()
    per = {}
    for r in s:
        per.setdefault(r.driver_id, []).append((r.stint, r.compound, r.start_lap, r.end_lap, r.stint_laps))
    assert sorted(per[1]) == [(1, "SOFT", 1, 3, 3), (2, "MEDIUM", 4, 5, 2)]
    assert len(per[2]) == 2


def test_degradation_and_sectors_empty(star):
    assert M.tyre_degradation(star, refs=["red_bull"]).count() == 0
    assert M.sector_means(star, refs=["red_bull"]).count() == 0
    assert M.sector_means(star, refs=["red_bull"], min_laps=5).count() == 2


def test_trajectory_rounds(star):
    t = M.trajectory(star, refs=["red_bull"]).collect()
    assert len(t) == 4 and {r.round for r in t} == {1, 2}


def test_round_by_round_running_points(star):
    rows = K.round_by_round(star).filter("driver_id = 1").orderBy("round").collect()
    assert [r.points for r in rows] == [25.0 * i for i in range(1, 7)]


def test_points_gap_and_segments(star):
    rows = K.points_gap(star).orderBy("round").collect()
    assert [r.gap for r in rows] == [7.0 * i for i in range(1, 7)]
    assert {r.segment for r in rows} == {0} and rows[-1].leader == "Verstappen"


def test_kpi_block(star):
    r = K.kpi_block(star, min_races=1).collect()[0]
    assert (r.starts, r.races, r.drivers, r.seasons, r.wins, r.podiums, r.poles) == (12, 6, 2, 1, 6, 12, 6)
    assert r.total_points == 25.0 * 6 + 18.0 * 6 and r.reliability == 100.0
