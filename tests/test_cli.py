"""Command line and settings helpers."""

from stintlake.__main__ import main
from stintlake.session import scale_settings


def test_list_names(capsys):
    assert main(["list"]) == 0
    names = capsys.readouterr().out.split()
    assert "team_performance_overview" in names and "quality_report" in names


def test_list_describe(capsys):
    assert main(["list", "--describe"]) == 0
    lines = [l for l in capsys.readouterr().out.splitlines() if l.strip()]
    assert all(len(l.split(None, 1)) == 2 for l in lines)  # every entry has a summary


def test_scale_settings():
    s = scale_settings(100 * (1 << 40), 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 819200
    assert s["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_settings(1 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # at least two waves over the cores
