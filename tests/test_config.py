import pytest

from triplake.config import Lake, QualityRules, next_month, parse_month


@pytest.mark.parametrize("bad", ["2025-13", "2025", "2025-11-01", "abc", "2025-00", ""])
def test_bad_month_bounds_raise(bad):
    with pytest.raises(ValueError):
        parse_month(bad)
    with pytest.raises(ValueError):
        QualityRules(last_month=bad)


def test_month_bounds():
    assert parse_month("2025-11") == (2025, 11)
    assert next_month(2025, 12) == (2026, 1)
    assert QualityRules(last_month="2025-11").upper_bound == (2025, 12)
    assert QualityRules().upper_bound is None


def test_lake_layout():
    lake = Lake("s3://bucket/lake/")
    assert lake.bronze() == "s3://bucket/lake/bronze/tlc_trips_raw"
    assert lake.silver() == "s3://bucket/lake/silver/tlc_trips"
    assert lake.gold("trips_by_month") == "s3://bucket/lake/gold/trips_by_month"
    assert all(isinstance(p, str) for p in (lake.bronze(), lake.silver(), lake.gold("x")))
