from datetime import UTC, datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st

from bucketloom.model import DAY_1, HOUR_1, Granularity, TimeRange, spec_of

T = lambda *a: datetime(*a, tzinfo=UTC)


def test_ranges_are_half_open_and_utc():
    r = TimeRange(T(2024, 1, 1), T(2024, 1, 2))
    assert r.start in r and r.end not in r
    with pytest.raises(ValueError):
        TimeRange(datetime(2024, 1, 1), T(2024, 1, 2))
    with pytest.raises(ValueError):
        TimeRange(T(2024, 1, 2), T(2024, 1, 2))


@given(st.integers(1, 10**7))
def test_halves_tile(us):
    r = TimeRange(T(2024, 1, 1), T(2024, 1, 1) + timedelta(microseconds=us + 1))
    a, b = r.halves()
    assert (a.start, a.end, b.end) == (r.start, b.start, r.end)


def test_granularities():
    for bad in (0, -5, 7, 86_401):
        with pytest.raises(ValueError):
            Granularity("x", bad)
    assert Granularity("w", 7 * 86_400).seconds == 604_800


@given(st.integers(-(10**9), 3 * 10**9))
def test_buckets_hold_their_instants(s):
    t = datetime.fromtimestamp(s, UTC)
    for g in (HOUR_1, DAY_1):
        b = g.bucket(t)
        assert t in b and b.start.timestamp() % g.seconds == 0 and b.seconds == g.seconds


def test_sealed_buckets():
    now, grace = T(2024, 1, 1, 12, 10), timedelta(minutes=10)
    assert HOUR_1.sealed(T(2024, 1, 1, 12), now, grace)
    assert not HOUR_1.sealed(T(2024, 1, 1, 12), now - timedelta(seconds=1), grace)
    found = list(HOUR_1.sealed_buckets(T(2024, 1, 1, 9), now, grace))
    assert [b.start.hour for b in found] == [9, 10, 11]
    assert len(list(HOUR_1.sealed_buckets(T(2024, 1, 1, 9), now, grace, limit=2))) == 2
    assert HOUR_1.cold_start(now, timedelta(hours=24)) == T(2023, 12, 31, 12)


def test_unknown_signal():
    with pytest.raises(ValueError):
        spec_of("profiles")
