"""The backfill puts down only the sessions that a snapshot may see, once, and tells the same profiles from them."""

import pytest

from stakeflow.operators import profile
from tests.test_backfill import DAY, HOUR, by_key, sessions


@pytest.mark.parametrize("days", [(420, 421, 427), (40, 44), (890,)])
def test_sessions_that_no_snapshot_sees_go(spark, monkeypatch, days):
    seen, plain = [], profile.written
    monkeypatch.setattr(profile, "written", lambda df: seen.append(out := plain(df)) or out)
    df = sessions(spark, 5, 250)
    times = spark.createDataFrame([(d * DAY + 6 * HOUR,) for d in days], "snapshot_us long")
    got, want = by_key(profile.profile_backfill(df, times)), by_key(profile.player_profile(df, times))
    assert got == want and (len(got) > 0 or days == (890,))
    assert len(seen) == 1 and seen[0].where(f"known > {max(days)} or late < {min(days) - 366}").count() == 0
    assert 0 <= seen[0].count() < df.count()
