"""Profiles of every day by events against profiles by copies of each day's sums."""

import random

from stakeflow.operators import profile

DAY, HOUR = profile.DAY, 60 * profile.MINUTE
ROWS = "canonical_id string, session_us long, start_us long, end_us long, turnover double, player_win double, theo_win double, num_games_with_wager int, table_id long, pit_id long, gaming_area string"


def sessions(spark, seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        us = r.randint(0, 500) * DAY + r.choice([0, 1, HOUR, 23 * HOUR + 55 * profile.MINUTE, r.randint(0, DAY - 1)])
        rows.append((r.choice("aabcd"), us, us - r.randint(1, 300) * profile.MINUTE, us if r.random() < 0.8 else None, round(r.random() * 900, 2) if r.random() < 0.8 else 0.0, float(r.randint(-90, 90)), round(r.random(), 4), r.randint(0, 3), r.choice([None, 1, 2, 3]), r.choice([None, 1, 2]), r.choice([None, "x", "y"])))
    return spark.createDataFrame(rows, ROWS).withColumn("session_date", profile.F.to_date(profile.F.timestamp_micros("session_us")))


def by_key(df):
    rows = [r.asDict() for r in df.collect()]
    return {(r["snapshot_us"], r["canonical_id"]): {k: None if v is None else round(v, 6) for k, v in r.items() if k not in ("canonical_id", "snapshot_us")} for r in rows}


def test_backfill_is_the_profile_of_each_snapshot(spark):
    df = sessions(spark, 3, 160)
    snaps = [d * DAY for d in range(0, 900, 9)] + [d * DAY + 6 * HOUR for d in range(3, 700, 31)]
    times = spark.createDataFrame([(x,) for x in snaps], "snapshot_us long")
    got, want = by_key(profile.profile_backfill(df, times, max_lookback_days=180)), by_key(profile.player_profile(df, times, max_lookback_days=180))
    assert set(got) == set(want) and len(got) > 200
    for k in want:
        assert got[k] == want[k], (k, {c: (got[k][c], want[k][c]) for c in want[k] if got[k][c] != want[k][c]})


def test_backfill_of_nothing(spark):
    df = sessions(spark, 3, 5)
    assert profile.profile_backfill(df, spark.createDataFrame([], "snapshot_us long")).count() == 0
    assert profile.profile_backfill(df.limit(0), spark.createDataFrame([(DAY,)], "snapshot_us long")).count() == 0


def test_top_table_forgets_tables_that_left():
    rows = profile.pd.DataFrame({"canonical_id": ["a"] * 3, "table": ["x", None, "y"], "known": [1, 2, 40], "day": [0, 1, 39], "turnover": [50, 70, 10]})
    got = {r.s: (r.t30, r.t90) for r in profile._top_tables(rows).itertuples()}
    assert got[1] == (50, 50) and got[2] == (70, 70) and got[40] == (10, 70) and got[31][0] == 70 and profile.pd.isna(got[32][0])
