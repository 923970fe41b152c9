"""Registered queries do the whole job: every row, id and day of the tables."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stakeflow.operators import features, sequence, splits
from stakeflow.plans import registry
from stakeflow.sources.materialise import shared_folder
from stakeflow.streaming import queries as streams
from tests.conftest import SF


def test_profile_asof_looks_up_every_order(spark):
    orders = [r.o_orderkey for r in spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey").collect()]
    got = [r.row_id for r in registry.QUERIES["j15_profile_asof_all"](spark, SF).select("row_id").collect()]
    assert sorted(got) == sorted(orders)


def test_missing_days_of_every_id(spark):
    day = lambda n: date(2026, 1, n)
    rows = [("a", day(1)), ("a", day(3)), ("a", day(3)), ("b", day(2)), (None, day(4)), ("c", None)]
    got = [(r.canonical_id, r.day.day) for r in splits.missing_snapshots_by_id(spark.createDataFrame(rows, "canonical_id string, day date")).collect()]
    assert sorted(got) == [("a", 2), ("a", 4), ("b", 1), ("b", 3), ("b", 4), *[("c", n) for n in (1, 2, 3, 4)]]


def test_missing_snapshots_query_covers_all_users(spark):
    have = {(str(r.user_id), r.ts.date()) for r in spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts").collect()}
    lo, hi = min(d for _, d in have), max(d for _, d in have)
    want = {(i, lo + timedelta(n)) for i, _ in have for n in range((hi - lo).days + 1)} - have
    got = [(r.canonical_id, r.day) for r in registry.QUERIES["o13_missing_snapshots_all"](spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len({i for i, _ in want}) > 1


@pytest.mark.parametrize("name", ["t3_dedup_stream", "t4_session_totals_stream", "t5_runs_stream"])
def test_streams_stay_out_of_the_driver(spark, name):
    got = registry.QUERIES[name](spark, SF)
    files = got.inputFiles()
    where = shared_folder(spark).removeprefix("file:")
    assert files and all(f.removeprefix("file://").startswith(where) for f in files)
    assert not spark.catalog.tableExists(name)


def test_stored_streams_of_several_batches_and_of_none(spark, tmp_path):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, 5)], "k long, v long")
    for v in (2, 3, 5):
        df.where(F.col("v") == v).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = lambda: streams.stream_table(spark, f"{tmp_path}/in", df.schema, files_per_batch=1)
    total = lambda d: d.groupBy("k").agg(F.sum("v").alias("v"))
    rows = lambda d: sorted((r.k, r.v) for r in d.collect())
    assert rows(streams.stored(stream())) == [(1, 2), (1, 3), (2, 5)]
    assert rows(streams.stored(total(stream()), "complete")) == [(1, 5), (2, 5)]
    (tmp_path / "none").mkdir()
    none = lambda: streams.stream_table(spark, f"{tmp_path}/none", df.schema)
    assert rows(streams.stored(none())) == [] and rows(streams.stored(total(none()), "complete")) == []


@pytest.mark.parametrize("far", [0, 4 * 10**15])
def test_frames_stop_at_the_row_among_many_ties(spark, far):
    """Also where longs don't hold the steps, by a row ``far`` ahead; and none a microsecond outside the window."""
    width = 5 * features.MINUTE
    times = [(0, 3), (1, 1), (width, 2), (width + 1, 1300), *([(far, 1)] if far else [])]
    us = [t for t, n in times for _ in range(n)]
    df = spark.createDataFrame([(1, i, t, 1.0) for i, t in enumerate(us)], "session_id long, bet_id long, us long, wager double")
    declared = [features.Feature("n", "count(bet_id)", "window", 5), features.Feature("first", "min(bet_id)", "window", 5)]
    got = {r.bet_id: r for r in sequence.session_windows(features.add_features(df, declared, key="session_id"), (5,), (5,)).collect()}
    assert len(got) == len(us)
    for i, t in enumerate(us):
        first = next(k for k, x in enumerate(us) if x >= t - width)
        assert (got[i].n, got[i].first, got[i].bets_last_5, got[i].wager_last_5) == (i - first + 1, first, i - first + 1, i - first + 1.0)


def test_game_timeline_stops_at_the_round_among_many_ties(spark):
    n, late = 1100, 5 * features.MINUTE
    rows = [(1, i, 0, "TIE", 1, 1.0, 1.0) for i in range(n)] + [(1, n, 1, "TIE", 1, 1.0, 1.0), (1, n + 1, late, "TIE", 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "table_id long, game_id long, us long, outcome string, num_players int, total_turnover double, casino_win double")
    got = {r.game_id: r for r in features.game_timeline(df).collect()}
    assert [got[i].table_net_outcome_w15m for i in range(n + 2)] == [float(i) for i in range(n + 2)]
    assert got[n + 1].table_turnover_w5m_over_w15m == 2 / (n + 1)


def test_game_timeline_sums_run_on_and_end_less_than_their_width_before_the_round(spark, capsys):
    """Sums of 5 and 15 minutes over many rounds of one time, on both sides of spans and before 1970; no RANGE frame, whose rows are added up for each round."""
    import random

    from stakeflow.operators import features

    r, minute = random.Random(5), 60_000_000
    rows = [(i, i % 2, r.choice([r.randint(-40, 40) * minute, r.randint(-8, 8) * 5 * minute + r.choice([-1, 0, 1])]), r.choice(["TIE", "VOID"]), 1, None if r.random() < 0.1 else float(r.randint(0, 9)), float(r.randint(-9, 9))) for i in range(400)]
    line = features.game_timeline(spark.createDataFrame(rows, "game_id long, table_id long, us long, outcome string, num_players int, total_turnover double, casino_win double"))
    got = {x.game_id: x for x in line.collect()}
    for table in (0, 1):
        own = sorted((x for x in rows if x[1] == table), key=lambda x: (x[2], x[0]))
        for k, x in enumerate(own):
            within = lambda m: [own[j - 1] for j in range(1, k + 1) if own[j][2] > x[2] - m * minute]
            five, fifteen = (sum(y[5] or 0.0 for y in within(m)) for m in (5, 15))
            assert abs(got[x[0]].table_turnover_w5m_over_w15m - (five / fifteen if fifteen else 0.0)) < 1e-9
            assert got[x[0]].table_net_outcome_w15m == sum(y[6] for y in within(15))
    line.explain(True)
    assert "RangeFrame" not in capsys.readouterr().out
