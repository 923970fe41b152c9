"""Training and live operators where SQL over the tables doesn't reach: ties, edges, streams in several batches."""

import random

import pytest
from pyspark.sql import functions as F

from stakeflow.operators import cleaning, features, live, profile, ranking, sequence, serving, splits
from stakeflow.streaming import queries as streams

MINUTE = 60_000_000


@pytest.mark.parametrize("seed", [0, 1])
def test_head_counts_are_brute_force_among_ties(spark, seed):
    r = random.Random(seed)
    rows = [(i, r.choice([1, 2]), r.choice([None, -1, 5, 6, 7]), r.choice([0, 1, 59, 60, 61, 100, 101, 400, 1000]) + r.choice([0, 5000])) for i in range(300)]
    df = spark.createDataFrame(rows, "bet_id long, table_id long, player_id long, us long")
    for start, end, cutoff in ((100, 1, None), (100, 60, 1050), (60, 0, None)):
        got = {x.bet_id: x.head_count for x in sequence.table_head_count(df, start, end, bucket=130, cutoff_us=cutoff).collect()}
        for i, t, _, us in rows:
            want = {p for _, t2, p, u in rows if t2 == t and p not in (None, -1) and us - start <= u <= us - end and (cutoff is None or u <= cutoff - end)}
            assert got[i] == len(want), (i, start, end)


def test_quantiles_are_those_of_sorted_values(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None]), r.choice([None, float("nan"), *range(12)])) for _ in range(400)]
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in rows], "g string, v double")
    got = {x.g: x for x in ranking.value_quantiles(df, "v", {"q": 0.3, "top": 1.0}, "g").collect()}
    for g in ("a", "b", None):
        v = sorted(float(x) for k, x in rows if k == g and x is not None and x == x)
        at = 0.3 * (len(v) - 1)
        assert got[g].q == pytest.approx(v[int(at)] + (at - int(at)) * (v[int(at) + 1] - v[int(at)])) and got[g].top == v[-1]
    assert ranking.value_quantiles(df.limit(0), "v", {"q": 0.5}).first().q is None


def test_splits_of_rows_without_an_order_value(spark):
    rows = [(i, None if i % 4 == 0 else i % 5, i) for i in range(40)]
    df = spark.createDataFrame(rows, "bet_id long, us long, canonical_id long")
    got = {x.bet_id: x.split for x in splits.time_ordered_split(df, 0.5, 0.25, ("us", "bet_id")).collect()}
    order = [i for i, *_ in sorted(rows, key=lambda x: (x[1] is None, x[1] or 0, x[0]))]
    assert [got[i] for i in order] == ["train"] * 20 + ["valid"] * 10 + ["test"] * 10
    with pytest.raises(ValueError):
        splits.temporal_split(df.limit(5), 0.5, 0.5)


def test_late_bets_reopen_verdicts(spark):
    alerts = spark.createDataFrame([(i, i, str(i), 100 * MINUTE) for i in (1, 2, 3, 4)], "alert_id long, player_id long, canonical_id string, alert_us long")
    bet = lambda i, p, m: (i, p, m * MINUTE, 1.0)
    schema = "bet_id long, player_id long, us long, wager double"
    early = spark.createDataFrame([bet(1, 1, 100), bet(2, 2, 100), bet(11, 1, 105), bet(12, 2, 105), bet(22, 2, 120), bet(4, 4, 100)], schema)
    now = 150 * MINUTE
    first = {x.alert_id: x.verdict for x in live.validated(alerts, early, now).collect()}
    assert first == {1: "PENDING", 2: "MISS", 3: "PENDING", 4: "PENDING"}  # a pause that isn't final yet, a late bet, no bet at all, the own bet only
    late = early.unionByName(spark.createDataFrame([bet(3, 3, 100), bet(13, 3, 104), bet(33, 3, 130)], schema))
    stored = live.validated(alerts, early, now)
    second = {x.alert_id: x.verdict for x in live.revalidated(stored, alerts, late, now + 11 * MINUTE).collect()}
    assert second[1] == "MATCH" and second[2] == "MISS" and second[3] == "MISS"
    assert live.validated(alerts.limit(0), early, now).count() == 0


def test_results_are_loaded_on_and_again_after_a_reset(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "result_id")
    rows, last, reset = live.results_since(df, 4)
    assert (rows.count(), last, reset) == (6, 10, False)
    rows, last, reset = live.results_since(df.where("result_id <= 3"), last)
    assert (rows.count(), last, reset) == (3, 3, True)


def test_named_functions_are_features(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 2, 90 * 1_000_000), (2, 3, 5)], "canonical_id long, bet_id long, us long")
    declared = [features.Feature("n", "bets_so_far", "function"), features.Feature("gap", "minutes_since_last", "function", fill=-1.0)]
    got = {r.bet_id: (r.n, r.gap) for r in features.add_features(df, declared).collect()}
    assert got == {1: (1.0, -1.0), 2: (2.0, 1.5), 3: (1.0, -1.0)}
    with pytest.raises(ValueError):
        features.validate_features([features.Feature("x", "nothing", "function")], df.columns)


def test_thresholds_age(spark):
    df = spark.createDataFrame([(10, 0.7), (20, 0.8), (30, None), (90, 0.9)], "us long, threshold double")
    one = lambda *a: tuple(serving.effective_threshold(df, 0.5, *a).first())
    assert one(50) == (0.8, "runtime") and one(50, 30) == (0.8, "runtime") and one(50, 29) == (0.5, "bundle") and one(5) == (0.5, "bundle")
    assert tuple(serving.effective_threshold(df.limit(0), 0.5, 5).first()) == (0.5, "bundle")


def test_alert_context_takes_the_greater_of_state_and_batch(spark):
    bets = spark.createDataFrame([(1, 1, 7, 2.0, 5), (2, 1, 7, 3.0, 6)], "bet_id long, session_id long, player_id long, wager double, us long")
    state = spark.createDataFrame([(1, 9, 4.0)], "session_id long, bets long, wager double")
    row = serving.alert_context(bets.select("bet_id", "session_id", "player_id"), bets, state).first()
    assert (row.session_bets, row.session_wager) == (9, 5.0)


def test_scoring_looks_back_eight_hours(spark, tmp_path):
    hour = 60 * MINUTE
    past = spark.createDataFrame([(1, 1, 0, 1.0), (2, 1, 5 * hour, 1.0)], "bet_id long, player_id long, us long, wager double")
    spark.createDataFrame([(3, 1, 9 * hour, 1.0)], past.schema).write.parquet(f"{tmp_path}/in")
    seen = []

    def score(df):
        seen.append(sorted(r.bet_id for r in df.collect()))
        return df.withColumns({"score": F.lit(0.9), "is_rated": F.lit(True)})

    mapping = spark.createDataFrame([(1, "a")], "player_id long, canonical_id string")
    q = streams.score_batches(streams.stream_table(spark, f"{tmp_path}/in", past.schema), score, lambda: past, lambda: mapping, lambda: 0.5, lambda: 0, f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination()
    assert seen[0] == [2, 3] and [r.bet_id for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [3]


def test_upserts_keep_two_versions(spark, tmp_path):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, 5), (1, 7)], "k long, v long")
    for v in (2, 3, 5, 7):
        df.where(F.col("v") == v).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    rows = streams.stream_table(spark, f"{tmp_path}/in", df.schema, files_per_batch=1)
    streams.upsert_stream(rows, f"{tmp_path}/t", "k", {"v": "sum"}, f"{tmp_path}/cp").awaitTermination()
    versions = sorted(p.name for p in (tmp_path / "t").glob("version=*"))
    assert len(versions) == 2
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/t/{versions[-1]}").collect()) == [(1, 12), (2, 5)]


def test_profiles_of_snapshots_at_any_time_of_the_day(spark):
    """Against a plain filter for each snapshot and window."""
    day, r = profile.DAY, random.Random(5)
    rows = [(str(r.randrange(3)), t, t - 30 * MINUTE if r.random() < 0.8 else None, r.choice([None, 1, 2, 3]), float(r.randrange(50)), float(r.randrange(-5, 5))) for t in (r.randrange(0, 120 * day) for _ in range(200))]
    df = spark.createDataFrame(rows, "canonical_id string, session_us long, start_us long, table_id long, turnover double, player_win double")
    df = df.withColumns({"end_us": F.when(F.col("start_us").isNotNull(), F.col("session_us")), "session_date": F.to_date(F.timestamp_micros("session_us")), "num_games_with_wager": F.lit(3)})
    snaps = [60 * day, 60 * day + 5 * MINUTE, 119 * day + 7 * MINUTE]
    got = {(x.snapshot_us, x.canonical_id): x for x in profile.player_profile(df, spark.createDataFrame([(s,) for s in snaps], "snapshot_us long"), reach_days=100).collect()}
    for s in snaps:
        for c in "012":
            mine = [x for x in rows if x[0] == c and s - 100 * day <= x[1] + 7 * MINUTE <= s]
            if not mine:
                assert (s, c) not in got
                continue
            near = [x for x in mine if x[1] >= s - 30 * day]
            x = got[s, c]
            assert (x.sessions_30d, x.distinct_table_cnt_30d, x.active_days_30d) == (len(near), len({y[3] for y in near} - {None}), len({y[1] // day for y in near}))
            assert (x.turnover_sum_30d or 0.0) == sum(y[4] for y in near)
            if near and sum(y[4] for y in near):
                top = max(sum(y[4] for y in near if y[3] == t) for t in {y[3] for y in near})
                assert x.top_table_share_30d == pytest.approx(top / sum(y[4] for y in near))


def test_rules_touch_rows_as_they_came(spark):
    df = spark.createDataFrame([(1, 0, 500_000_000), (2, 0, None), (3, 0, 1)], "bet_id long, us long, etl_us long")
    kept, out = cleaning.apply_rules(df, [cleaning.RowRule("b", "etl_us > 400000000", "exclude"), cleaning.RowRule("a", "etl_us is not null", "cap", priority=-1)])
    assert [(r.bet_id, r.observed_us, r.rule_ids) for r in kept.orderBy("bet_id").collect()] == [(2, None, []), (3, 1, ["a"])]
    assert [(r.bet_id, r.observed_us, r.rule_ids) for r in out.collect()] == [(1, 122_000_000, ["a", "b"])]
    assert all(cleaning.apply_rules(df)[0].columns == kept.columns for _ in range(1))


def test_windows_and_columns_reach_the_scan(spark):
    from stakeflow.sources import tables
    from tests.conftest import SF

    df = tables.scan_window(spark.read.parquet(f"{SF}/events.parquet"), "ts", "2024-01-08", "2024-01-20", ["event_id", "value"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan and "props" not in plan.split("ReadSchema")[1]


def test_plans_have_neither_nested_loops_nor_exact_percentiles(spark):
    from stakeflow.plans import registry
    from tests.conftest import SF

    for name in ("a1_player_profile", "j15_profile_asof", "a20_feature_stats", "a9_ingest_delay"):
        plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert "percentile" not in plan and "NestedLoop" not in plan.replace("BroadcastNestedLoopJoin BuildRight, Cross", ""), name


def test_schema_differences(spark):
    from stakeflow.operators import audit

    a, b = spark.range(1).selectExpr("id", "1 AS x"), spark.range(1).selectExpr("id", "1 AS y")
    assert audit.schema_diff(a, b) == {"only_left": ["x"], "only_right": ["y"], "common": ["id"]}


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from stakeflow.sources.materialise import shared_folder

    unset = SimpleNamespace(isDefined=lambda: False)
    sc = SimpleNamespace(master="spark://far:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset)))
    with pytest.raises(ValueError):
        shared_folder(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))
