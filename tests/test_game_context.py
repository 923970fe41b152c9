"""Contexts of tables under rounds that come late and are told again."""

import random
import time

from stakeflow.operators import game_context

MINUTE, HOUR = 60_000_000, 3_600_000_000
GAMES = "game_id long, table_id long, us long, etl_us long, ts_ms long, outcome string, game_status string, num_players int, total_turnover double, casino_win double"
BETS = "bet_id long, table_id long, us long, seen_us long"


def at(text):
    h, m = text.split(":")[:2]
    return int(h) * HOUR + int(m) * MINUTE


def fixture(spark):
    rows = [
        (100, 10, at("9:00"), at("9:00") + 2_000_000, 1000, "PLAYER", 3, 100.0, 10.0), (100, 10, at("9:00"), at("9:00") + 3_000_000, 2000, "BANKER", 4, 200.0, -5.0),
        (101, 10, at("9:05"), at("9:20"), 3000, "BANKER", 5, 300.0, 20.0), (102, 10, at("9:08"), at("9:08") + 5_000_000, 4000, "PLAYER", 2, 400.0, -10.0),
    ]
    return spark.createDataFrame([(*r[:6], "RESOLVED", *r[6:]) for r in rows], GAMES)


def test_a_late_round_counts_once_it_is_seen(spark):
    """Before 9:20 the round of 9:05 is unknown: one BANKER before 102; then two."""
    games = fixture(spark)
    for seen, streak in (("9:10", 1), ("9:21", 2)):
        bet = spark.createDataFrame([(1, 10, at(seen), at(seen))], BETS)
        assert game_context.game_context(bet.drop("seen_us"), games, at(seen)).first().current_outcome_streak_len == streak
        got = game_context.context_as_seen(bet, games).first()
        assert (got.game_id, got.current_outcome_streak_len) == (102, streak)
    early = spark.createDataFrame([(1, 10, at("9:10"), at("9:21")), (2, 10, at("9:10"), at("9:10")), (3, 10, at("9:00"), at("9:30")), (4, None, 5, 5)], BETS)
    got = {r.bet_id: (r.game_id, r.current_outcome_streak_len) for r in game_context.context_as_seen(early, games).collect()}
    assert got == {1: (102, 2), 2: (102, 1), 3: (None, 0), 4: (None, 0)}  # seen after the bet's time, a strict bound, no table


def test_by_visible_time_the_round_seen_last_counts(spark):
    bets = spark.createDataFrame([(1, 10, at("9:10")), (2, 10, at("9:20")), (3, 10, at("9:21")), (4, 11, at("9:21"))], "bet_id long, table_id long, us long")
    got = {r.bet_id: (r.game_id, r.table_num_players) for r in game_context.game_context(bets, fixture(spark)).collect()}
    assert got == {1: (102, 5), 2: (102, 5), 3: (101, 4), 4: (None, 0)}


def plain(bet, games, reach):
    _, table, us, seen = bet
    newest = {}
    for g in games:
        if g[3] <= seen and (g[0] not in newest or (g[4], g[3]) > (newest[g[0]][4], newest[g[0]][3])):
            newest[g[0]] = g
    line = sorted((g for g in newest.values() if g[6] == "RESOLVED" and g[1] == table and us - reach <= g[2] < us), key=lambda g: (g[2], g[0]))
    if not line:
        return (None, 0, 0.0, 0.0, 0.0, 0, 0, 0.0, 0.0)
    streaks, n, before = [], 0, None
    for g in line:
        n = 0 if g[5] not in game_context.OUTCOMES else n + 1 if g[5] == before else 1
        before = g[5]
        streaks.append(n)
    *past, last = line
    twenty = [g[5] for g in past[-20:]]
    inside = lambda m: [line[i - 1] for i in range(1, len(line)) if line[i][2] > last[2] - m * MINUTE]
    five, fifteen = sum(g[8] for g in inside(5)), sum(g[8] for g in inside(15))
    players = past[-1][7] if past else 0
    shares = [twenty.count(x) / len(twenty) if twenty else 0.0 for x in game_context.OUTCOMES]
    return (last[0], streaks[-2] if past else 0, *shares, players, int(players == 1), min(10.0, five / fifteen) if fifteen else 0.0, float(sum(g[9] for g in inside(15))))


def test_each_bet_sees_the_versions_of_its_moment(spark):
    """Rounds that come up to two hours late, are restated, reopened, and moved to another time or table."""
    r = random.Random(8)
    games = []
    for i in range(300):
        table, us = r.randint(1, 2), r.randint(0, 3000) * MINUTE // 4
        for version in range(r.choice([1, 1, 2, 3])):
            moved = r.random() < 0.1
            games.append((i, r.randint(1, 2) if moved else table, us + (r.randint(-99, 99) * MINUTE if moved else 0), us + r.randint(0, 120) * MINUTE, version, r.choice([*game_context.OUTCOMES, "BANKER", "VOID", ""]), r.choice(["RESOLVED"] * 5 + ["OPEN"]), r.randint(1, 4), float(r.randint(0, 9)), float(r.randint(-9, 9))))
    bets = [(i, r.randint(1, 3), us := r.randint(0, 3000) * MINUTE // 4, us + r.randint(-5, 200) * MINUTE) for i in range(300)]
    for reach in (90 * MINUTE, 48 * HOUR):
        got = {x.bet_id: tuple(x)[1:] for x in game_context.context_as_seen(spark.createDataFrame(bets, BETS), spark.createDataFrame(games, GAMES), reach).collect()}
        for b in bets:
            want = plain(b, games, reach)
            assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(got[b[0]], want)), (b, got[b[0]], want)


def test_a_dense_table_costs_no_pass_over_its_window_a_bet(spark):
    """15,000 rounds of one outcome within 15 minutes, some told again, and a bet after each: rows, and time that passes over windows would take many times over."""
    n = 15_000
    games = [(i, 1, i * 1000, i * 1000, 0, "TIE", "RESOLVED", 2, 1.0, -1.0) for i in range(n)] + [(i, 1, i * 1000, i * 1000 + 5_000_000, 1, "TIE", "RESOLVED", 2, 3.0, 1.0) for i in range(0, n, 3)]
    bets = [(i, 1, i * 1000 + 500, i * 1000 + 500) for i in range(n)]
    b, g = spark.createDataFrame(bets, BETS).cache(), spark.createDataFrame(games, GAMES).cache()
    b.count(), g.count()
    began = time.perf_counter()
    got = {r.bet_id: r for r in game_context.context_as_seen(b, g).collect()}
    assert time.perf_counter() - began < 30
    assert len(got) == n
    for i in range(0, n, 997):
        again = len([x for x in range(0, i, 3) if x * 1000 + 5_000_000 <= i * 1000 + 500])
        r = got[i]
        assert (r.game_id, r.current_outcome_streak_len, r.tie_rate_w20games, r.table_net_outcome_w15m) == (i, i, float(i > 0), 2.0 * again - i)
