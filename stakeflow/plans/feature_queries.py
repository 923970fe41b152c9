"""Queries of declared features, game context and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.operators import asof, dedup, features, game_context, identity, profile
from stakeflow.plans.adapters import BETS, DAY, GAMES, MINUTE, bets, games, sessions
from stakeflow.plans.sequence_queries import CUTOFF, MAPPING

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str = ""):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


#: A declared minute is an hour of the test tables.
UNIT = 60 * MINUTE
SHOWN = [f.id for f in features.BET_FEATURES if f.id not in ("prev_us", "wager_10_before", "prev_status")]


def _near(m: int) -> str:
    return f"FILTER (b.us >= a.us - {m * UNIT})"


DECLARED = f"""WITH {BETS}, near AS (SELECT a.bet_id, count(*) {_near(5)} AS b5, count(*) {_near(15)} AS b15, count(*) AS b30, sum(b.wager) AS s30, avg(b.wager) {_near(15)} AS a15, avg(b.wager) {_near(5)} AS a5, max(b.wager) {_near(15)} AS m15, coalesce(stddev_samp(b.wager) {_near(15)}, 0.0) AS sd15,
  {", ".join(f"count(*) FILTER (b.us >= a.us - {15 * UNIT} AND b.status = '{x}') AS {n}" for x, n in (("LOSE", "l15"), ("WIN", "n15"), ("PUSH", "p15")))}, avg(b.payout_odds) {_near(15)} AS o15, min(b.position_idx) AS p0, max(b.position_idx) AS p1
  FROM bets a JOIN bets b ON a.player_id = b.player_id AND b.us >= a.us - {30 * UNIT} AND (b.us < a.us OR b.us = a.us AND b.bet_id <= a.bet_id) GROUP BY a.bet_id),
f AS (SELECT *, us - lag(us) OVER o AS gone, count(*) OVER u AS cb, sum(wager) OVER u AS cw, lag(wager, 10) OVER o AS w10, lag(wager) OVER o AS pw, lag(status) OVER o AS ps, sum(is_back_bet) OVER r20 AS bb, count(*) OVER r20 AS b20
  FROM bets JOIN near USING (bet_id) WINDOW o AS (PARTITION BY player_id ORDER BY us, bet_id), u AS (PARTITION BY player_id ORDER BY us, bet_id ROWS UNBOUNDED PRECEDING), r20 AS (PARTITION BY player_id ORDER BY us, bet_id ROWS 20 PRECEDING))
SELECT bet_id, b5::DOUBLE AS bets_cnt_w5m, b15::DOUBLE AS bets_cnt_w15m, b30::DOUBLE AS bets_cnt_w30m, least(1.0, b5 / b30) AS pace_drop_ratio, least(2.0, b15 / b30) AS pace_drop_ratio_w15m_w30m, greatest(0.0, least(10080.0, coalesce(gone / 60000000, 0.0))) AS prev_bet_gap_min,
  s30 AS wager_sum_w30m, a15 AS wager_avg_w15m, a5 AS wager_avg_w5m, m15 AS wager_max_w15m, sd15 AS wager_std_w15m, least(10.0, coalesce(a5 / nullif(a15, 0), 0.0)) AS wager_w5m_over_w15m, cb::DOUBLE AS cum_bets, cw AS cum_wager, cw / cb AS avg_wager_sofar, least(10.0, coalesce(a5 / nullif(cw / cb, 0), 0.0)) AS wager_recent_vs_session_avg,
  coalesce((wager - w10) / 10, 0.0) AS wager_slope_w10bets, coalesce(pw, 0.0) AS prev_wager, CASE WHEN ps = 'LOSE' THEN 1.0 ELSE 0.0 END::DOUBLE AS prev_bet_was_loss, l15::DOUBLE AS lose_cnt_w15m, n15::DOUBLE AS win_cnt_w15m, p15::DOUBLE AS push_cnt_w15m, n15 / b15 AS win_rate_w15m, (l15 + p15) / b15 AS non_win_rate_w15m,
  o15::DOUBLE AS avg_payout_odds_w15m, bb::DOUBLE AS back_bet_cnt_w20, b20::DOUBLE AS bets_cnt_w20, bb / b20 AS back_bet_pct_w20, p0::DOUBLE AS position_min_w30m, p1::DOUBLE AS position_max_w30m, CASE WHEN p0 <> p1 THEN 1.0 ELSE 0.0 END::DOUBLE AS position_moved_w30m
FROM f"""
DECLARED = f"SELECT bet_id, {', '.join(f'round({c}, 9) + 0 AS {c}' for c in SHOWN)} FROM ({DECLARED})"


@query(DECLARED)
def w8_declared_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.add_features(bets(spark, sf_dir), features.BET_FEATURES, key="player_id", unit=UNIT)
    return df.select("bet_id", *[(F.round(F.col(c).cast("double"), 9) + 0).alias(c) for c in SHOWN])


def timeline_sql(rounds: str) -> str:
    """Lines of the newest versions of a table of rounds."""
    return f"""g AS (SELECT * FROM (SELECT * FROM {rounds} QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY ts_ms DESC) = 1) WHERE game_status = 'RESOLVED'),
c AS (SELECT *, CASE WHEN outcome = 'VOID' OR lag(outcome) OVER o IS NULL OR lag(outcome) OVER o <> outcome THEN 1 ELSE 0 END AS ch, lag(total_turnover) OVER o AS lt, lag(casino_win) OVER o AS lw FROM g WINDOW o AS (PARTITION BY table_id ORDER BY us, game_id)),
d AS (SELECT *, sum(ch) OVER (PARTITION BY table_id ORDER BY us, game_id ROWS UNBOUNDED PRECEDING) AS grp FROM c),
s AS (SELECT *, CASE WHEN outcome = 'VOID' THEN 0 ELSE count(*) OVER (PARTITION BY table_id, grp ORDER BY us, game_id ROWS UNBOUNDED PRECEDING) END AS streak FROM d),
near AS (SELECT a.game_id, sum(b.lt) FILTER (b.us > a.us - {5 * UNIT}) AS t5, sum(b.lt) AS t15, sum(b.lw) AS n15 FROM c a JOIN c b ON a.table_id = b.table_id AND b.us > a.us - {15 * UNIT} AND (b.us < a.us OR b.us = a.us AND b.game_id <= a.game_id) GROUP BY a.game_id),
line AS (SELECT table_id, game_id, us, CAST(coalesce(lag(streak) OVER o, 0) AS BIGINT) AS current_outcome_streak_len,
  {", ".join(f"coalesce(avg(CASE WHEN outcome = '{x}' THEN 1.0 ELSE 0.0 END) OVER l20, 0.0)::DOUBLE AS {x.lower()}_rate_w20games" for x in ("BANKER", "PLAYER", "TIE"))},
  coalesce(lag(num_players) OVER o, 0) AS table_num_players, CASE WHEN coalesce(lag(num_players) OVER o, 0) = 1 THEN 1 ELSE 0 END AS patron_is_sole_player,
  greatest(0.0, least(10.0, coalesce(t5 / nullif(t15, 0.0), 0.0))) AS table_turnover_w5m_over_w15m, greatest(-1e9, least(1e9, coalesce(n15, 0.0))) AS table_net_outcome_w15m
  FROM s JOIN near USING (game_id) WINDOW o AS (PARTITION BY table_id ORDER BY us, game_id), l20 AS (PARTITION BY table_id ORDER BY us, game_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))"""


TIMELINE = f"{GAMES}, {timeline_sql('games')}"
GAME_OUT = "current_outcome_streak_len, round(banker_rate_w20games, 6) AS banker_rate_w20games, round(player_rate_w20games, 6) AS player_rate_w20games, round(tie_rate_w20games, 6) AS tie_rate_w20games, table_num_players, patron_is_sole_player, round(table_turnover_w5m_over_w15m, 6) AS table_turnover_w5m_over_w15m, round(table_net_outcome_w15m, 4) + 0 AS table_net_outcome_w15m"


@query(f"WITH {TIMELINE} SELECT game_id, {GAME_OUT} FROM line")
def w10_game_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = features.game_timeline(dedup.resolved_games(games(spark, sf_dir)), UNIT)
    return line.selectExpr("game_id", *[x.strip() for x in _split(GAME_OUT)])


def _split(text: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(cur)
            cur = ""
        else:
            cur += c
    return [*out, cur]


@query(f"""WITH {BETS}, {TIMELINE}, r AS (SELECT * EXCLUDE (us), us AS game_us FROM line QUALIFY row_number() OVER (PARTITION BY table_id, us ORDER BY game_id DESC) = 1)
SELECT bet_id, game_id, current_outcome_streak_len, table_num_players FROM bets b ASOF LEFT JOIN r ON b.table_id = r.table_id AND b.us > r.game_us""")
def j16_game_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = features.game_timeline(dedup.resolved_games(games(spark, sf_dir)), UNIT).withColumnRenamed("us", "game_us")
    return asof.asof_join(bets(spark, sf_dir).select("bet_id", "table_id", "us"), line, "table_id", "us", "game_us", strict=True, tie="game_id", bucket=DAY // 24).select("bet_id", "game_id", "current_outcome_streak_len", "table_num_players")


#: Restated rounds become visible two hours after their first version.
SEEN_GAMES = f"""{GAMES}, told AS (SELECT * REPLACE (etl_us + (ts_ms - us // 1000) * {120 * MINUTE} AS etl_us) FROM games)"""


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games(spark, sf_dir).withColumn("etl_us", F.col("etl_us") + (F.col("ts_ms") - F.floor(F.col("us") / 1000)) * (120 * MINUTE))


@query(f"""WITH {BETS}, {SEEN_GAMES}, {timeline_sql("told")},
r AS (SELECT line.* EXCLUDE (us), told.etl_us AS seen FROM line JOIN (SELECT game_id, etl_us FROM told QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY ts_ms DESC) = 1) told USING (game_id) QUALIFY row_number() OVER (PARTITION BY table_id, told.etl_us ORDER BY game_id DESC) = 1)
SELECT bet_id, game_id, coalesce(current_outcome_streak_len, 0) AS current_outcome_streak_len, coalesce(table_num_players, 0) AS table_num_players, round(coalesce(table_net_outcome_w15m, 0), 4) + 0 AS table_net_outcome_w15m FROM bets b ASOF LEFT JOIN r ON b.table_id = r.table_id AND b.us > r.seen""")
def j16_context_by_visible_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = game_context.game_context(bets(spark, sf_dir).select("bet_id", "table_id", "us"), _told(spark, sf_dir), unit=UNIT, bucket=DAY // 24)
    return out.select("bet_id", "game_id", "current_outcome_streak_len", "table_num_players", (F.round("table_net_outcome_w15m", 4) + 0).alias("table_net_outcome_w15m"))


@query(f"""WITH {BETS}, {SEEN_GAMES},
v AS (SELECT b.bet_id, b.us AS t, g.* FROM bets b JOIN told g ON g.table_id = b.table_id AND g.etl_us <= b.etl_us AND g.us < b.us AND g.us >= b.us - {2 * DAY} QUALIFY row_number() OVER (PARTITION BY b.bet_id, g.game_id ORDER BY g.ts_ms DESC, g.etl_us DESC) = 1),
c AS (SELECT *, CASE WHEN outcome = 'VOID' OR lag(outcome) OVER o IS NULL OR lag(outcome) OVER o <> outcome THEN 1 ELSE 0 END AS ch, lag(total_turnover) OVER o AS lt, lag(casino_win) OVER o AS lw, last_value(us) OVER (PARTITION BY bet_id ORDER BY us, game_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS top FROM v WHERE game_status = 'RESOLVED' WINDOW o AS (PARTITION BY bet_id ORDER BY us, game_id)),
d AS (SELECT *, sum(ch) OVER (PARTITION BY bet_id ORDER BY us, game_id ROWS UNBOUNDED PRECEDING) AS grp FROM c),
s AS (SELECT *, CASE WHEN outcome = 'VOID' THEN 0 ELSE count(*) OVER (PARTITION BY bet_id, grp ORDER BY us, game_id ROWS UNBOUNDED PRECEDING) END AS streak,
  sum(lt) FILTER (us > top - {5 * UNIT}) OVER w AS t5, sum(lt) FILTER (us > top - {15 * UNIT}) OVER w AS t15, sum(lw) FILTER (us > top - {15 * UNIT}) OVER w AS n15 FROM d WINDOW w AS (PARTITION BY bet_id)),
l AS (SELECT bet_id, game_id, lag(streak) OVER o AS st, {", ".join(f"avg(CASE WHEN outcome = '{x}' THEN 1.0 ELSE 0.0 END) OVER l20 AS {x.lower()}" for x in ("BANKER", "PLAYER", "TIE"))}, lag(num_players) OVER o AS np, t5, t15, n15
  FROM s WINDOW o AS (PARTITION BY bet_id ORDER BY us, game_id), l20 AS (PARTITION BY bet_id ORDER BY us, game_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) QUALIFY row_number() OVER (PARTITION BY bet_id ORDER BY us DESC, game_id DESC) = 1)
SELECT bets.bet_id, l.game_id, CAST(coalesce(st, 0) AS BIGINT) AS current_outcome_streak_len, {", ".join(f"round(coalesce({x}, 0.0), 6)::DOUBLE AS {x}_rate_w20games" for x in ("banker", "player", "tie"))}, CAST(coalesce(np, 0) AS INT) AS table_num_players, CAST(coalesce(np, 0) = 1 AS INT) AS patron_is_sole_player,
  round(greatest(0.0, least(10.0, coalesce(t5 / nullif(t15, 0.0), 0.0))), 6) AS table_turnover_w5m_over_w15m, round(greatest(-1e9, least(1e9, coalesce(n15, 0.0))), 4) + 0 AS table_net_outcome_w15m FROM bets LEFT JOIN l USING (bet_id)""")
def j16_context_as_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = game_context.context_as_seen(bets(spark, sf_dir).withColumn("seen_us", F.col("etl_us")), _told(spark, sf_dir), unit=UNIT)
    return got.select("bet_id", "game_id", "current_outcome_streak_len", *[F.round(f"{x}_rate_w20games", 6).alias(f"{x}_rate_w20games") for x in ("banker", "player", "tie")], "table_num_players", "patron_is_sole_player", F.round("table_turnover_w5m_over_w15m", 6).alias("table_turnover_w5m_over_w15m"), (F.round("table_net_outcome_w15m", 4) + 0).alias("table_net_outcome_w15m"))


#: Snapshots of quarters.
SNAPS = [CUTOFF + q * 91 * DAY for q in range(-3, 1)]
#: SQL of a measure of a window, which stands for the braces.
_MEASURES = {
    "sessions": "count(*) {}::DOUBLE", "active_days": "count(DISTINCT session_date) {}::DOUBLE", "turnover_sum": "sum(turnover) {}", "player_win_sum": "sum(player_win) {}::DOUBLE", "theo_win_sum": "sum(theo_win) {}", "num_bets_sum": "CAST(sum(0) {} AS DOUBLE)",
    "num_games_with_wager_sum": "CAST(sum(num_games_with_wager) {} AS DOUBLE)", "win_session_rate": "avg(CASE WHEN player_win > 0 THEN 1.0 ELSE 0.0 END) {}::DOUBLE", "avg_session_duration_min": "CAST(avg(CASE WHEN end_us IS NOT NULL THEN (session_us - start_us) / 60000000 END) {} AS DOUBLE)",
    "distinct_table_cnt": "count(DISTINCT table_id) {}::DOUBLE", "distinct_pit_cnt": "count(DISTINCT pit_id) {}::DOUBLE", "distinct_gaming_area_cnt": "CAST(count(*) {} * 0 AS DOUBLE)",
}
def profile_sql(snaps: list[int]) -> str:
    return f"""{MAPPING}, base AS (SELECT latest.*, m.canonical_id, coalesce(end_us, lud_us) AS session_us, CAST(make_timestamp(coalesce(end_us, lud_us)) AS DATE) AS session_date
  FROM latest JOIN mapping m USING (player_id) WHERE is_manual = 0 AND is_deleted = 0 AND is_canceled = 0 AND (turnover > 0 OR num_games_with_wager > 0)),
put AS (SELECT base.*, s.snap AS snapshot_us FROM base JOIN (VALUES {", ".join(f"({s})" for s in snaps)}) s(snap) ON session_us + 420000000 <= snap AND session_us + 420000000 >= snap - {366 * DAY}),
tbl AS (SELECT snapshot_us, canonical_id, max(a) AS t90, max(b) AS t30 FROM (SELECT snapshot_us, canonical_id, table_id, sum(turnover) FILTER (session_us >= snapshot_us - {90 * DAY}) AS a, sum(turnover) FILTER (session_us >= snapshot_us - {30 * DAY}) AS b FROM put GROUP BY ALL) GROUP BY ALL),
plain AS (SELECT snapshot_us, canonical_id, (CAST(make_timestamp(snapshot_us) AS DATE) - max(session_date))::DOUBLE AS days_since_last_session, (CAST(make_timestamp(snapshot_us) AS DATE) - min(session_date))::DOUBLE AS days_since_first_session,
  {", ".join(f"{_MEASURES[name].format(f'FILTER (session_us >= snapshot_us - {d * DAY})')} AS {name}_{d}d" for name, days in profile.WINDOWS.items() for d in days)}, 0.0::DOUBLE AS distinct_none FROM put GROUP BY snapshot_us, canonical_id HAVING sum(num_games_with_wager) > 1),
prof AS (SELECT plain.* EXCLUDE (distinct_none), turnover_sum_30d / nullif(num_bets_sum_30d, 0) AS turnover_per_bet_mean_30d, turnover_sum_180d / nullif(num_bets_sum_180d, 0) AS turnover_per_bet_mean_180d, 1 + player_win_sum_30d / nullif(turnover_sum_30d, 0) AS actual_rtp_30d, 1 + player_win_sum_180d / nullif(turnover_sum_180d, 0) AS actual_rtp_180d,
  player_win_sum_30d / nullif(theo_win_sum_30d, 0) AS actual_vs_theo_ratio_30d, turnover_sum_30d / nullif(turnover_sum_180d, 0) AS turnover_30d_over_180d, sessions_30d / nullif(sessions_180d, 0) AS sessions_30d_over_180d, sessions_7d / nullif(sessions_30d, 0) AS sessions_7d_over_30d, active_days_30d / nullif(sessions_30d, 0) AS active_days_per_session_30d,
  t30 / nullif(turnover_sum_30d, 0) AS top_table_share_30d, t90 / nullif(turnover_sum_90d, 0) AS top_table_share_90d, (turnover_sum_30d / nullif(num_bets_sum_30d, 0)) / nullif(turnover_sum_180d / nullif(num_bets_sum_180d, 0), 0) AS turnover_per_bet_30d_over_180d FROM plain JOIN tbl USING (snapshot_us, canonical_id))"""


PROFILE_SQL = profile_sql(SNAPS)


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions(spark, sf_dir)
    rows = profile.profile_sessions(s, identity.canonical_mapping(s, CUTOFF))
    return profile.player_profile(rows, spark.createDataFrame([(x,) for x in SNAPS], "snapshot_us long"))


@query(f"WITH {PROFILE_SQL} SELECT snapshot_us, canonical_id, round(COLUMNS(* EXCLUDE (snapshot_us, canonical_id)), 4) + 0 FROM prof")
def a1_player_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _profiles(spark, sf_dir)
    return p.select("snapshot_us", "canonical_id", *[(F.round(c, 4) + 0).alias(c) for c in p.columns if c not in ("snapshot_us", "canonical_id")])


#: Every day of a year.
DAYS = [CUTOFF - d * DAY for d in range(365)]


@query(f"WITH {profile_sql(DAYS)} SELECT snapshot_us, canonical_id, round(COLUMNS(* EXCLUDE (snapshot_us, canonical_id)), 6) + 0 FROM prof")
def a4_profile_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions(spark, sf_dir)
    rows = profile.profile_sessions(s, identity.canonical_mapping(s, CUTOFF))
    p = profile.profile_backfill(rows, spark.createDataFrame([(x,) for x in DAYS], "snapshot_us long"))
    return p.select("snapshot_us", "canonical_id", *[(F.round(c, 6) + 0).alias(c) for c in p.columns if c not in ("snapshot_us", "canonical_id")])


@query(f"WITH {PROFILE_SQL} SELECT canonical_id, arg_max(sessions_30d, snapshot_us) AS sessions_30d, round(arg_max(turnover_sum_30d, snapshot_us) FILTER (turnover_sum_30d IS NOT NULL), 4) AS turnover_sum_30d FROM prof GROUP BY canonical_id")
def s5_latest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = profile.latest_profile(_profiles(spark, sf_dir), SNAPS[-1], ["sessions_30d", "turnover_sum_30d"])
    return got.withColumn("turnover_sum_30d", F.round("turnover_sum_30d", 4))


@query(f"""WITH {PROFILE_SQL}, q AS (SELECT o_orderkey AS row_id, canonical_id, epoch_us(o_orderdate) AS t FROM orders JOIN mapping ON mapping.player_id = o_custkey)
SELECT row_id, p.snapshot_us, p.sessions_30d FROM q ASOF LEFT JOIN prof p ON q.canonical_id = p.canonical_id AND q.t >= p.snapshot_us""")
def j15_profile_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stakeflow.plans.adapters import micros, read

    mapping = identity.canonical_mapping(sessions(spark, sf_dir), CUTOFF)
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("player_id"), micros("o_orderdate").alias("t"))
    return asof.asof_join(rows.join(mapping, "player_id"), _profiles(spark, sf_dir).select("canonical_id", "snapshot_us", "sessions_30d"), "canonical_id", "t", "snapshot_us", bucket=182 * DAY).select("row_id", "snapshot_us", "sessions_30d")


@query(f"""WITH {PROFILE_SQL}, q AS (SELECT o_orderkey AS row_id, coalesce(canonical_id, CAST(o_custkey AS VARCHAR)) AS canonical_id, epoch_us(o_orderdate) AS t FROM orders LEFT JOIN mapping ON mapping.player_id = o_custkey)
SELECT row_id, p.snapshot_us, p.sessions_30d FROM q ASOF LEFT JOIN prof p ON q.canonical_id = p.canonical_id AND q.t >= p.snapshot_us""")
def j15_profile_asof_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every order; nulls for players without a card or a snapshot yet."""
    from stakeflow.plans.adapters import micros, read

    mapping = identity.canonical_mapping(sessions(spark, sf_dir), CUTOFF)
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("player_id"), micros("o_orderdate").alias("t"))
    return asof.asof_join(identity.with_fallback(rows, mapping), _profiles(spark, sf_dir).select("canonical_id", "snapshot_us", "sessions_30d"), "canonical_id", "t", "snapshot_us", bucket=182 * DAY).select("row_id", "snapshot_us", "sessions_30d")


@query(f"""WITH {PROFILE_SQL} SELECT canonical_id, count(DISTINCT session_date) FILTER (session_us > {CUTOFF - 30 * DAY}) AS active_days_30d, round(coalesce(sum(theo_win) FILTER (session_us > {CUTOFF - 30 * DAY}), 0.0), 4) AS theo_win_sum_30d,
round(coalesce(sum(turnover) FILTER (session_us > {CUTOFF - 30 * DAY}), 0.0), 4) AS turnover_sum_30d, CAST(floor(({CUTOFF} - min(session_us)) / {DAY}) AS BIGINT) AS days_since_first_session FROM base WHERE session_us <= {CUTOFF} GROUP BY canonical_id""")
def a31_frozen_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions(spark, sf_dir)
    got = profile.frozen_profile(profile.profile_sessions(s, identity.canonical_mapping(s, CUTOFF)), CUTOFF)
    return got.withColumns({c: F.round(c, 4) for c in ("theo_win_sum_30d", "turnover_sum_30d")})


@query(f"""WITH {MAPPING}, h AS (SELECT coalesce({"CASE WHEN lower(trim(casino_player_id)) IN ('', 'null') THEN NULL ELSE trim(casino_player_id) END"}, CAST(player_id AS VARCHAR)) AS canonical_id, {"CASE WHEN lower(trim(casino_player_id)) IN ('', 'null') THEN NULL ELSE trim(casino_player_id) END"} IS NOT NULL AS rated, coalesce(end_us, lud_us) AS us FROM latest)
SELECT canonical_id, count(*) AS sessions, min(us) AS first_us, max(us) AS last_us, bool_or(rated) AS rated, round((max(us) - min(us)) / {DAY}, 6) AS span_days FROM h GROUP BY canonical_id""")
def a25_patron_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.patron_history(sessions(spark, sf_dir)).withColumn("span_days", F.round("span_days", 6))
