"""Queries of the sequence, identity and fact operators over the driver's tables, with windows to their scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.functions import ids
from stakeflow.operators import asof, dedup, facts, identity
from stakeflow.operators import sequence as seq
from stakeflow.plans.adapters import BETS, DAY, GAMES, MINUTE, SESSIONS, bets, games, sessions

GAP, HORIZON, LOOK = 720 * MINUTE, 360 * MINUTE, 7 * DAY
#: 2024-01-31, after the last event; and a cutoff within the years of orders.
END, CUTOFF = 1_706_659_200_000_000, 904_608_000_000_000
QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str = ""):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


O = "PARTITION BY player_id ORDER BY us, bet_id"
RUNS = f"""stepped AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR us - lag(us) OVER w >= {GAP} THEN 1 ELSE 0 END AS new FROM bets WINDOW w AS ({O})),
seq AS (SELECT *, sum(new) OVER ({O} ROWS UNBOUNDED PRECEDING) AS run_seq FROM stepped)"""
TEXT = "strftime(make_timestamp({0}), '%Y-%m-%dT%H:%M:%S.%f')"
RUN_ID = "'run_' || substr(sha256('{{\"first_bet_id\":' || {first} || ',\"player_id\":' || player_id || ',\"run_definition_version\":\"v1\",\"run_start_ts\":\"' || {start} || '\",\"source_namespace\":\"events\"}}'), 1, 32)"
FACT = f"""{RUNS},
fact AS (SELECT player_id, CAST(run_seq AS BIGINT) AS run_seq, arg_min(bet_id, (us, bet_id)) AS first_bet_id, arg_max(bet_id, (us, bet_id)) AS last_bet_id,
  min(us) AS run_start_us, max(us) AS run_end_us, arg_min(gaming_day, (us, bet_id)) AS start_day, arg_max(gaming_day, (us, bet_id)) AS end_day, count(*) AS bet_count
  FROM seq GROUP BY player_id, run_seq),
runs AS (SELECT *, {RUN_ID.format(first='first_bet_id', start=TEXT.format('run_start_us'))} AS run_id FROM fact)"""


@query(f"WITH {BETS}, {FACT} SELECT * FROM runs")
def a5_run_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.run_fact(bets(spark, sf_dir), GAP)


@query(f"WITH {BETS}, {FACT} SELECT run_id, bet_id, seq.player_id, gaming_day, end_day FROM seq JOIN runs USING (player_id, run_seq)")
def a6_run_bet_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.run_bet_map(bets(spark, sf_dir), GAP)


@query(f"WITH {BETS}, {FACT} SELECT DISTINCT run_id, seq.player_id, gaming_day AS bet_day, end_day FROM seq JOIN runs USING (player_id, run_seq)")
def a7_run_day_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.run_day_bridge(bets(spark, sf_dir), GAP)


TRIPS = f"""{FACT}, gone AS (SELECT *, CASE WHEN lag(end_day) OVER w IS NULL OR start_day - lag(end_day) OVER w > 3 THEN 1 ELSE 0 END AS new_trip FROM runs WINDOW w AS (PARTITION BY player_id ORDER BY run_start_us, run_id)),
tagged AS (SELECT *, CAST(sum(new_trip) OVER (PARTITION BY player_id ORDER BY run_start_us, run_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS trip_seq FROM gone),
trips AS (SELECT player_id, trip_seq, min(run_start_us) AS trip_start_us, max(run_end_us) AS trip_end_us, arg_min(run_id, run_start_us) AS first_run_id, arg_max(end_day, run_start_us) AS last_day, count(*) AS run_count, CAST(sum(bet_count) AS BIGINT) AS bet_count FROM tagged GROUP BY player_id, trip_seq)"""
TRIP_ID = "'trip_' || substr(sha256('{\"first_run_id\":\"' || first_run_id || '\",\"player_id\":' || player_id || ',\"source_namespace\":\"events\",\"trip_definition_version\":\"v1\",\"trip_start_ts\":\"' || " + TEXT.format("trip_start_us") + " || '\"}'), 1, 32)"


@query(f"""WITH {BETS}, {TRIPS}, c AS (SELECT *, lead(trip_seq) OVER (PARTITION BY player_id ORDER BY trip_seq) IS NOT NULL OR DATE '2024-01-31' - last_day >= 3 AS closed FROM trips)
SELECT *, CASE WHEN closed THEN CAST(last_day + 3 AS DATE) END AS trip_end_day, {TRIP_ID} AS trip_id FROM c""")
def a8_trip_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.trip_fact(facts.run_fact(bets(spark, sf_dir), GAP), F.to_date(F.lit("2024-01-31")))


@query(f"""WITH {BETS}, {TRIPS} SELECT {TRIP_ID.replace("player_id ||", "g.player_id ||")} AS trip_id, run_id, g.player_id, CAST(row_number() OVER (PARTITION BY g.player_id, g.trip_seq ORDER BY run_start_us, run_id) - 1 AS BIGINT) AS run_in_trip
FROM tagged g JOIN trips t ON g.player_id = t.player_id AND g.trip_seq = t.trip_seq""")
def a8_trip_run_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.trip_run_map(facts.run_fact(bets(spark, sf_dir), GAP))


@query(f"""WITH {BETS}, {RUNS} SELECT bet_id, round(1.0 / count(*) OVER (PARTITION BY player_id, run_seq), 9) AS weight FROM seq""")
def a15_sample_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = facts.sample_weights(seq.run_sequence(bets(spark, sf_dir), gap=GAP), "player_id", "run_seq")
    return df.select("bet_id", F.round("weight", 9).alias("weight"))


@query(f"""WITH {BETS}, n AS (SELECT *, lead(us) OVER ({O}) AS nxt FROM bets),
g AS (SELECT *, CASE WHEN nxt IS NULL THEN us + {GAP} <= {END} ELSE nxt - us >= {GAP} END AS gap_start, nxt IS NULL AND us + {GAP} > {END} AS censored FROM n)
SELECT bet_id, gap_start, censored, max(CAST(gap_start AS INT)) OVER (PARTITION BY player_id ORDER BY us RANGE BETWEEN 0 PRECEDING AND {HORIZON} FOLLOWING) AS label FROM g""")
def w1_walkaway_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.walkaway_labels(bets(spark, sf_dir), END, gap=GAP, horizon=HORIZON).select("bet_id", "gap_start", "censored", "label")


def _streak_sql(counted: str, reset: str, name: str, look: int | None) -> str:
    within = f"least(s, sum(c) OVER ({O} ROWS UNBOUNDED PRECEDING) - coalesce(sum(c) OVER (PARTITION BY player_id ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND {look} PRECEDING), 0))" if look else "s"
    return f"""WITH {BETS}, g AS (SELECT *, CAST({counted} AS INT) AS c, CAST({reset} AS INT) AS r, sum(CAST({reset} AS INT)) OVER ({O} ROWS UNBOUNDED PRECEDING) AS grp FROM bets),
k AS (SELECT *, sum(CASE WHEN r = 1 THEN 0 ELSE c END) OVER (PARTITION BY player_id, grp ORDER BY us, bet_id ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT bet_id, CAST({within} AS BIGINT) AS {name} FROM k"""


@query(_streak_sql("status = 'LOSE'", "status = 'WIN'", "loss_streak", None))
def w2_loss_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.loss_streak(bets(spark, sf_dir)).select("bet_id", "loss_streak")


@query(_streak_sql("status = 'LOSE'", "status IN ('WIN', 'PUSH')", "loss_streak", LOOK))
def w3_loss_streak_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.loss_streak(bets(spark, sf_dir), push_resets=True, lookback=LOOK).select("bet_id", "loss_streak")


@query(_streak_sql("status IN ('LOSE', 'PUSH')", "status NOT IN ('LOSE', 'PUSH')", "non_win_streak", LOOK))
def w4_non_win_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.non_win_streak(bets(spark, sf_dir), lookback=LOOK).select("bet_id", "non_win_streak")


RUN_OUT = "run_id, run_start_us, round(minutes_since_run_start, 9) AS minutes_since_run_start, bets_in_run, round(wager_in_run, 4) + 0 AS wager_in_run, round(net_in_run, 4) + 0 AS net_in_run, round(net_per_bet, 9) + 0 AS net_per_bet"


@query(f"""WITH {BETS}, {RUNS}, r AS (SELECT bet_id, CAST(run_seq - 1 AS BIGINT) AS run_id, min(us) OVER x AS run_start_us, count(*) OVER x AS bets_in_run, sum(wager) OVER x AS wager_in_run, -sum(casino_win) OVER x AS net_in_run, us
  FROM seq WINDOW x AS (PARTITION BY player_id, run_seq ORDER BY us, bet_id ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, (us - run_start_us) / 60000000 AS minutes_since_run_start, net_in_run / bets_in_run AS net_per_bet FROM r) SELECT bet_id, {RUN_OUT} FROM s""")
def w5_run_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.run_boundary(bets(spark, sf_dir), gap=GAP).selectExpr("bet_id", *_exprs(RUN_OUT))


def _exprs(text: str) -> list[str]:
    out, depth = [""], 0
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


@query(f"""WITH {BETS}, n AS (SELECT *, row_number() OVER ({O}) AS rn FROM bets),
p AS (SELECT a.bet_id, a.player_id, a.us, a.rn, b.us AS bus, b.rn AS brn, b.wager, b.casino_win, lag(b.us) OVER (PARTITION BY a.bet_id ORDER BY b.rn) AS prev FROM n a JOIN n b ON a.player_id = b.player_id AND b.rn <= a.rn AND b.us > a.us - {LOOK}),
q AS (SELECT *, CASE WHEN prev IS NULL OR bus - prev >= {GAP} THEN 1 ELSE 0 END AS new FROM p),
z AS (SELECT *, sum(new) OVER (PARTITION BY bet_id ORDER BY brn ROWS UNBOUNDED PRECEDING) AS k FROM q),
m AS (SELECT *, max(k) OVER (PARTITION BY bet_id) AS top FROM z),
r AS (SELECT bet_id, CAST(max(top) - 1 AS BIGINT) AS run_id, min(bus) AS run_start_us, (max(us) - min(bus)) / 60000000 AS minutes_since_run_start, count(*) AS bets_in_run, sum(wager) AS wager_in_run, -sum(casino_win) AS net_in_run, -sum(casino_win) / count(*) AS net_per_bet FROM m WHERE k = top GROUP BY bet_id)
SELECT bet_id, {RUN_OUT} FROM r""")
def w6_run_boundary_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.run_boundary(bets(spark, sf_dir), gap=GAP, lookback=LOOK).selectExpr("bet_id", *_exprs(RUN_OUT))


@query(f"WITH {BETS} SELECT bet_id, count(DISTINCT player_id) OVER (PARTITION BY table_id ORDER BY us RANGE BETWEEN {300 * MINUTE} PRECEDING AND {60 * MINUTE} PRECEDING) AS head_count FROM bets")
def w7_table_head_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.table_head_count(bets(spark, sf_dir).select("bet_id", "table_id", "player_id", "us"), 300 * MINUTE, 60 * MINUTE).select("bet_id", "head_count")


@query(f"WITH {BETS}, {RUNS} SELECT bet_id, CAST(run_seq AS BIGINT) AS run_seq FROM seq")
def w11_run_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.run_sequence(bets(spark, sf_dir), gap=GAP).select("bet_id", "run_seq")


@query(f"WITH {BETS}, {TRIPS} SELECT run_id, trip_seq, CAST(row_number() OVER (PARTITION BY player_id, trip_seq ORDER BY run_start_us, run_id) - 1 AS BIGINT) AS run_in_trip FROM tagged")
def w13_trip_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.trip_sequence(facts.run_fact(bets(spark, sf_dir), GAP)).select("run_id", "trip_seq", "run_in_trip")


@query(f"""WITH {BETS}, r AS (SELECT bet_id, row_number() OVER w AS session_bets, sum(wager) OVER w AS session_wager, (us - min(us) OVER w) / 60000000 AS session_minutes FROM bets WINDOW w AS (PARTITION BY session_id ORDER BY us, bet_id ROWS UNBOUNDED PRECEDING))
SELECT bet_id, session_bets, round(session_wager, 4) AS session_wager, round(session_minutes, 9) AS session_minutes, round(session_wager / session_bets, 4) AS session_average,
  round(CASE WHEN session_minutes > 0 THEN session_bets / session_minutes ELSE 0.0 END, 4) AS bets_per_minute FROM r""")
def w14_session_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.session_running(bets(spark, sf_dir)).selectExpr("bet_id", "session_bets", "round(session_wager, 4) AS session_wager", "round(session_minutes, 9) AS session_minutes", "round(session_average, 4) AS session_average", "round(bets_per_minute, 4) AS bets_per_minute")


@query(f"""WITH {BETS} SELECT a.bet_id, {", ".join(f"count(*) FILTER (b.us >= a.us - {m * MINUTE}) AS bets_last_{m}" for m in (300, 900))}, round(sum(b.wager), 4) AS wager_last_900
FROM bets a JOIN bets b ON a.session_id = b.session_id AND b.us >= a.us - {900 * MINUTE} AND (b.us < a.us OR b.us = a.us AND b.bet_id <= a.bet_id) GROUP BY a.bet_id""")
def w15_session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = seq.session_windows(bets(spark, sf_dir), (300, 900), (900,))
    return df.select("bet_id", "bets_last_300", "bets_last_900", F.round("wager_last_900", 4).alias("wager_last_900"))


@query(f"""WITH {BETS} SELECT bet_id, CAST(hour(make_timestamp(us)) AS INT) AS hour_of_day, CAST(isodow(make_timestamp(us)) - 1 AS INT) AS day_of_week, CAST(isodow(make_timestamp(us)) >= 6 AS INT) AS is_weekend,
round(sin(2 * pi() * (us % 86400000000) / 60000000 / 1440), 9) AS time_of_day_sin, round(cos(2 * pi() * (us % 86400000000) / 60000000 / 1440), 9) AS time_of_day_cos,
CASE WHEN wager < 100 THEN '0_100' WHEN wager < 500 THEN '100_500' ELSE '500_2000' END AS bet_size FROM bets""")
def w16_time_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ids.time_segments(F.col("us"))
    return bets(spark, sf_dir).select("bet_id", *[(F.round(c, 9) if k.startswith("time") else c).alias(k) for k, c in parts.items()], ids.bet_size_bucket(F.col("wager")).alias("bet_size"))


ALERTS = "alerts AS (SELECT bet_id AS alert_id, player_id, us AS alert_us FROM bets WHERE wager > 60)"
GAPS = f"""{ALERTS}, pts AS (SELECT alert_id, alert_us, b.us, 1 AS bet FROM alerts a JOIN bets b ON a.player_id = b.player_id AND b.us > alert_us AND b.us <= alert_us + {2 * GAP}
  UNION ALL SELECT alert_id, alert_us, alert_us, 0 FROM alerts UNION ALL SELECT alert_id, alert_us, alert_us + {2 * GAP}, 0 FROM alerts),
walk AS (SELECT *, lag(us) OVER (PARTITION BY alert_id ORDER BY us, bet) AS prev FROM pts),
gaps AS (SELECT alert_id, coalesce(bool_or(us - prev >= {GAP} AND prev - alert_us <= {HORIZON}), FALSE) AS gap_found, bool_or(bet = 1 AND us > alert_us + {HORIZON}) AS late_bet, CAST(sum(bet) AS BIGINT) AS n_bets FROM walk GROUP BY alert_id)"""


@query(f"WITH {BETS}, {GAPS} SELECT * FROM gaps")
def w17_alert_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir)
    return seq.alert_gaps(b.where("wager > 60").select(F.col("bet_id").alias("alert_id"), "player_id", F.col("us").alias("alert_us")), b, GAP, HORIZON, 2 * GAP)


NOW = END - DAY


@query(f"""WITH {BETS}, {GAPS}, d AS (SELECT gaps.*, {NOW} - alert_us AS age, CASE WHEN late_bet THEN 'MISS' ELSE 'MATCH' END AS done FROM gaps JOIN alerts USING (alert_id))
SELECT alert_id, CASE WHEN age < {2 * DAY} THEN 'TOO_RECENT' WHEN n_bets = 0 THEN 'PENDING' WHEN gap_found AND age < {4 * DAY} THEN 'PENDING' ELSE done END AS verdict FROM d""")
def w18_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir)
    alerts = b.where("wager > 60").select(F.col("bet_id").alias("alert_id"), "player_id", F.col("us").alias("alert_us"))
    return seq.verdicts(seq.alert_gaps(alerts, b, GAP, HORIZON, 2 * GAP).join(alerts, "alert_id"), NOW, 2 * DAY, 4 * DAY).select("alert_id", "verdict")


LATEST = "latest AS (SELECT * FROM sessions QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY lud_us DESC NULLS LAST, etl_us DESC NULLS LAST) = 1)"
VALID = f"{SESSIONS}, {LATEST}, valid AS (SELECT *, coalesce(end_us, lud_us) AS known_us FROM latest WHERE is_manual = 0 AND is_deleted = 0 AND is_canceled = 0 AND (turnover > 0 OR num_games_with_wager > 0) AND coalesce(end_us, lud_us) <= {CUTOFF})"
CARD = "CASE WHEN lower(trim(casino_player_id)) IN ('', 'null') THEN NULL ELSE trim(casino_player_id) END"
LINKS = f"{VALID}, links AS (SELECT player_id, {CARD} AS card, lud_us, known_us + 420000000 AS link_us FROM valid WHERE {CARD} IS NOT NULL), dummies AS (SELECT player_id FROM valid GROUP BY player_id HAVING count(*) = 1 AND coalesce(sum(num_games_with_wager), 0) <= 1)"
MAPPING = f"{LINKS}, mapping AS (SELECT player_id, arg_max(card, (lud_us, card)) AS canonical_id FROM links WHERE player_id NOT IN (SELECT player_id FROM dummies) GROUP BY player_id)"


@query(f"WITH {SESSIONS}, {LATEST} SELECT session_id, player_id, lud_us, etl_us, casino_player_id FROM latest")
def j1_dedup_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_sessions(sessions(spark, sf_dir)).select("session_id", "player_id", "lud_us", "etl_us", "casino_player_id")


@query(f"""WITH {BETS}, twice AS (SELECT bet_id, player_id, us, etl_us FROM bets UNION ALL SELECT bet_id, player_id, us - 60000000, etl_us + 3600000000 FROM bets WHERE bet_id % 3 = 0),
seen AS (SELECT *, least(etl_us, us + 122000000) AS observed_us FROM twice)
SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY bet_id ORDER BY observed_us DESC, us) = 1""")
def j2_dedup_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir).select("bet_id", "player_id", "us", "etl_us")
    again = b.where("bet_id % 3 = 0").withColumns({"us": F.col("us") - MINUTE, "etl_us": F.col("etl_us") + 60 * MINUTE})
    seen = b.unionByName(again).withColumn("observed_us", dedup.capped_observed(F.col("etl_us"), F.col("us")))
    return dedup.newest(seen, "bet_id", F.desc("observed_us"), F.col("us"))


@query(f"WITH {GAMES} SELECT game_id, ts_ms, outcome, game_status FROM games QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY ts_ms DESC, etl_us DESC, us DESC) = 1")
def j3_dedup_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_games(games(spark, sf_dir)).select("game_id", "ts_ms", "outcome", "game_status")


@query(f"WITH {LINKS}, eligible AS (SELECT DISTINCT player_id FROM links) SELECT session_id, player_id FROM valid WHERE player_id IN (SELECT player_id FROM eligible) AND player_id NOT IN (SELECT player_id FROM dummies)")
def j4_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions(spark, sf_dir)
    df = dedup.only_ids(identity.valid_sessions(s, CUTOFF), identity.identity_links(s, CUTOFF), "player_id")
    return dedup.without_ids(df, identity.dummy_players(s, CUTOFF), "player_id").select("session_id", "player_id")


@query(f"WITH {LINKS} SELECT * FROM links")
def j5_identity_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.identity_links(sessions(spark, sf_dir), CUTOFF)


@query(f"WITH {LINKS} SELECT * FROM dummies")
def j6_dummy_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.dummy_players(sessions(spark, sf_dir), CUTOFF)


@query(f"WITH {MAPPING} SELECT * FROM mapping")
def j7_canonical_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.canonical_mapping(sessions(spark, sf_dir), CUTOFF)


@query(f"WITH {LINKS} SELECT player_id, count(DISTINCT card) AS cards FROM links GROUP BY player_id HAVING count(DISTINCT card) > 1")
def j8_card_swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.card_swaps(sessions(spark, sf_dir), CUTOFF)


# sessions lie in the 1990s and bets in 2024: orders' days are moved on for as-of joins
SHIFT = 1_040_000_000_000_000
SHIFTED = f"{LINKS}, moved AS (SELECT player_id % 150 + 1 AS player_id, card, link_us % {30 * DAY} + {END - 30 * DAY} AS link_us FROM links)"


def _moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = identity.identity_links(sessions(spark, sf_dir), CUTOFF)
    return links.select((F.col("player_id") % 150 + 1).alias("player_id"), "card", (F.col("link_us") % (30 * DAY) + (END - 30 * DAY)).alias("link_us"))


@query(f"""WITH {BETS}, {SHIFTED}, one AS (SELECT player_id, link_us, max(card) AS card FROM moved GROUP BY player_id, link_us)
SELECT b.bet_id, coalesce(m.card, CAST(b.player_id AS VARCHAR)) AS canonical_id, m.card IS NOT NULL AS pit_rated FROM bets b ASOF LEFT JOIN one m ON b.player_id = m.player_id AND b.us >= m.link_us""")
def j11_pit_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.pit_identity(bets(spark, sf_dir), _moved(spark, sf_dir)).select("bet_id", "canonical_id", "pit_rated")


@query(f"""WITH {BETS}, {MAPPING} SELECT bet_id, coalesce(canonical_id, CAST(bets.player_id AS VARCHAR)) AS canonical_id, canonical_id IS NOT NULL AS is_rated FROM bets LEFT JOIN mapping USING (player_id)""")
def j12_mapping_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.with_fallback(bets(spark, sf_dir), identity.canonical_mapping(sessions(spark, sf_dir), CUTOFF)).select("bet_id", "canonical_id", "is_rated")


@query(f"""WITH {BETS}, {MAPPING}, own AS (SELECT session_id, {CARD} AS card, coalesce(end_us, lud_us) + 420000000 AS known FROM latest)
SELECT bet_id, coalesce(CASE WHEN known <= us THEN card END, canonical_id, CAST(b.player_id AS VARCHAR)) AS canonical_id FROM bets b LEFT JOIN own ON own.session_id = b.bet_id LEFT JOIN mapping m ON m.player_id = b.player_id""")
def j13_resolve_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions(spark, sf_dir)
    b = bets(spark, sf_dir).withColumn("session_id", F.col("bet_id"))
    return identity.resolve_identity(b, s, identity.canonical_mapping(s, CUTOFF)).select("bet_id", "canonical_id")


@query(f"""WITH {BETS}, {GAMES}, g AS (SELECT * FROM games QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY ts_ms DESC) = 1), r AS (SELECT table_id, us AS game_us, max(game_id) AS game_id FROM g WHERE game_status = 'RESOLVED' GROUP BY 1, 2)
SELECT bet_id, game_id, game_us FROM bets b ASOF LEFT JOIN r ON b.table_id = r.table_id AND b.us > r.game_us""")
def j16_strict_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = dedup.resolved_games(games(spark, sf_dir)).groupBy("table_id", F.col("us").alias("game_us")).agg(F.max("game_id").alias("game_id"))
    return asof.asof_join(bets(spark, sf_dir), g, "table_id", "us", "game_us", strict=True, bucket=DAY // 24).select("bet_id", "game_id", "game_us")


@query(f"WITH {BETS} SELECT bet_id, us, wager FROM bets WHERE us >= {END - 20 * DAY} AND us < {END - 5 * DAY} AND wager > 0")
def p5_bet_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.bet_dq(bets(spark, sf_dir, END - 20 * DAY, END - 5 * DAY), END - 20 * DAY, END - 5 * DAY).select("bet_id", "us", "wager")


@query(f"WITH {SESSIONS}, {LATEST} SELECT session_id FROM latest WHERE is_manual = 0 AND is_deleted = 0 AND is_canceled = 0 AND (turnover > 0 OR num_games_with_wager > 0)")
def p6_session_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.session_dq(sessions(spark, sf_dir)).select("session_id")


@query(f"WITH {BETS} SELECT bet_id, status FROM bets WHERE status = 'WIN' OR CAST('0x' || substr(md5('7:' || bet_id), 1, 8) AS BIGINT) / 4294967296.0 < 0.3")
def p18_negative_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = bets(spark, sf_dir).withColumn("label", (F.col("status") == "WIN").cast("int"))
    return dedup.negative_sample(df, 0.3, 7).select("bet_id", "status")
