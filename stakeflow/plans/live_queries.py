"""Queries of live scoring and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.operators import dedup, live, serving
from stakeflow.plans.adapters import BETS, DAY, GAMES, MINUTE, SESSIONS, bets, games, micros, read, sessions
from stakeflow.plans.sequence_queries import CUTOFF, END

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str = ""):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


NOW = END - 6 * DAY


@query(f"WITH {BETS} SELECT bet_id, gaming_day FROM bets WHERE us >= {NOW - 10 * DAY} AND us <= {NOW - MINUTE} AND wager > 0")
def s9_scan_bets_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir, NOW - 10 * DAY, NOW)
    return live.scan_bets_live(b.withColumn("gaming_day", F.when(F.col("bet_id") % 2 == 0, F.col("gaming_day"))), NOW - 10 * DAY, NOW).select("bet_id", "gaming_day")


@query(f"""WITH {SESSIONS}, b AS (SELECT o_orderkey AS bet_id, o_orderkey + o_orderkey % 3 AS session_id, epoch_us(o_orderdate) AS us FROM orders), l AS (SELECT * FROM sessions QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY end_us DESC NULLS FIRST, lud_us DESC) = 1)
SELECT bet_id, coalesce(start_us, us) AS session_start_us, coalesce(end_us, us) AS session_end_us FROM b LEFT JOIN l USING (session_id)""")
def j19_session_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("bet_id"), (F.col("o_orderkey") + F.col("o_orderkey") % 3).alias("session_id"), micros("o_orderdate").alias("us"))
    return live.session_enrich(b, sessions(spark, sf_dir)).select("bet_id", "session_start_us", "session_end_us")


@query(f"WITH {BETS}, p AS (SELECT DISTINCT player_id, player_id // 3 AS c FROM bets WHERE wager > 60) SELECT CAST(c AS VARCHAR) AS canonical_id, bet_id, us FROM bets JOIN p USING (player_id) WHERE us >= {NOW - 9 * DAY} AND us <= {NOW} AND wager > 0")
def j31_bets_of_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir)
    alerts = b.where("wager > 60").withColumn("canonical_id", F.floor(F.col("player_id") / 3).cast("string"))
    return live.bets_of_identities(b, live.alert_players(alerts), NOW - 9 * DAY, NOW)


@query(f"WITH {BETS} SELECT bet_id, us, player_id FROM bets WHERE wager > 60")
def j31_bets_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir)
    old = b.withColumns({"us": F.col("us") - MINUTE, "player_id": F.lit(-1).cast("long")})
    return live.bets_by_id(b.unionByName(old), b.where("wager > 60").select("bet_id"))


@query(f"""WITH {SESSIONS}, s AS (SELECT * FROM sessions WHERE coalesce(end_us, lud_us) >= {CUTOFF - 400 * DAY} AND coalesce(end_us, lud_us) <= {CUTOFF + DAY} AND is_manual = 0 AND is_deleted = 0 AND is_canceled = 0), l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY lud_us DESC, etl_us DESC) = 1)
SELECT CAST(player_id // 2 AS VARCHAR) AS canonical_id, session_id, coalesce(end_us, lud_us) AS available_us, end_us FROM l WHERE turnover > 0 OR num_games_with_wager > 0""")
def j31_sessions_of_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions(spark, sf_dir)
    players = s.select("player_id").distinct().withColumn("canonical_id", F.floor(F.col("player_id") / 2).cast("string"))
    return live.sessions_of_identities(s, players, CUTOFF - 399 * DAY, CUTOFF)


@query(f"WITH {BETS}, l AS (SELECT * FROM bets WHERE wager > 20 QUALIFY row_number() OVER (PARTITION BY table_id, position_idx ORDER BY us DESC, bet_id DESC) = 1) SELECT CAST(table_id AS VARCHAR) AS table_id, CAST(position_idx AS VARCHAR) AS seat, us AS alert_us, wager FROM (SELECT DISTINCT table_id, position_idx FROM bets) LEFT JOIN l USING (table_id, position_idx)")
def j28_seats_with_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir)
    seats = b.select("table_id", F.col("position_idx").alias("seat")).distinct()
    return live.seats_with_alerts(seats, b.where("wager > 20").withColumn("position_idx", F.col("position_idx").cast("double")), "wager")


@query(f"WITH {GAMES}, v AS (SELECT * FROM games WHERE etl_us <= {NOW} AND us >= {NOW - 12 * DAY} AND us < {NOW} AND table_id IN (SELECT event_id % 8 FROM events WHERE event_type = 'signup')), l AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY ts_ms DESC) = 1) SELECT game_id, outcome FROM l WHERE game_status = 'RESOLVED'")
def s6_scan_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    seats = read(spark, sf_dir, "events").where("event_type = 'signup'").select((F.col("event_id") % 8).alias("table_id"))
    return dedup.resolved_games(games(spark, sf_dir), NOW + DAY, seats, NOW - 12 * DAY, NOW).select("game_id", "outcome")


@query(f"SELECT CASE WHEN max(ts) FILTER (epoch_us(ts) <= {NOW}) IS NULL THEN 0.5 ELSE arg_max(value, ts) FILTER (epoch_us(ts) <= {NOW}) END AS threshold, 'runtime' AS source FROM events")
def t11_effective_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.effective_threshold(bets(spark, sf_dir).select("us", F.col("wager").alias("threshold")), 0.5, NOW, 30 * DAY)


#: Alerts are bets over 60; a minute is sixteen of the test tables.
SLOW = 16


def _alerts(spark: SparkSession, sf_dir: str, scale: int = SLOW) -> tuple[DataFrame, DataFrame]:
    b = bets(spark, sf_dir).withColumn("us", F.floor(F.col("us") / scale))
    alerts = b.where("wager > 60").select(F.col("bet_id").alias("alert_id"), "player_id", F.floor(F.col("player_id") / 3).cast("string").alias("canonical_id"), F.col("us").alias("alert_us"))
    return alerts, b


def verdict_sql(now: int, seen: str = "TRUE") -> str:
    """Verdicts over the bets that are seen: each alert walks over its identity's bets within 45 minutes."""
    m = MINUTE
    return f"""al AS (SELECT bet_id AS alert_id, player_id // 3 AS c, us AS alert_us FROM slow WHERE wager > 60), pl AS (SELECT DISTINCT player_id, player_id // 3 AS c FROM slow WHERE wager > 60),
se AS (SELECT pl.c, slow.us FROM slow JOIN pl USING (player_id) WHERE wager > 0 AND {seen} AND us >= (SELECT min(alert_us) FROM al) AND us <= least({now}, (SELECT max(alert_us) FROM al) + {45 * m})),
nb AS (SELECT al.alert_id, al.alert_us, se.us FROM al JOIN se ON se.c = al.c AND se.us > alert_us AND se.us <= alert_us + {45 * m}),
pt AS (SELECT alert_id, alert_us, us, 1 AS bet FROM nb UNION ALL SELECT alert_id, alert_us, alert_us, 0 FROM al UNION ALL SELECT alert_id, alert_us, alert_us + {45 * m}, 0 FROM al),
wk AS (SELECT *, lag(us) OVER (PARTITION BY alert_id ORDER BY us, bet) AS prev FROM pt),
gp AS (SELECT alert_id, any_value(alert_us) AS alert_us, coalesce(bool_or(us - prev >= {30 * m} AND prev - alert_us <= {15 * m}), FALSE) AS g, bool_or(bet = 1 AND us > alert_us + {15 * m}) AS late, sum(bet) AS n FROM wk GROUP BY alert_id),
ow AS (SELECT gp.*, n + CASE WHEN c.c IS NULL AND EXISTS (SELECT 1 FROM slow s WHERE s.bet_id = gp.alert_id AND {seen.replace('us ', 's.us ')}) THEN 1 ELSE 0 END AS nn FROM gp JOIN al USING (alert_id) LEFT JOIN (SELECT DISTINCT c FROM se) c USING (c)),
vd AS (SELECT alert_id, alert_us, CASE WHEN {now} - alert_us < {47 * m} THEN 'TOO_RECENT' WHEN nn = 0 THEN 'PENDING' WHEN g AND {now} - alert_us < {60 * m} THEN 'PENDING' WHEN late THEN 'MISS' ELSE 'MATCH' END AS verdict FROM ow)"""


SLOW_BETS = f"{BETS}, slow AS (SELECT * REPLACE (us // {SLOW} AS us) FROM bets)"


@query(f"WITH {SLOW_BETS}, {verdict_sql(NOW // SLOW)} SELECT alert_id, verdict FROM vd")
def t8_validated_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.validated(*_alerts(spark, sf_dir), NOW // SLOW).select("alert_id", "verdict")


#: Of two tellings, the first saw only the bets at even times.
@query(f"""WITH {SLOW_BETS}, once AS (WITH {verdict_sql(NOW // SLOW, 'us % 2 = 0')} SELECT alert_id, alert_us, verdict FROM vd), again AS (WITH {verdict_sql(NOW // SLOW + 30 * MINUTE)} SELECT alert_id, verdict FROM vd),
j AS (SELECT o.alert_id, o.alert_us, CASE WHEN o.verdict = 'MATCH' THEN 'MATCH' WHEN a.verdict = 'MATCH' THEN 'MATCH' WHEN o.verdict = 'PENDING' AND a.verdict = 'MISS' THEN 'MISS' ELSE o.verdict END AS k FROM once o JOIN again a USING (alert_id))
SELECT alert_id, CASE WHEN k = 'PENDING' AND {NOW // SLOW + 30 * MINUTE} - alert_us > {60 * MINUTE} THEN 'MISS' ELSE k END AS verdict FROM j""")
def t9_late_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts, b = _alerts(spark, sf_dir)
    first = live.validated(alerts, b.where("us % 2 = 0"), NOW // SLOW)
    return live.revalidated(first, alerts, b, NOW // SLOW + 30 * MINUTE).select("alert_id", "verdict")


#: Stops of the stream of verdicts; bets are seen up to 99 minutes late.
STOPS = [END // SLOW - 12 * 60 * MINUTE, END // SLOW - 6 * 60 * MINUTE, END // SLOW + 120 * MINUTE]
_M = MINUTE
STREAM_SQL = f"""{BETS}, sb AS (SELECT bet_id, player_id // 3 AS c, us // {SLOW} AS us, wager, us // {SLOW} + bet_id * 37 % 100 * {_M} AS seen FROM bets),
st AS (SELECT k, stop, (SELECT max(seen) // 1000 * 1000 FROM sb WHERE seen <= stop) AS w FROM (VALUES {", ".join(f"({k}, {s})" for k, s in enumerate(STOPS))}) v(k, stop)),
al AS (SELECT k, w, bet_id AS alert_id, c, us AS alert_us FROM sb, st WHERE wager > 60 AND seen <= stop),
nb AS (SELECT k, alert_id, alert_us, sb.us FROM al JOIN st USING (k) JOIN sb ON sb.c = al.c AND sb.us > alert_us AND sb.us <= alert_us + {45 * _M} AND sb.wager > 0 AND sb.seen <= stop),
pt AS (SELECT k, alert_id, alert_us, us, 1 AS bet FROM nb UNION ALL SELECT k, alert_id, alert_us, alert_us, 0 FROM al UNION ALL SELECT k, alert_id, alert_us, alert_us + {45 * _M}, 0 FROM al),
wk AS (SELECT *, lag(us) OVER (PARTITION BY k, alert_id ORDER BY us, bet) AS prev FROM pt),
gp AS (SELECT k, alert_id, alert_us, coalesce(bool_or(us - prev >= {30 * _M} AND prev - alert_us <= {15 * _M}), FALSE) AS g, bool_or(bet = 1 AND us > alert_us + {15 * _M}) AS late, sum(bet) AS n FROM wk GROUP BY ALL),
told AS (SELECT gp.*, w - alert_us > {60 * _M} AS done, CASE WHEN w - alert_us < {47 * _M} THEN NULL WHEN n = 0 OR (g AND w - alert_us < {60 * _M}) THEN 'PENDING' WHEN late THEN 'MISS' ELSE 'MATCH' END AS v FROM gp JOIN st USING (k)),
ends AS (SELECT k, alert_id, alert_us, done, CASE WHEN done AND v = 'PENDING' THEN 'MISS' ELSE v END AS v FROM told),
firsts AS (SELECT alert_id, alert_us, min(k) FILTER (v = 'MATCH') AS match_k, min(k) FILTER (done) AS done_k, min(k) FILTER (v = 'MISS') AS miss_k FROM ends GROUP BY ALL)"""


def _verdict_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The log of the stream over whole tables, which come in three stops by when rows are seen, with a restart at each."""
    import uuid

    from stakeflow.sources.materialise import shared_folder
    from stakeflow.streaming import queries as streams
    from stakeflow.streaming import validation

    at = f"{shared_folder(spark)}/verdicts-{uuid.uuid4().hex}"
    b = bets(spark, sf_dir).select("bet_id", F.floor(F.col("player_id") / 3).cast("string").alias("canonical_id"), F.floor(F.col("us") / SLOW).alias("us"), "wager")
    b = b.withColumn("seen", F.timestamp_micros(F.col("us") + F.col("bet_id") * 37 % 100 * MINUTE))
    alerts = lambda df: df.where("wager > 60").select(F.col("bet_id").alias("alert_id"), "canonical_id", F.col("us").alias("alert_us"), "seen")
    before = F.lit(None)
    for stop in STOPS:
        here = F.col("seen") <= F.timestamp_micros(F.lit(stop))
        b.where(here if stop == STOPS[0] else here & (F.col("seen") > F.timestamp_micros(F.lit(before)))).write.mode("append").parquet(f"{at}/bets")
        rows = streams.stream_table(spark, f"{at}/bets", b.schema)
        with validation.keyed_state(spark):
            q = validation.verdict_log(alerts(rows), rows).writeStream.option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{at}/log")
            q.awaitTermination()
        before = stop
    return spark.read.schema(validation.LOG).parquet(f"{at}/log"), at


@query(f"WITH {STREAM_SQL} SELECT alert_id, CASE WHEN match_k <= coalesce(done_k, match_k) THEN 'MATCH' WHEN miss_k IS NOT NULL THEN 'MISS' ELSE 'PENDING' END AS verdict FROM firsts WHERE alert_id IN (SELECT alert_id FROM ends WHERE v IS NOT NULL)")
def t8_verdict_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stakeflow.streaming import validation

    log, _ = _verdict_stream(spark, sf_dir)
    return validation.current_verdicts(log).select("alert_id", "verdict")


SEEN = "CASE WHEN bet_id % 5 = 0 THEN us ELSE etl_us END"


@query(f"WITH {BETS} SELECT bet_id, wager FROM bets WHERE {SEEN} <= {END - 2 * DAY - MINUTE}")
def t1_observed_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bets by the cursor of observed time, over a table that grows at three stops, with a restart at each."""
    import uuid

    from stakeflow.sources.materialise import shared_folder
    from stakeflow.sources.observed import observed_stream

    at, last = f"{shared_folder(spark)}/observed-{uuid.uuid4().hex}", None
    b = bets(spark, sf_dir).withColumn("etl_us", F.when(F.col("bet_id") % 5 != 0, F.col("etl_us")))
    seen = F.coalesce("etl_us", "us")
    for stop in (END - 10 * DAY, END - 6 * DAY, END - 2 * DAY):
        (b.where(seen <= stop) if last is None else b.where((seen > last) & (seen <= stop))).write.mode("append").parquet(f"{at}/bets")
        rows = observed_stream(spark, f"{at}/bets", now_us=stop, schema="bet_id long, wager double")
        rows.writeStream.format("parquet").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start(f"{at}/rows").awaitTermination()
        last = stop
    return spark.read.schema("bet_id long, wager double").parquet(f"{at}/rows")


@query(f"WITH {BETS} SELECT session_id, count(*) AS bets, round(sum(wager), 6) + 0 AS wager, min(us) AS first_us, max(us) AS last_us FROM bets GROUP BY session_id HAVING max(us) >= (SELECT max(us) FROM bets) - {DAY}")
def t4_session_totals_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the sessions of the last 24 hours, in a table of buckets that a stream of three batches of all bets keeps."""
    import uuid

    from stakeflow.sources.keyed import KeyedTable
    from stakeflow.sources.materialise import shared_folder
    from stakeflow.streaming import queries as streams

    at, last = f"{shared_folder(spark)}/keyed-{uuid.uuid4().hex}", None
    rows = bets(spark, sf_dir).select("session_id", F.lit(1).cast("long").alias("bets"), "wager", F.col("us").alias("first_us"), F.col("us").alias("last_us"))
    kept = KeyedTable(spark, f"{at}/table", "session_id", {"bets": "sum", "wager": "sum", "first_us": "min", "last_us": "max"}, time="last_us")
    for stop in (END - 12 * DAY, END - 5 * DAY, END + 365 * DAY):
        us = F.col("first_us")
        (rows.where(us <= stop) if last is None else rows.where((us > last) & (us <= stop))).write.mode("append").parquet(f"{at}/in")
        kept.follow(streams.stream_table(spark, f"{at}/in", rows.schema), f"{at}/checkpoint").awaitTermination()
        last = stop
    return kept.read(rows.schema).select("session_id", "bets", (F.round("wager", 6) + 0).alias("wager"), "first_us", "last_us")
