"""Bets, sessions, games and predictions out of the driver's tables, for Spark and as SQL for the oracle.

Times inside are naive local wall times, held as microseconds since the epoch in a long; sessions run in UTC so that
casts don't shift them.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MINUTE = 60_000_000
DAY = 1440 * MINUTE


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts) -> object:
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def between(df: DataFrame, ts: str, lo_us: int | None, hi_us: int | None) -> DataFrame:
    """Rows of ``[lo, hi)``, compared as stored with literals, so that the bounds reach the scan."""
    at = lambda us: F.lit(datetime(1970, 1, 1) + timedelta(microseconds=us)).cast("timestamp_ntz")
    df = df if lo_us is None else df.where(F.col(ts) >= at(lo_us))
    return df if hi_us is None else df.where(F.col(ts) < at(hi_us))


def bets(spark: SparkSession, sf_dir: str, lo_us: int | None = None, hi_us: int | None = None) -> DataFrame:
    """All bets, or those of ``[lo, hi)``."""
    kind = F.col("event_type")
    return between(read(spark, sf_dir, "events"), "ts", lo_us, hi_us).select(
        F.col("event_id").alias("bet_id"),
        F.col("user_id").alias("player_id"),
        micros("ts").alias("us"),
        F.col("value").alias("wager"),
        F.when(kind.isin("purchase", "signup"), "WIN").when(kind == "click", "PUSH").otherwise("LOSE").alias("status"),
        (F.col("event_id") % 8).alias("table_id"),
        (F.col("user_id") * 1000 + F.dayofmonth("ts")).alias("session_id"),
        F.to_date("ts").alias("gaming_day"),
        (micros("ts") + F.col("event_id") * 37 % 600 * 1_000_000).alias("etl_us"),
        F.when(kind.isin("purchase", "signup"), -F.col("value")).when(kind == "click", 0.0).otherwise(F.col("value")).alias("casino_win"),
        (F.col("event_id") % 7 / 2 + 1).alias("payout_odds"),
        (F.col("event_id") % 3 == 0).cast("int").alias("is_back_bet"),
        (F.col("event_id") % 5).cast("int").alias("position_idx"),
    )


BETS = """bets AS (
  SELECT event_id AS bet_id, user_id AS player_id, epoch_us(ts) AS us, value AS wager,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'WIN' WHEN event_type = 'click' THEN 'PUSH' ELSE 'LOSE' END AS status,
    event_id % 8 AS table_id, user_id * 1000 + day(ts) AS session_id, CAST(ts AS DATE) AS gaming_day,
    epoch_us(ts) + event_id * 37 % 600 * 1000000 AS etl_us,
    CASE WHEN event_type IN ('purchase', 'signup') THEN -value WHEN event_type = 'click' THEN 0.0 ELSE value END AS casino_win,
    (event_id % 7) / 2.0 + 1 AS payout_odds, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS is_back_bet, event_id % 5 AS position_idx
  FROM events)"""


def sessions(spark: SparkSession, sf_dir: str, lo_us: int | None = None, hi_us: int | None = None) -> DataFrame:
    """Two versions of every third session, cards of which some are blank or the text null, and flags; with bounds, at least
    those that start in ``[lo, hi)``, which is up to a day after their order."""
    o = between(read(spark, sf_dir, "orders"), "o_orderdate", None if lo_us is None else lo_us - DAY, hi_us)
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    versions = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    v = F.col("version")
    return o.withColumn("version", F.explode(versions)).select(
        key.alias("session_id"),
        cust.alias("player_id"),
        F.when(cust % 11 == 0, "null").when(cust % 13 == 0, " ").when((key % 5 == 0) & (v == 0), F.lit(None).cast("string")).otherwise(F.concat(F.lit(" C"), (cust % 400 + F.when(key % 97 == 0, 1).otherwise(0)).cast("string"))).alias("casino_player_id"),
        (micros("o_orderdate") + (key * 131 % 1440) * MINUTE).alias("start_us"),
        F.when(key % 17 != 0, micros("o_orderdate") + (key * 131 % 1440 + 30 + key % 200) * MINUTE).alias("end_us"),
        (micros("o_orderdate") + (key * 131 % 1440 + 240 + v * 60) * MINUTE).alias("lud_us"),
        (micros("o_orderdate") + (key * 131 % 1440 + 250 + v * 60) * MINUTE).alias("etl_us"),
        (key % 29 == 0).cast("int").alias("is_manual"),
        (key % 31 == 0).cast("int").alias("is_deleted"),
        (key % 37 == 0).cast("int").alias("is_canceled"),
        (key % 6).cast("int").alias("num_games_with_wager"),
        F.when(key % 7 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("turnover"),
        ((key % 100) * 10.0 - 400).alias("player_win"),
        (F.col("o_totalprice") * 0.01).alias("theo_win"),
        (key % 9).alias("table_id"),
        (key % 4).alias("pit_id"),
    )


SESSIONS = """sessions AS (
  SELECT o_orderkey AS session_id, o_custkey AS player_id,
    CASE WHEN o_custkey % 11 = 0 THEN 'null' WHEN o_custkey % 13 = 0 THEN ' ' WHEN o_orderkey % 5 = 0 AND v.version = 0 THEN NULL
         ELSE ' C' || CAST(o_custkey % 400 + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS VARCHAR) END AS casino_player_id,
    epoch_us(o_orderdate) + (o_orderkey * 131 % 1440) * 60000000 AS start_us,
    CASE WHEN o_orderkey % 17 <> 0 THEN epoch_us(o_orderdate) + (o_orderkey * 131 % 1440 + 30 + o_orderkey % 200) * 60000000 END AS end_us,
    epoch_us(o_orderdate) + (o_orderkey * 131 % 1440 + 240 + v.version * 60) * 60000000 AS lud_us,
    epoch_us(o_orderdate) + (o_orderkey * 131 % 1440 + 250 + v.version * 60) * 60000000 AS etl_us,
    CAST(o_orderkey % 29 = 0 AS INT) AS is_manual, CAST(o_orderkey % 31 = 0 AS INT) AS is_deleted, CAST(o_orderkey % 37 = 0 AS INT) AS is_canceled,
    CAST(o_orderkey % 6 AS INT) AS num_games_with_wager, CASE WHEN o_orderkey % 7 = 0 THEN 0.0 ELSE o_totalprice END AS turnover,
    (o_orderkey % 100) * 10.0 - 400 AS player_win, o_totalprice * 0.01 AS theo_win, o_orderkey % 9 AS table_id, o_orderkey % 4 AS pit_id
  FROM orders JOIN (VALUES (0), (1)) v(version) ON v.version = 0 OR o_orderkey % 3 = 0)"""


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A round for each click, at the tables of the bets; every fourth has an earlier version."""
    g = read(spark, sf_dir, "events").where("event_type = 'click'")
    key = F.col("event_id")
    v = F.col("version")
    return g.withColumn("version", F.explode(F.when(key % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))))).select(
        key.alias("game_id"),
        (key % 8).alias("table_id"),
        micros("ts").alias("us"),
        (micros("ts") + (key * 53 % 900) * 1_000_000).alias("etl_us"),
        (F.floor(micros("ts") / 1000) + v).alias("ts_ms"),
        F.when(key % 10 == 9, "VOID").when((key + v) % 3 == 0, "BANKER").when((key + v) % 3 == 1, "PLAYER").otherwise("TIE").alias("outcome"),
        F.when(key % 23 == 0, "OPEN").otherwise("RESOLVED").alias("game_status"),
        (key % 6 + 1).cast("int").alias("num_players"),
        (F.col("value") * 3).alias("total_turnover"),
        (F.col("value") - 200).alias("casino_win"),
    )


GAMES = """games AS (
  SELECT event_id AS game_id, event_id % 8 AS table_id, epoch_us(ts) AS us, epoch_us(ts) + (event_id * 53 % 900) * 1000000 AS etl_us,
    epoch_us(ts) // 1000 + v.version AS ts_ms,
    CASE WHEN event_id % 10 = 9 THEN 'VOID' WHEN (event_id + v.version) % 3 = 0 THEN 'BANKER' WHEN (event_id + v.version) % 3 = 1 THEN 'PLAYER' ELSE 'TIE' END AS outcome,
    CASE WHEN event_id % 23 = 0 THEN 'OPEN' ELSE 'RESOLVED' END AS game_status, CAST(event_id % 6 + 1 AS INT) AS num_players,
    value * 3 AS total_turnover, value - 200 AS casino_win
  FROM events JOIN (VALUES (0), (1)) v(version) ON v.version = 1 OR event_id % 4 = 0 WHERE event_type = 'click')"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores in hundredths with many ties, and labels that lean with them."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("bet_id"),
        F.col("user_id").cast("string").alias("canonical_id"),
        micros("ts").alias("us"),
        F.to_date("ts").alias("gaming_day"),
        (F.floor(F.col("value")) % 100 / 100).alias("score"),
        ((F.col("event_id") * 7919 % 101 + F.floor(F.col("value")) % 100) > 130).cast("int").alias("label"),
        (F.col("user_id") % 4 != 0).alias("is_rated"),
        F.col("value").alias("wager"),
        (F.col("event_id") % 8).alias("table_id"),
    )


SCORED = """scored AS (
  SELECT event_id AS bet_id, CAST(user_id AS VARCHAR) AS canonical_id, epoch_us(ts) AS us, CAST(ts AS DATE) AS gaming_day,
    (CAST(floor(value) AS BIGINT) % 100) / 100.0::DOUBLE AS score, CAST((event_id * 7919 % 101 + CAST(floor(value) AS BIGINT) % 100) > 130 AS INT) AS label,
    user_id % 4 <> 0 AS is_rated, value AS wager, event_id % 8 AS table_id
  FROM events)"""
