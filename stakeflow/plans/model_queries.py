"""Queries of model jobs, whose results SQL doesn't give, and of scans and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.functions import ids
from stakeflow.operators import facts, features, models, ranking, splits
from stakeflow.plans.adapters import BETS, DAY, MINUTE, SESSIONS, bets, micros, read, scored, sessions
from stakeflow.plans.sequence_queries import CUTOFF, END, LATEST
from stakeflow.sources import tables
from stakeflow.sources.materialise import shared_folder, written
from stakeflow.streaming import queries as streams

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str = ""):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


FEATURES = ["bets_cnt_w30m", "wager_avg_w15m", "wager_std_w15m", "prev_bet_gap_min", "lose_cnt_w15m", "cum_bets"]


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bets with their features, label, weight and split. The windows are evaluated once, and what models read, which they
    do many times, is written down; weights come by the same partitions."""
    df = features.add_features(bets(spark, sf_dir), features.BET_FEATURES, key="player_id", unit=60 * MINUTE)
    df = facts.sample_weights(df.withColumn("label", (F.col("status") == "LOSE").cast("int")), "player_id")
    df = written(df.select("bet_id", "player_id", "us", "label", "weight", *FEATURES))
    return splits.time_ordered_split(df.withColumns({"is_rated": F.col("player_id") % 4 != 0, "canonical_id": F.col("player_id").cast("string")}))


@query()
def m19_logistic_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labelled(spark, sf_dir)
    model = models.logistic_baseline(df.where("split = 'train'"), FEATURES)
    valid = models.scored(df.where("split = 'valid'"), model, FEATURES)
    return models.with_margin(models.scored(df.where("split = 'test'"), model, FEATURES), models.chosen_threshold(valid)).select("bet_id", "score", "margin", "is_alert")


@query()
def m19_sgd_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labelled(spark, sf_dir)
    model = models.sgd_baseline(df.where("split = 'train'"), FEATURES)
    return df.where("split = 'test'").select("bet_id", model.score(FEATURES).alias("score"))


@query()
def m20_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the test rows, by trees in which each player weighs alike, with their average precision on the valid ones."""
    df = labelled(spark, sf_dir)
    model = models.boosted_trees(df.where("split = 'train'"), FEATURES, weight="weight")
    valid = ranking.average_precision(ranking.pr_curve(models.scored(df.where("split = 'valid'"), model, FEATURES)))
    test = models.scored(df.where("split = 'test'"), model, FEATURES).select("bet_id", "score")
    return test.join(F.broadcast(valid.withColumnRenamed("average_precision", "valid_average_precision")))  # one row


@query(f"WITH {BETS} SELECT bet_id, us, wager FROM bets WHERE us >= {END - 12 * DAY} AND us < {END - 5 * DAY} AND wager > 0")
def s1_scan_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan_bets(bets(spark, sf_dir, END - 12 * DAY, END - 5 * DAY), END - 10 * DAY, END - 5 * DAY, ["bet_id", "us", "wager"])


@query(f"WITH {SESSIONS.replace('sessions AS', 'every AS')}, sessions AS (SELECT * FROM every WHERE start_us >= {CUTOFF - 31 * DAY} AND start_us < {CUTOFF + DAY}), {LATEST} SELECT session_id FROM latest WHERE is_manual = 0 AND is_deleted = 0 AND is_canceled = 0 AND (turnover > 0 OR num_games_with_wager > 0)")
def s2_scan_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan_sessions(sessions(spark, sf_dir, CUTOFF - 31 * DAY, CUTOFF + DAY), CUTOFF - 30 * DAY, CUTOFF).select("session_id")


@query(f"WITH {SESSIONS.replace('sessions AS', 'every AS')}, sessions AS (SELECT * FROM every WHERE start_us >= {CUTOFF - 240 * 60 * MINUTE} AND start_us <= {CUTOFF}), {LATEST} SELECT session_id FROM latest WHERE end_us IS NULL")
def s10_open_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan_open_sessions(sessions(spark, sf_dir, CUTOFF - 10 * DAY, CUTOFF + 1), CUTOFF, 240).select("session_id")


@query("SELECT DISTINCT CAST(ts AS DATE) AS gaming_day FROM events")
def s11_list_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.list_partitions(bets(spark, sf_dir))


@query("SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM events")
def s13_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.date_range(bets(spark, sf_dir), ["nowhere", "gaming_day"])


@query(f"WITH {BETS} SELECT * FROM (SELECT bet_id FROM bets ORDER BY us, bet_id LIMIT 20) UNION SELECT * FROM (SELECT bet_id FROM bets ORDER BY us DESC, bet_id DESC LIMIT 20)")
def s15_head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.head_tail(bets(spark, sf_dir).select("us", "bet_id"), 20, "us", "bet_id").select("bet_id")


@query(f"WITH {BETS} SELECT gaming_day, count(*) AS rows, min(us) AS first_us, max(us) AS last_us FROM bets GROUP BY 1")
def s16_write_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{shared_folder(spark)}/bets-by-day-{uuid.uuid4().hex}"
    tables.write_partitions(bets(spark, sf_dir), at)
    return spark.read.parquet(at).groupBy("gaming_day").agg(F.count("*").alias("rows"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))


@query(f"WITH {BETS} SELECT session_id, CAST(sum(n) AS BIGINT) AS bets, round(sum(w), 6) + 0 AS wager, max(l) AS last_us FROM (SELECT session_id, count(*) AS n, sum(wager) AS w, max(us) AS l FROM bets GROUP BY session_id) GROUP BY session_id")
def s18_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir)
    totals = lambda df: df.groupBy("session_id").agg(F.count("*").alias("bets"), F.sum("wager").alias("wager"), F.max("us").alias("last_us"))
    out = tables.upsert(totals(b.where("bet_id % 2 = 0")), totals(b.where("bet_id % 2 = 1")), "session_id", {"bets": "sum", "wager": "sum", "last_us": "max"})
    return out.withColumn("wager", F.round("wager", 6) + 0)


@query(f"WITH {BETS} SELECT bet_id, CAST(make_timestamp(us) AS DATE) AS date, CAST(hour(make_timestamp(us)) AS INT) AS hour FROM bets WHERE bet_id > 500 AND us <= {END - 5 * DAY} - 300000000 ORDER BY bet_id LIMIT 1000")
def s19_export_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = tables.export_batch(bets(spark, sf_dir).withColumn("prediction_id", F.col("bet_id")), 500, END - 5 * DAY, most=1000)
    return rows.select("bet_id", "date", "hour")


@query(f"WITH {BETS} SELECT bet_id FROM bets WHERE us >= {END - 9 * DAY} OR bet_id > 9000")
def s20_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.retained(bets(spark, sf_dir).withColumn("prediction_id", F.col("bet_id")), END - 9 * DAY, 9000).select("bet_id")


@query("SELECT o_orderkey, CASE WHEN d < 0 THEN NULL WHEN d <= 7 THEN 'T0_seg' WHEN d <= 30 THEN 'T1' WHEN d <= 90 THEN 'T2' ELSE 'T3' END AS tenure, CAST(least(9, floor((o_totalprice % 1000) / 1000 * 10)) AS INT) AS bin, CASE WHEN lower(trim(o_orderpriority)) IN ('', 'null') THEN NULL ELSE trim(o_orderpriority) END AS card FROM (SELECT *, o_orderkey % 200 - 10 AS d FROM orders)")
def p25_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select("o_orderkey", ids.tenure_bucket(F.col("o_orderkey") % 200 - 10).alias("tenure"), ids.score_bin(F.col("o_totalprice") % 1000 / 1000).alias("bin"), ids.clean_card_id(F.col("o_orderpriority")).alias("card"))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    df = streams.stream_table(spark, f"{sf_dir}/events.parquet*", schema)
    return df.select(F.col("event_id").alias("bet_id"), F.col("user_id").alias("player_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("wager"))


@query("SELECT event_id AS bet_id FROM events")
def t3_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "events")  # sets the zone
    twice = _stream(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return streams.stored(streams.dedup_stream(twice).select("bet_id"))


@query("SELECT user_id * 1000 + day(ts) AS session_id, count(*) AS bets, round(sum(value), 6) + 0 AS wager, epoch_us(min(ts)) AS first_us FROM events GROUP BY 1, CAST(ts AS DATE)")
def t4_session_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "events")
    df = _stream(spark, sf_dir).withColumn("session_id", F.col("player_id") * 1000 + F.dayofmonth("ts"))
    out = streams.stored(streams.session_totals_stream(df), "complete")
    return out.select("session_id", "bets", (F.round("wager", 6) + 0).alias("wager"), micros("first_ts").alias("first_us"))


@query(f"WITH {BETS}, s AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR us - lag(us) OVER w >= {720 * MINUTE} THEN 1 ELSE 0 END AS new FROM bets WINDOW w AS (PARTITION BY player_id ORDER BY us, bet_id)), q AS (SELECT *, sum(new) OVER (PARTITION BY player_id ORDER BY us, bet_id ROWS UNBOUNDED PRECEDING) AS r FROM s) SELECT player_id, count(*) AS bet_count, min(us) AS run_start_us, max(us) AS run_end_us FROM q GROUP BY player_id, r")
def t5_runs_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "events")
    out = streams.stored(streams.runs_stream(_stream(spark, sf_dir), "719 minutes 59.999999 seconds"), "complete")
    return out.select("player_id", "bet_count", micros("run_start").alias("run_start_us"), micros("run_end").alias("run_end_us"))


@query(f"WITH {BETS}, s AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR us - lag(us) OVER w >= {720 * MINUTE} THEN 1 ELSE 0 END AS new FROM bets WINDOW w AS (PARTITION BY player_id ORDER BY us, bet_id)), q AS (SELECT *, sum(new) OVER (PARTITION BY player_id ORDER BY us, bet_id ROWS UNBOUNDED PRECEDING) AS r FROM s) SELECT player_id, count(*) AS bet_count, min(us) AS run_start_us, max(us) AS run_end_us FROM q GROUP BY player_id, r HAVING max(us) // 1000 * 1000 + {720 * MINUTE} - 1 <= (SELECT max(us) FROM bets) // 1000 * 1000 - {MINUTE}")
def t5_runs_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In append mode: only runs that a pause has closed when the stream stands."""
    read(spark, sf_dir, "events")
    out = streams.stored(streams.runs_stream(_stream(spark, sf_dir), "719 minutes 59.999999 seconds"))
    return out.select("player_id", "bet_count", micros("run_start").alias("run_start_us"), micros("run_end").alias("run_end_us"))


@query("WITH k AS (SELECT *, unnest(generate_series(0, 3)) AS back FROM events), w AS (SELECT epoch_us(ts) // 900000000 * 900000000 - back * 900000000 AS start_us, value FROM k) SELECT start_us, count(*) AS rows, round(avg(value), 6) AS mean_score, count(*) FILTER (value > 50) AS alerts FROM w GROUP BY 1")
def t10_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "events")
    df = _stream(spark, sf_dir).select("ts", F.col("wager").alias("score"), (F.col("wager") > 50).alias("is_alert"))
    return streams.stored(streams.kpi_stream(df), "complete").select(micros("start").alias("start_us"), "rows", F.round("mean_score", 6).alias("mean_score"), "alerts")
