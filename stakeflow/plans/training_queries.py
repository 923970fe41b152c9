"""Queries of what training does with raw rows: types, filters, labels, splits, calibration, profiles and outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.functions.ids import clean_card_id
from stakeflow.operators import audit, cleaning, facts, features, identity, live, profile, ranking, rules, serving, splits
from stakeflow.operators import sequence as seq
from stakeflow.plans.adapters import BETS, DAY, MINUTE, SCORED, SESSIONS, bets, micros, read, scored, sessions
from stakeflow.plans.audit_queries import ORACLES as AUDITS, rounded
from stakeflow.plans.feature_queries import PROFILE_SQL, SNAPS, _profiles
from stakeflow.plans.ranking_queries import curve_sql
from stakeflow.plans.sequence_queries import CARD, CUTOFF, END, FACT, GAP, HORIZON, LATEST, MAPPING, ORACLES as SEQUENCES
from stakeflow.sources import tables
from stakeflow.sources.materialise import shared_folder
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


@query("SELECT event_id, TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'x' ELSE '' END || event_id AS BIGINT) AS bet_id, TRY_CAST(CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id || '.0' END AS DOUBLE)::BIGINT AS player_id, CAST(event_id % 8 AS VARCHAR) AS table_id FROM events")
def p1_normalize_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, key = read(spark, sf_dir, "events"), F.col("event_id")
    raw = e.select("event_id", F.concat(F.when(key % 7 == 0, "x").otherwise(""), key.cast("string")).alias("bet_id"), F.when(key % 5 != 0, F.concat(F.col("user_id").cast("string"), F.lit(".0"))).alias("player_id"), (key % 8).alias("table_id"))
    return cleaning.normalize_types(raw)


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(19, 4)) AS DOUBLE) AS wager, CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(CAST(l_tax AS DECIMAL(19, 4)) AS DOUBLE) END AS casino_win FROM lineitem")
def p2_money_to_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem")
    win = F.when(F.col("l_linenumber") == 2, "n/a").otherwise(F.col("l_tax").cast("decimal(19,4)").cast("string"))
    return cleaning.money_to_double(l.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(19,4)").alias("wager"), win.alias("casino_win")))


@query("SELECT event_id, epoch_us(ts + INTERVAL 8 HOUR) AS local_us, CAST(ts + INTERVAL 8 HOUR AS DATE) AS day FROM events")
def p4_local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, ts = read(spark, sf_dir, "events"), F.col("ts").cast("timestamp")
    return e.select("event_id", micros(tables.to_local_naive(ts)).alias("local_us"), cleaning.eval_date(ts).alias("day"))


def _lost(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bets of which some lost their player, and the sessions, of which some have none either."""
    b = bets(spark, sf_dir)
    own = b.select("session_id", F.when(F.col("session_id") % 5 == 0, -1).otherwise(F.col("player_id")).alias("player_id")).distinct()
    return b.withColumn("player_id", F.when(F.col("bet_id") % 11 == 0, None).when(F.col("bet_id") % 13 == 0, -1).otherwise(F.col("player_id"))), own


LOST = f"{BETS}, lost AS (SELECT * REPLACE (CASE WHEN bet_id % 11 = 0 THEN NULL WHEN bet_id % 13 = 0 THEN -1 ELSE player_id END AS player_id), player_id AS real_id FROM bets), found AS (SELECT * REPLACE (CASE WHEN (player_id IS NULL OR player_id = -1) AND session_id % 5 <> 0 THEN real_id ELSE player_id END AS player_id) FROM lost)"


@query(f"WITH {LOST} SELECT bet_id, player_id FROM found")
def j14_recover_player_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.recover_player_id(*_lost(spark, sf_dir)).select("bet_id", "player_id")


@query(f"WITH {LOST} SELECT bet_id, player_id, CAST(make_timestamp(us) AS DATE) AS gaming_day, wager, CAST(is_back_bet AS DOUBLE) AS is_back_bet FROM found WHERE us >= {END - 20 * DAY} AND us < {END - 3 * DAY} AND wager > 0 AND player_id IS NOT NULL AND player_id <> -1")
def p5_clean_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, own = _lost(spark, sf_dir)
    return cleaning.clean_bets(b.drop("gaming_day", "status"), own, END - 20 * DAY, END - 3 * DAY).select("bet_id", "player_id", "gaming_day", "wager", "is_back_bet")


@query(f"WITH {BETS}, one AS (SELECT player_id FROM bets GROUP BY 1 HAVING count(*) < 5) SELECT bet_id FROM bets WHERE gaming_day = DATE '2024-01-15' AND coalesce(TRY_CAST(CASE bet_id % 10 WHEN 0 THEN '1' WHEN 1 THEN 'x' ELSE '0' END AS INT), 0) = 0 AND player_id NOT IN (SELECT player_id FROM one) AND player_id IN (SELECT player_id FROM bets WHERE wager > 20)")
def p7_preprocessed_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, key = bets(spark, sf_dir), F.col("bet_id") % 10
    one = b.groupBy("player_id").agg(F.count("*").alias("n")).where("n < 5")
    df = b.withColumn("is_deleted", F.when(key == 0, "1").when(key == 1, "x").otherwise("0"))
    return cleaning.preprocessed_bets(df, F.lit("2024-01-15").cast("date"), one, b.where("wager > 20")).select("bet_id")


@query(f"WITH {BETS} SELECT bet_id, CASE WHEN etl_us - us > 540000000 THEN NULL ELSE least(etl_us, us + 122000000) END AS observed_us, CASE WHEN etl_us - us > 540000000 THEN 'cap,late' ELSE 'cap' END AS rules, etl_us - us > 540000000 AS excluded FROM bets")
def p9_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, out = cleaning.apply_rules(bets(spark, sf_dir), [cleaning.RowRule("late", "etl_us - us > 540000000", priority=9), cleaning.RowRule("cap", "etl_us is not null", "cap"), cleaning.RowRule("off", "true", enabled=False)])
    one = lambda df, gone: df.select("bet_id", (F.lit(None) if gone else F.col("observed_us")).cast("long").alias("observed_us"), F.array_join("rule_ids", ",").alias("rules"), F.lit(gone).alias("excluded"))
    return one(kept, False).unionByName(one(out, True))


@query(f"WITH {BETS} SELECT bet_id FROM bets WHERE us >= {END - 12 * DAY} AND us < {END - 4 * DAY}")
def p11_time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.time_window(bets(spark, sf_dir, END - 12 * DAY, END - 4 * DAY + 1), "us", END - 12 * DAY, END - 4 * DAY).select("bet_id")


@query(f"WITH {SCORED} SELECT count(*) AS rows, count(*) FILTER (bet_id % 9 IN (0, 1)) AS bad FROM scored")
def p12_bad_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("bet_id") % 9
    return rules.bad_labels(scored(spark, sf_dir).withColumn("label", F.when(key == 0, 2).when(key != 1, F.col("label"))))


@query("SELECT CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_quantity, CAST(l_orderkey AS DOUBLE) AS l_orderkey FROM lineitem")
def p13_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.feature_matrix(read(spark, sf_dir, "lineitem").withColumn("l_orderkey", F.col("l_orderkey").cast("string")), ["l_linenumber", "l_quantity", "l_orderkey"])


@query("SELECT event_id, TRY_CAST(CASE WHEN event_id % 4 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS DOUBLE) AS number, value FROM events")
def p14_coerce_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string"))
    return cleaning.coerce_features(read(spark, sf_dir, "events").select("event_id", text.alias("number"), "value"), ["number", "value", "absent"])


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE value END AS a, CASE WHEN event_id % 3 = 1 THEN NULL ELSE value END AS b FROM events")
def p15_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id") % 3
    return rules.filled(read(spark, sf_dir, "events").select("event_id", F.when(key != 0, F.col("value")).alias("a"), F.when(key != 1, F.col("value")).alias("b")), ["a", "b"], ["b"])


@query(f"WITH w AS ({SEQUENCES['w1_walkaway_labels']}) SELECT w.bet_id, w.label FROM w JOIN events ON event_id = bet_id WHERE NOT w.censored AND epoch_us(ts) >= {END - 15 * DAY} AND epoch_us(ts) < {END - 2 * DAY}")
def p19_core_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.core_window(seq.walkaway_labels(bets(spark, sf_dir), END, gap=GAP, horizon=HORIZON), END - 15 * DAY, END - 2 * DAY).select("bet_id", "label")


@query(f"WITH {PROFILE_SQL} SELECT snapshot_us, canonical_id, concat_ws(',', CASE WHEN days_since_last_session < 0 THEN 'NEGATIVE_RECENCY' END, CASE WHEN days_since_first_session < days_since_last_session THEN 'FIRST_AFTER_LAST' END, CASE WHEN sessions_30d < sessions_7d THEN 'WINDOW_NOT_NESTED' END, CASE WHEN turnover_sum_30d < 0 THEN 'NEGATIVE_TURNOVER' END, CASE WHEN active_days_30d > 31 THEN 'TOO_MANY_DAYS' END) AS codes FROM (SELECT * REPLACE (days_since_last_session - CASE WHEN sessions_30d > 1 THEN 30 ELSE 0 END AS days_since_last_session) FROM prof)")
def p22_profile_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _profiles(spark, sf_dir).withColumn("days_since_last_session", F.col("days_since_last_session") - F.when(F.col("sessions_30d") > 1, 30).otherwise(0))
    return rules.profile_violations(p).select("snapshot_us", "canonical_id", F.array_join("violations", ",").alias("codes"))


@query(f"WITH {BETS} SELECT bet_id FROM bets WHERE us >= {END - 9 * DAY} ORDER BY us DESC, bet_id DESC LIMIT 200")
def p27_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.recent(bets(spark, sf_dir), END - 9 * DAY, 200).select("bet_id")


@query(f"WITH {MAPPING} SELECT DISTINCT player_id FROM mapping")
def j9_rated_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.canonical_mapping(sessions(spark, sf_dir), CUTOFF).select("player_id").distinct()


@query(f"WITH {SCORED} SELECT bet_id, score, CASE WHEN bet_id % 6 < 3 THEN 1 ELSE 0 END AS label FROM scored WHERE bet_id % 6 <> 5")
def j21_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, key = scored(spark, sf_dir), F.col("bet_id") % 6
    truth = s.select("bet_id", F.when(key < 3, 1).when(key < 5, 0).alias("label"))
    return live.label_join(s.select("bet_id", "score", "label"), truth.unionByName(truth)).select("bet_id", "score", "label")


@query(f"WITH {SCORED.replace('scored AS', 'every AS')}, scored AS (SELECT * FROM every WHERE is_rated AND us > {END - 15 * DAY} AND us <= {END - 5 * DAY}), {curve_sql()} SELECT threshold, round(precision, 9) AS precision, alerts FROM curve WHERE alerts >= 5 AND recall >= 0.05 ORDER BY round(precision, 12) DESC, threshold LIMIT 1")
def m11_batch_calibrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    return live.batch_calibrate(s.drop("label"), s.select("bet_id", "label"), END - 5 * DAY, 240, 0.05).select("threshold", F.round("precision", 9).alias("precision"), "alerts")


@query(f"WITH w AS ({SEQUENCES['w1_walkaway_labels']}) SELECT bet_id, label, censored FROM w JOIN events ON event_id = bet_id WHERE value > 60")
def m12_autolabels(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir)
    return live.autolabels(b.where("wager > 60").select("bet_id"), b, END, gap=GAP, horizon=HORIZON).select("bet_id", "label", "censored")


@query(f"""WITH {SCORED}, r AS (SELECT score, row_number() OVER w AS n, sum(label) OVER w AS tp, sum(label) OVER () AS p FROM scored WINDOW w AS (ORDER BY score DESC, bet_id ROWS UNBOUNDED PRECEDING))
SELECT round(tp / n, 9) AS precision, score AS threshold, round(tp / p, 9) AS recall FROM r WHERE tp / p >= 0.2 ORDER BY tp / n DESC, n LIMIT 1""")
def m3_precision_at_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.precision_at_recall(scored(spark, sf_dir), 0.2), 9)


POINTS = {0.01: "0_01", 0.1: "0_1", 0.5: "0_5"}


@query(f"WITH {SCORED}, {curve_sql()}, ap AS (SELECT sum(gain * precision) AS a FROM curve), " + ", ".join(f"p{n} AS (SELECT threshold, precision, alerts FROM curve WHERE alerts >= 5 AND recall >= {r} ORDER BY round(precision, 12) DESC, threshold LIMIT 1)" for r, n in POINTS.items()) + " SELECT count(*) AS rows, count(*) FILTER (score >= 0.6) AS alerts, (SELECT round(a, 9) FROM ap) AS average_precision, " + ", ".join(f"(SELECT threshold FROM p{n}) AS threshold_r{n}, (SELECT round(precision, 9) FROM p{n}) AS precision_r{n}, (SELECT round(alerts / 720, 9) FROM p{n}) AS alerts_per_hour_r{n}" for n in POINTS.values()) + " FROM scored")
def m5_operating_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ranking.operating_points(scored(spark, sf_dir), 0.6, 720, tuple(POINTS), 5)
    return rounded(df.select("rows", "alerts", "average_precision", *[f"{c}_r{n}" for n in POINTS.values() for c in ("threshold", "precision", "alerts_per_hour")]), 9)


@query(f"WITH {SCORED}, q AS (SELECT label, quantile_cont(wager, 0.98) AS a FROM scored GROUP BY label) SELECT bet_id, CASE WHEN label = 0 AND wager >= a THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM scored JOIN q USING (label)")
def m16_hard_negative_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.quantile_weights(scored(spark, sf_dir), F.col("wager"), (0.98, 2.0), (1.0, 1.0)).select("bet_id", "weight")


@query(f"WITH {SCORED} SELECT bet_id, CAST(least(10, floor((row_number() OVER (ORDER BY wager, bet_id) - 1) * 10 / count(*) OVER ()) + 1) AS INT) AS decile FROM scored")
def w21_rank_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_deciles(scored(spark, sf_dir), "wager", "bet_id").select("bet_id", "decile")


@query(f"""WITH {SCORED}, e AS (SELECT *, score >= 0.6 AS h, label = 1 AS p FROM scored), g AS (SELECT count(*) FILTER (h AND p) / count(*) FILTER (h) AS w FROM e), u AS (SELECT 'table_id' AS dimension, CAST(table_id AS VARCHAR) AS value, h, p FROM e UNION ALL SELECT 'is_rated', CAST(is_rated AS VARCHAR), h, p FROM e)
SELECT dimension, value, count(*) AS n, round(count(*) FILTER (h AND p) / nullif(count(*) FILTER (h), 0) - any_value(w), 9) + 0 AS precision_delta, count(*) < 3000 AS low_n FROM u, g GROUP BY dimension, value""")
def a30_slice_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.slice_report(scored(spark, sf_dir), 0.6, "table_id", "is_rated", least=3000).select("dimension", "value", "n", "precision_delta", "low_n"), 9)


@query(f"WITH {BETS}, n AS (SELECT bet_id, row_number() OVER (ORDER BY us, bet_id) - 1 AS i, count(*) OVER () AS n FROM bets), c AS (SELECT *, CAST(floor(n * 0.6) AS BIGINT) AS a FROM n) SELECT bet_id, CASE WHEN i < a THEN 'train' WHEN i < a + CAST(floor((n - a) * 0.5) AS BIGINT) THEN 'valid' ELSE 'test' END AS split FROM c")
def o3_temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.temporal_split(bets(spark, sf_dir), 0.6, 0.5).select("bet_id", "split")


@query("WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders), m AS (SELECT DISTINCT date_trunc('month', o_orderdate)::TIMESTAMP AS m FROM orders) SELECT strftime(m, '%Y-%m') AS month, epoch_us(greatest(m, lo)) AS start_us, epoch_us(least(m + INTERVAL 1 MONTH, hi)) AS end_us, epoch_us(least(m + INTERVAL 1 MONTH, hi)) + 86400000000 AS extended_us FROM m, b WHERE m < hi")
def o4_monthly_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo, hi = read(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("string"), F.max("o_orderdate").cast("string")).first()
    return splits.monthly_windows(spark, lo, hi).select("month", micros("start").alias("start_us"), micros("end").alias("end_us"), micros("extended_end").alias("extended_us"))


@query("WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders), k AS (SELECT month, row_number() OVER (ORDER BY month) AS k, count(*) OVER () AS n FROM m), c AS (SELECT *, greatest(1, least(CAST(floor(n * 0.7) AS BIGINT), n - 2)) AS a FROM k) SELECT month, CASE WHEN k <= a THEN 'train' WHEN k <= a + greatest(1, least(CAST(floor(n * 0.15) AS BIGINT), n - a - 1)) THEN 'valid' ELSE 'test' END AS split FROM c")
def o5_month_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.month_split(read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct())


@query("SELECT o_orderkey, CAST(CASE WHEN CAST(o_orderdate AS DATE) = last_day(o_orderdate) THEN CAST(o_orderdate AS DATE) ELSE date_trunc('month', o_orderdate) - INTERVAL 1 DAY END AS DATE) AS day FROM orders")
def o11_latest_month_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", splits.latest_month_end(F.to_date("o_orderdate")).alias("day"))


@query("SELECT CAST(unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS DATE) AS day FROM events")
def o12_day_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo, hi = read(spark, sf_dir, "events").agg(F.min("ts").cast("string"), F.max("ts").cast("string")).first()
    return splits.day_list(spark, lo[:10], hi[:10])


@query(f"WITH {PROFILE_SQL} SELECT canonical_id, snapshot_us FROM prof WHERE snapshot_us <= {SNAPS[2]} AND snapshot_us >= {SNAPS[1]} AND canonical_id IN (SELECT canonical_id FROM mapping WHERE player_id > 20)")
def s4_scan_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = identity.canonical_mapping(sessions(spark, sf_dir), CUTOFF).where("player_id > 20")
    return tables.scan_profiles(_profiles(spark, sf_dir), SNAPS[1], SNAPS[2], ids, reach=0).select("canonical_id", "snapshot_us")


@query(f"WITH {SCORED} SELECT 'prediction' AS kind, bet_id, round(score, 6) AS score FROM scored UNION ALL SELECT 'alert', bet_id, round(score, 6) FROM scored WHERE score >= 0.6 AND is_rated")
def s23_backtest_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{shared_folder(spark)}/backtest-{uuid.uuid4().hex}"
    tables.write_backtest(scored(spark, sf_dir), at, 0.6)
    out = spark.read.parquet(f"{at}/predictions").select(F.lit("prediction").alias("kind"), "bet_id", F.round("score", 6).alias("score"))
    return out.unionByName(spark.read.csv(f"{at}/alerts", header=True, schema="bet_id long, score double").select(F.lit("alert").alias("kind"), "bet_id", F.round("score", 6).alias("score")))


@query(f"WITH {SCORED} SELECT bet_id AS id, score AS s, label AS y FROM scored WHERE us >= {END - 20 * DAY} AND us < {END - 2 * DAY} ORDER BY us, bet_id LIMIT 500")
def s24_baseline_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.baseline_slice(scored(spark, sf_dir), {"bet_id": "id", "score": "s", "label": "y"}, END - 20 * DAY, END - 2 * DAY, 500)


@query("SELECT CAST(ts AS DATE) AS gaming_day, count(*) AS keys FROM events GROUP BY 1")
def s12_days_of_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{shared_folder(spark)}/days-{uuid.uuid4().hex}"
    tables.write_partitions(bets(spark, sf_dir).select("bet_id", "us", "gaming_day"), at)
    days = tables.days_of_layout(spark, at)
    return days.join(spark.read.parquet(at).groupBy("gaming_day").agg(F.count("*").alias("keys")), "gaming_day")


SHOWN_PROFILE = ["sessions_30d", "turnover_sum_30d"]


@query(f"WITH {PROFILE_SQL}, ids AS (SELECT DISTINCT canonical_id FROM mapping), a AS (SELECT * FROM prof WHERE snapshot_us = {SNAPS[3]} AND sessions_30d > 0), b AS (SELECT * FROM prof WHERE snapshot_us = {SNAPS[1]}) SELECT ids.canonical_id, coalesce(a.sessions_30d, b.sessions_30d) AS sessions_30d, round(coalesce(a.turnover_sum_30d, b.turnover_sum_30d), 4) AS turnover_sum_30d, CASE WHEN a.canonical_id IS NOT NULL THEN 1 WHEN b.canonical_id IS NOT NULL THEN 2 END AS source FROM ids LEFT JOIN a USING (canonical_id) LEFT JOIN b USING (canonical_id)")
def j30_merged_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _profiles(spark, sf_dir).select("snapshot_us", "canonical_id", *SHOWN_PROFILE)
    ids = identity.canonical_mapping(sessions(spark, sf_dir), CUTOFF)
    got = profile.merged_profiles(ids, p.where(F.col("snapshot_us") == SNAPS[3]).where("sessions_30d > 0").drop("snapshot_us"), p.where(F.col("snapshot_us") == SNAPS[1]).drop("snapshot_us"))
    return got.withColumn("turnover_sum_30d", F.round("turnover_sum_30d", 4))


@query(f"""WITH {PROFILE_SQL}, ids AS (SELECT DISTINCT canonical_id FROM mapping), n AS (SELECT * FROM prof WHERE snapshot_us <= {SNAPS[2]} QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY snapshot_us DESC) = 1)
SELECT canonical_id, n.snapshot_us, sessions_30d, round(turnover_sum_30d, 4) AS turnover_sum_30d, (SELECT count(*) FROM ids) AS ids, (SELECT count(*) FROM ids WHERE canonical_id NOT IN (SELECT canonical_id FROM n)) AS missing,
  (SELECT count(*) FROM prof WHERE snapshot_us > {SNAPS[2]} AND canonical_id IN (SELECT canonical_id FROM ids)) AS dropped_rows FROM ids LEFT JOIN n USING (canonical_id)""")
def j32_profiles_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each id's newest profile at a time, and how many ids, ids without one, and later rows there are."""
    from stakeflow.sources.materialise import materialised

    rows, counts = profile.profiles_at(identity.canonical_mapping(sessions(spark, sf_dir), CUTOFF), materialised(_profiles(spark, sf_dir).select("snapshot_us", "canonical_id", *SHOWN_PROFILE)), SNAPS[2], SHOWN_PROFILE)
    return rows.withColumn("turnover_sum_30d", F.round("turnover_sum_30d", 4)).join(F.broadcast(counts))  # one row of counts


@query(f"""WITH {MAPPING}, h AS (SELECT coalesce({CARD}, CAST(player_id AS VARCHAR)) AS canonical_id, {CARD} IS NOT NULL AS rated FROM latest), c AS (SELECT canonical_id, count(*) AS n, bool_or(rated) AS rated FROM h GROUP BY 1)
SELECT rated, CAST(count(*) AS BIGINT) AS ids, round(count(*) FILTER (n > 10) / count(*), 9) AS over_10, round(count(*) FILTER (n > 50) / count(*), 9) AS over_50, round(count(*) FILTER (n > 100) / count(*), 9) AS over_100, quantile_cont(n, 0.5)::DOUBLE AS p50, round(quantile_cont(n, 0.9), 6)::DOUBLE AS p90, round(quantile_cont(n, 0.99), 6)::DOUBLE AS p99 FROM c GROUP BY rated""")
def a25_history_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = profile.history_summary(profile.patron_history(sessions(spark, sf_dir)))
    return summary.select("rated", "ids", *[F.round(f"over_{t}", 9).alias(f"over_{t}") for t in (10, 50, 100)], *[F.round(p, 6).alias(p) for p in ("p50", "p90", "p99")])


@query(f"""WITH {SESSIONS}, c AS (SELECT *, {CARD} AS card FROM sessions), o AS (SELECT card, sum(num_games_with_wager) AS g FROM c WHERE card IS NOT NULL AND is_manual = 0 GROUP BY card HAVING count(DISTINCT session_id) = 1)
SELECT CASE WHEN g <= 1 THEN '0_or_1_game' ELSE 'multi_games' END AS game_type, count(*) AS ids FROM o GROUP BY 1""")
def a40_one_off_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.one_off_ids(sessions(spark, sf_dir), clean_card_id(F.col("casino_player_id")))[0]


@query(f"""WITH {SESSIONS}, c AS (SELECT *, {CARD} AS card FROM sessions), o AS (SELECT card FROM c WHERE card IS NOT NULL AND is_manual = 0 GROUP BY card HAVING count(DISTINCT session_id) = 1 AND sum(num_games_with_wager) <= 1)
SELECT count(DISTINCT card) AS ids, count(DISTINCT table_id) AS tables, count(*) AS sessions FROM c WHERE card IN (SELECT card FROM o)""")
def a40_one_off_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.one_off_ids(sessions(spark, sf_dir), clean_card_id(F.col("casino_player_id")))[1]


@query(f"""WITH {BETS} SELECT status, count(*) AS rows, count(DISTINCT player_id) AS keys, round(sum(wager), 4) AS total, round(avg(wager), 6) AS mean, round(sum(wager) / (SELECT sum(wager) FROM bets), 6) AS share FROM bets GROUP BY status""")
def a36_status_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = audit.status_groups(bets(spark, sf_dir), "player_id", "status", "wager")
    return df.select("status", "rows", "keys", F.round("total", 4).alias("total"), F.round("mean", 6).alias("mean"), F.round("share", 6).alias("share"))


@query(f"WITH {BETS} SELECT TRUE AS same, 3 AS runs, (SELECT count(*) FROM (SELECT DISTINCT session_id FROM bets)) AS rows")
def a13_reproducible(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = audit.reproducible(lambda: serving.session_totals(bets(spark, sf_dir)).select("session_id", "bets", "first_us", "last_us"))
    return got.groupBy("same", "rows").agg(F.count("*").cast("int").alias("runs"))


@query(f"WITH {BETS}, h AS (SELECT CAST('0x' || substr(sha256('bet_id=v' || bet_id || chr(31) || 'us=v' || us), 1, 15) AS BIGINT) AS h FROM bets WHERE us <= {END - 9 * DAY}) SELECT count(*) AS rows, CAST(sum(h) AS VARCHAR) AS sum, bit_xor(h) AS xor FROM h")
def a14_digest_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.digest_until(bets(spark, sf_dir).select("bet_id", "us"), END - 9 * DAY, "us").drop("squares")


@query(f"""WITH {BETS}, {FACT}, m AS (SELECT *, (run_end_us - run_start_us) / 60000000 AS minutes FROM runs),
h AS (SELECT player_id, run_seq, run_start_us, avg(minutes) OVER p AS am, avg(bet_count) OVER p AS ab, avg(CASE WHEN minutes > 0 THEN bet_count / minutes END) OVER p AS ap FROM m WINDOW p AS (PARTITION BY player_id ORDER BY run_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT bet_id, (us - run_start_us) / 60000000 AS minutes, row_number() OVER (PARTITION BY seq.player_id, seq.run_seq ORDER BY us, bet_id) AS n, am, ab, ap FROM seq JOIN h ON seq.player_id = h.player_id AND seq.run_seq = h.run_seq)
SELECT bet_id, round(CASE WHEN am > 0 THEN minutes / am ELSE 0.0 END, 6) + 0 AS run_duration_vs_personal_avg, round(CASE WHEN ab > 0 THEN n / ab ELSE 0.0 END, 6) + 0 AS bets_in_run_vs_personal_avg, round(CASE WHEN ap > 0 AND minutes > 0 THEN n / minutes / ap ELSE 0.0 END, 6) + 0 AS pace_vs_personal_baseline FROM b""")
def w9_personal_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each bet's run so far by the averages of its player's earlier runs."""
    b = bets(spark, sf_dir).select("bet_id", "player_id", "us", "wager", "casino_win", "gaming_day")
    history = features.run_history(facts.run_fact(b, GAP)).select("player_id", (F.col("run_seq") - 1).alias("run_id"), "avg_run_minutes", "avg_bets_in_run", "avg_bets_per_minute")
    here = seq.run_boundary(b, gap=GAP).join(history, ["player_id", "run_id"])
    pace = F.when(F.col("minutes_since_run_start") > 0, F.col("bets_in_run") / F.col("minutes_since_run_start")).otherwise(0.0)
    got = features.personal_baselines(here.withColumn("bets_per_minute", pace))
    return got.select("bet_id", *[(F.round(c, 6) + 0).alias(c) for c in ("run_duration_vs_personal_avg", "bets_in_run_vs_personal_avg", "pace_vs_personal_baseline")])


@query("SELECT arg_max(event_type, ts) FILTER (event_type <> 'view') AS model_version FROM events")
def w20_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return serving.latest_version(e.select(F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type")).alias("model_version"), micros("ts").alias("us")))


LATE_BETS = f"""late AS ({AUDITS['a42_late_cards']}), own AS (SELECT l_orderkey AS session_id, count(*) AS bets, sum(l_quantity) AS wager FROM lineitem WHERE l_orderkey IN (SELECT session_id FROM late) GROUP BY 1),
every AS (SELECT late.*, coalesce(bets, 0) AS bets, coalesce(wager, 0.0) AS wager FROM late LEFT JOIN own USING (session_id))"""


def _late_card_bets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Of the sessions that got their card late; a line of an order is a bet of its session."""
    b = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("session_id"), F.col("l_quantity").alias("wager"))
    return audit.late_card_bets(b, audit.late_cards(sessions(spark, sf_dir)))


@query(f"WITH {LATE_BETS} SELECT count(*) AS sessions, CAST(sum(bets) AS BIGINT) AS bets, round(sum(wager), 4) AS wager FROM every")
def a42_late_card_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_card_bets(spark, sf_dir)[0].withColumn("wager", F.round("wager", 4))


@query(f"WITH {LATE_BETS} SELECT session_id, versions, card, CAST(bets AS BIGINT) AS bets, round(wager, 4) AS wager FROM every ORDER BY versions DESC, bets DESC, session_id LIMIT 20")
def a42_late_card_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_card_bets(spark, sf_dir)[1].withColumn("wager", F.round("wager", 4))


@query("SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-20'")
def s3_scan_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan_window(read(spark, sf_dir, "events"), "ts", "2024-01-08", "2024-01-20", ["event_id", "value"])


@query("SELECT event_id, sha256('event_id=v' || event_id || chr(31) || 'event_type=' || coalesce('v' || CASE WHEN event_id % 5 <> 0 THEN event_type END, 'n') || chr(31) || 'user_id=v' || user_id) AS digest FROM events")
def a11_row_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("event_type"))
    return e.select("event_id", audit.row_digest(e).alias("digest"))


@query(f"WITH {BETS}, b AS (SELECT bet_id, wager FROM bets WHERE bet_id % 6 <> 1), a AS (SELECT bet_id, wager + CASE WHEN bet_id % 6 = 2 THEN 1 ELSE 0 END AS wager FROM bets WHERE bet_id % 6 <> 3) SELECT bet_id, CASE WHEN b.wager IS NULL THEN 'added' WHEN a.wager IS NULL THEN 'removed' ELSE 'changed' END AS reason, round(a.wager - b.wager, 6) + 0 AS change FROM b FULL JOIN a USING (bet_id) WHERE a.wager IS DISTINCT FROM b.wager")
def t12_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, k = bets(spark, sf_dir).select("bet_id", "wager"), F.col("bet_id") % 6
    got = streams.corrections(b.where(k != 1), b.where(k != 3).withColumn("wager", F.col("wager") + F.when(k == 2, 1.0).otherwise(0.0)), "bet_id", ["wager"])
    return got.select("bet_id", "reason", (F.round(F.col("after.wager") - F.col("before.wager"), 6) + 0).alias("change"))


@query("SELECT l_orderkey AS key, l_quantity AS quantity, NULL::DOUBLE AS price FROM lineitem UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders")
def u1_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("quantity"), F.col("l_orderkey").alias("key"))
    return tables.union_by_name(l, read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))).select("key", "quantity", "price")
