"""Queries of the ranking and split operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.operators import ranking, splits
from stakeflow.plans.adapters import DAY, SCORED, read, scored

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str = ""):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def curve_sql(by: str = "") -> str:
    keys, comma, part = by, by and by + ", ", by and f"PARTITION BY {by}"
    return f"""points AS (SELECT {comma}score AS threshold, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM scored GROUP BY {comma}score),
run AS (SELECT *, CAST(sum(n) OVER w AS BIGINT) AS alerts, CAST(sum(pos) OVER w AS BIGINT) AS tp, sum(pos) OVER ({part}) AS p, sum(n) OVER ({part}) AS a FROM points WINDOW w AS ({part} ORDER BY threshold DESC)),
curve AS (SELECT {comma}threshold, alerts, tp, tp / alerts AS precision, tp / p AS recall, pos / p AS gain FROM run WHERE p > 0 AND p < a)"""


@query(f"WITH {SCORED}, {curve_sql()} SELECT threshold, alerts, tp, round(precision, 9) AS precision, round(recall, 9) AS recall FROM curve")
def m1_pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.pr_curve(scored(spark, sf_dir)).select("threshold", "alerts", "tp", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query(f"WITH {SCORED}, {curve_sql()} SELECT threshold, round(precision, 9) AS precision, round(recall, 9) AS recall, alerts FROM curve WHERE alerts >= 5 AND recall >= 0.1 ORDER BY round(precision, 12) DESC, threshold LIMIT 1")
def m2_pick_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = ranking.pick_threshold(ranking.pr_curve(scored(spark, sf_dir)), 0.1)
    return best.select("threshold", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"), "alerts")


@query(f"WITH {SCORED}, {curve_sql()} SELECT round(sum(gain * precision), 9) AS average_precision FROM curve")
def m4_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.average_precision(ranking.pr_curve(scored(spark, sf_dir))).select(F.round("average_precision", 9).alias("average_precision"))


@query(f"""WITH {SCORED}, c AS (SELECT count(*) AS rows, count(*) FILTER (score >= 0.6) AS alerts, count(*) FILTER (score >= 0.6 AND label = 1) AS tp, count(*) FILTER (label = 1) AS positives FROM scored)
SELECT rows, alerts, tp, positives, round(tp / alerts, 9) AS precision, round(tp / positives, 9) AS recall, round(alerts / 720.0, 9) AS alerts_per_hour, round(1 / (1 + (alerts / tp - 1) * (87 / 13.0) / 3.0), 9) AS adjusted FROM c""")
def m5_micro_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ranking.micro_metrics(scored(spark, sf_dir), 0.6, 720)
    df = df.withColumn("adjusted", ranking.prod_adjusted_precision(F.col("precision"), 87 / 13, 3.0))
    return df.select("rows", "alerts", "tp", "positives", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "alerts_per_hour", "adjusted")])


@query(f"""WITH {SCORED}, d AS (SELECT canonical_id, gaming_day, count(*) FILTER (score >= 0.6) AS alerts, coalesce(bool_or(score >= 0.6 AND label = 1), FALSE) AS r, bool_or(label = 1) AS p FROM scored GROUP BY ALL)
SELECT round(avg(CAST(r AS DOUBLE) / alerts) FILTER (alerts > 0), 9) AS macro_precision, round(avg(CAST(r AS DOUBLE)) FILTER (p), 9) AS macro_recall, count(*) FILTER (alerts > 0) AS alert_days FROM d""")
def m7_macro_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.macro_by_day(scored(spark, sf_dir), 0.6).select(F.round("macro_precision", 9).alias("macro_precision"), F.round("macro_recall", 9).alias("macro_recall"), "alert_days")


@query(f"""WITH {SCORED}, {curve_sql("gaming_day")} SELECT gaming_day, threshold, round(precision, 9) AS precision FROM curve WHERE alerts >= 5 AND recall >= 0.1
QUALIFY row_number() OVER (PARTITION BY gaming_day ORDER BY round(precision, 12) DESC, threshold) = 1""")
def m8_precision_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = ranking.pick_threshold(ranking.pr_curve(scored(spark, sf_dir), "gaming_day"), 0.1, by=("gaming_day",))
    return best.select("gaming_day", "threshold", F.round("precision", 9).alias("precision"))


SEGMENTS = f"""WITH {SCORED}, e AS (SELECT *, score >= 0.6 AS h, label = 1 AS p FROM scored), u AS (
  SELECT 'table_id' AS dimension, CAST(table_id AS VARCHAR) AS value, h, p FROM e UNION ALL SELECT 'is_rated', CAST(is_rated AS VARCHAR), h, p FROM e),
s AS (SELECT dimension, value, count(*) AS n, count(*) FILTER (h AND p) AS tp, count(*) FILTER (h AND NOT p) AS fp, count(*) FILTER (NOT h AND p) AS fn, count(*) FILTER (h <> p) AS errors, count(*) FILTER (h) AS alerts FROM u GROUP BY ALL)
SELECT *, round(errors / n, 9) AS error_rate, round(tp / nullif(alerts, 0), 9) AS precision FROM s"""


@query(SEGMENTS)
def a29_segment_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.segment_errors(scored(spark, sf_dir), 0.6, "table_id", "is_rated").withColumns({c: F.round(c, 9) for c in ("error_rate", "precision")})


@query(f"{SEGMENTS} ORDER BY errors / n DESC, dimension, value LIMIT 5")
def o8_worst_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ranking.segment_errors(scored(spark, sf_dir), 0.6, "table_id", "is_rated")
    return ranking.worst(df, 5).withColumns({c: F.round(c, 9) for c in ("error_rate", "precision")})


@query(f"""WITH {SCORED}, q AS (SELECT label, quantile_cont(wager, 0.9) AS a, quantile_cont(wager, 0.75) AS b FROM scored GROUP BY label)
SELECT bet_id, CASE WHEN label = 0 AND wager >= a THEN 1.6 WHEN label = 1 AND wager >= b THEN 1.15 ELSE 1.0 END::DOUBLE AS weight FROM scored JOIN q USING (label)""")
def m15_quantile_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.quantile_weights(scored(spark, sf_dir), F.col("wager")).select("bet_id", "weight")


@query(f"WITH {SCORED} SELECT bet_id, score >= 0.45::DOUBLE AS candidate, round(CASE WHEN score >= 0.45::DOUBLE THEN score * 0.8 ELSE 0.0 END, 9) AS fused FROM scored")
def m17_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ranking.fused(F.col("score"), F.lit(0.8), 0.5, 0.9)
    return scored(spark, sf_dir).select("bet_id", cols["candidate"].alias("candidate"), F.round(cols["fused"], 9).alias("fused"))


@query(f"""WITH {SCORED}, c AS (SELECT score, count(*) AS n FROM scored GROUP BY score), r AS (SELECT *, sum(n) OVER (ORDER BY score) AS upto, sum(n) OVER () AS total FROM c)
SELECT bet_id, CAST(least(10, floor((upto - n + (n + 1) / 2 - 0.5) / total * 10) + 1) AS INT) AS decile FROM scored JOIN r USING (score)""")
def w21_decile_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.decile_labels(scored(spark, sf_dir), "score").select("bet_id", "decile")


@query(f"""WITH {SCORED}, c AS (SELECT score, count(*) AS n FROM scored GROUP BY score), r AS (SELECT *, sum(n) OVER (ORDER BY score) AS upto, sum(n) OVER () AS total FROM c),
d AS (SELECT score, CAST(least(10, floor((upto - n + (n + 1) / 2 - 0.5) / total * 10) + 1) AS INT) AS decile FROM scored JOIN r USING (score)) SELECT decile, count(*) AS n, min(score) AS lo, max(score) AS hi FROM d GROUP BY decile""")
def w22_decile_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.decile_bounds(ranking.decile_labels(scored(spark, sf_dir), "score"), "score")


SPLIT = f"{SCORED}, o AS (SELECT *, row_number() OVER (ORDER BY us NULLS LAST, canonical_id NULLS LAST, bet_id) - 1 AS k, count(*) OVER () AS n FROM scored), s AS (SELECT *, CASE WHEN k < floor(n * 0.7) THEN 'train' WHEN k < floor(n * 0.85) THEN 'valid' ELSE 'test' END AS split FROM o)"


@query(f"WITH {SPLIT} SELECT bet_id, split FROM s")
def o2_time_ordered_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.time_ordered_split(scored(spark, sf_dir)).select("bet_id", "split")


@query(f"WITH {SPLIT} SELECT split, min(us) AS start_us, max(us) AS end_us, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives FROM s GROUP BY split")
def a28_split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_summary(splits.time_ordered_split(scored(spark, sf_dir)))


@query(f"""WITH {SCORED}, d AS (SELECT gaming_day, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM scored GROUP BY 1), t AS (SELECT *, row_number() OVER w AS k, count(*) OVER () AS total, lag(gaming_day) OVER w AS train_end, CAST(sum(n) OVER (ORDER BY gaming_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS train_rows FROM d WINDOW w AS (ORDER BY gaming_day))
SELECT CAST(row_number() OVER (ORDER BY gaming_day) AS INT) AS fold, train_end, gaming_day AS valid_period, train_rows, n AS valid_rows, pos AS valid_positives FROM t WHERE k > 1 AND k <= total - 2 AND pos >= 1""")
def o6_expanding_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.expanding_folds(scored(spark, sf_dir), "gaming_day", holdout=2)


@query(f"""WITH {SCORED}, o AS (SELECT *, row_number() OVER (ORDER BY us, bet_id) - 1 AS k, count(*) OVER () AS n FROM scored), b AS (SELECT *, least(k * 5 // n, 4) AS block FROM o),
v AS (SELECT block AS fold, min(us) AS valid_start FROM b WHERE block > 0 GROUP BY 1), r AS (SELECT fold, CASE WHEN block = fold THEN 'valid' WHEN us < valid_start - {DAY} THEN 'train' END AS role FROM b JOIN v ON block <= fold)
SELECT fold, role, count(*) AS rows FROM r WHERE role IS NOT NULL GROUP BY ALL""")
def o7_purged_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.purged_splits(scored(spark, sf_dir)).groupBy("fold", "role").agg(F.count("*").alias("rows"))


@query(f"WITH {SCORED} SELECT bet_id FROM scored ORDER BY md5(CAST(bet_id AS VARCHAR)), bet_id LIMIT 50")
def o9_hash_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.hash_top_k(scored(spark, sf_dir).select("bet_id"), 50)


@query(f"WITH {SCORED}, b AS (SELECT bet_id, CAST(floor(score * 10) AS INT) AS bin FROM scored) SELECT bin, bet_id FROM b QUALIFY row_number() OVER (PARTITION BY bin ORDER BY sha256('3:' || bet_id), bet_id) <= 20")
def o10_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scored(spark, sf_dir).select("bet_id", F.floor(F.col("score") * 10).cast("int").alias("bin"))
    return splits.stratified_sample(df, "bin", 20, 3)


@query("SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS d FROM events) WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'signup' AND value > 95)")
def o13_missing_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without a large first bet."""
    df = read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", "value")
    ends = df.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    return splits.missing_snapshots(ends.select(F.explode(F.sequence("lo", "hi")).alias("day")), df.where("event_type = 'signup' and value > 95").select("day"))


@query(f"""WITH {SCORED}, d AS (SELECT CAST(unnest(generate_series(min(gaming_day), max(gaming_day), INTERVAL 1 DAY)) AS DATE) AS day FROM scored)
SELECT canonical_id, day FROM (SELECT DISTINCT canonical_id FROM scored WHERE canonical_id IS NOT NULL) CROSS JOIN d EXCEPT SELECT canonical_id, gaming_day FROM scored""")
def o13_missing_snapshots_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.missing_snapshots_by_id(scored(spark, sf_dir).select("canonical_id", F.col("gaming_day").alias("day")))
