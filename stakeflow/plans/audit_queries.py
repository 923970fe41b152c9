"""Queries of audits, comparisons, serving and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.operators import audit, rules, serving
from stakeflow.plans.adapters import BETS, DAY, MINUTE, SCORED, SESSIONS, bets, read, scored, sessions
from stakeflow.plans.ranking_queries import curve_sql
from stakeflow.plans.sequence_queries import END, LATEST, MAPPING

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str = ""):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[(F.round(c, digits) + 0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(f"""WITH {BETS}, d AS (SELECT table_id, (etl_us - us) / 1000000 AS d FROM bets)
SELECT table_id, round(quantile_cont(d, 0.5), 6) + 0 AS p50, round(quantile_cont(d, 0.95), 6) + 0 AS p95, round(quantile_cont(d, 0.99), 6) + 0 AS p99, max(d) AS max_sec, count(*) AS rows, count(*) FILTER (d > 300) AS late, round(count(*) FILTER (d > 300) / count(*), 6) + 0 AS late_ratio FROM d GROUP BY table_id""")
def a9_ingest_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(audit.ingest_delay(bets(spark, sf_dir), "us", "etl_us", 300, "table_id"))


@query(f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS rows, count(*) - count(d) AS nulls, count(*) FILTER (d >= -1) AS in_1970, round(count(*) FILTER (d < 0) / count(d), 6) + 0 AS negative, round(count(*) FILTER (d <= 60) / count(d), 6) + 0 AS in_1m, round(count(*) FILTER (d <= 420) / count(d), 6) + 0 AS in_7m, round(count(*) FILTER (d > 86400) / count(d), 6) + 0 AS over_1d,
round(avg(d), 6) + 0 AS mean, round(stddev_samp(d), 6) + 0 AS sd, min(d)::DOUBLE AS least, max(d)::DOUBLE AS most, {", ".join(f"round(quantile_cont(d, {p}), 6) + 0 AS p{int(100 * p)}" for p in (0.5, 0.9, 0.95, 0.99))} FROM (SELECT o_orderdate, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey * 37 % 100000 - CASE WHEN o_orderkey % 7 = 0 THEN 40000000 ELSE 0 END END AS d FROM orders) GROUP BY 1""")
def a10_delay_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"), F.lit(0).cast("long").alias("us"), F.when(F.col("o_orderkey") % 10 != 0, (F.col("o_orderkey") * 37 % 100000 - F.when(F.col("o_orderkey") % 7 == 0, 40_000_000).otherwise(0)) * 1_000_000).alias("etl_us"))
    return rounded(audit.delay_profile(o, "month"))


@query(f"""WITH {BETS}, h AS (SELECT CAST('0x' || substr(sha256('bet_id=v' || bet_id || chr(31) || 'player_id=v' || player_id || chr(31) || 'status=v' || status || chr(31) || 'us=v' || us), 1, 15) AS BIGINT) AS h FROM bets)
SELECT count(*) AS rows, CAST(sum(h) AS VARCHAR) AS sum, bit_xor(h) AS xor, CAST(sum(CAST(h % 1073741824 AS HUGEINT) * (h % 1073741824)) AS VARCHAR) AS squares FROM h""")
def a12_frame_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.frame_digest(bets(spark, sf_dir).select("bet_id", "player_id", "us", "status"))


STATS = " UNION ALL ".join(f"SELECT '{c}' AS feature_name, {c} AS v FROM lineitem" for c in NUMBERS)


@query(f"""SELECT feature_name, count(*) AS rows, count(*) FILTER (v IS NULL) AS nulls, count(*) FILTER (v = 0) AS zeros, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std, min(v) AS min, max(v) AS max,
{", ".join(f"round(quantile_cont(v, {p}), 4) AS {n}" for p, n in ((0.01, "p1"), (0.05, "p5"), (0.5, "p50"), (0.95, "p95"), (0.99, "p99")))} FROM ({STATS}) GROUP BY feature_name""")
def a20_feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = audit.feature_stats(read(spark, sf_dir, "lineitem"), NUMBERS)
    return df.select(*[F.round(c, 4).alias(c) if c in ("mean", "std", "p1", "p5", "p50", "p95", "p99") else c for c in df.columns])


@query(f"SELECT feature_name, round(stddev_pop(v), 4) AS std FROM ({STATS}) GROUP BY feature_name")
def a21_column_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(audit.column_std(read(spark, sf_dir, "lineitem"), NUMBERS), 4)


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(abs(corr({a}, {b})), 6) + 0 AS r FROM lineitem" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]))
def a22_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(audit.correlations(read(spark, sf_dir, "lineitem"), NUMBERS))


def _information(c: str) -> str:
    return f"""(WITH b AS (SELECT l_returnflag = 'R' AS y, least(9, floor(({c} - lo) / nullif(hi - lo, 0) * 10)) AS bin FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem)),
n AS (SELECT bin, y, count(*) AS n FROM b GROUP BY ALL), s AS (SELECT n, sum(n) OVER () AS a, sum(n) OVER (PARTITION BY bin) AS nb, sum(n) OVER (PARTITION BY y) AS ny FROM n) SELECT '{c}' AS feature_name, round(sum(n / a * ln(n * a / (nb * ny))), 9) + 0 AS information FROM s)"""


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT * FROM {_information(c)}" for c in NUMBERS) + ") ORDER BY information DESC, feature_name LIMIT 3")
def a24_screen_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "lineitem").withColumns({"label": (F.col("l_returnflag") == "R").cast("int"), "twice": F.col("l_quantity") * 2, "same": F.lit(1.0)})
    return rounded(audit.screen_features(df, [*NUMBERS, "twice", "same"], k=3), 9)


@query()
def a24_tree_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "lineitem").withColumns({"label": (F.col("l_returnflag") == "R").cast("int"), "twice": F.col("l_quantity") * 2, "same": F.lit(1.0)})
    return rounded(audit.screened(df, [*NUMBERS, "twice", "same"], method="information_then_trees", k=3), 9)


@query(f"WITH {SESSIONS}, c AS (SELECT session_id, count(*) AS versions FROM sessions GROUP BY 1) SELECT versions, count(*) AS keys FROM c GROUP BY 1")
def a33_version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.version_counts(sessions(spark, sf_dir), "session_id")


@query(f"WITH {SESSIONS} SELECT is_manual, count(*) AS rows, min(start_us) AS min_start_us, max(start_us) AS max_start_us, min(turnover) AS min_turnover, max(turnover) AS max_turnover FROM sessions GROUP BY 1")
def a34_manual_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.bounds_by(sessions(spark, sf_dir), "is_manual", "start_us", "turnover")


@query(f"WITH {SESSIONS} SELECT is_manual, CASE WHEN casino_player_id IS NULL THEN 'null' WHEN trim(casino_player_id) = '' THEN 'empty' WHEN lower(trim(casino_player_id)) = 'null' THEN 'text null' ELSE 'present' END AS kind, count(*) AS rows FROM sessions GROUP BY ALL")
def a35_missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.missing_ids(sessions(spark, sf_dir), "casino_player_id", "is_manual")


@query(f"WITH {BETS}, k AS (SELECT player_id, bool_or(status = 'WIN') AS a, bool_or(wager > 100) AS b FROM bets GROUP BY 1) SELECT count(*) FILTER (a) AS first, count(*) FILTER (b) AS second, count(*) FILTER (a AND b) AS both FROM k")
def a36_status_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.status_overlap(bets(spark, sf_dir), "player_id", F.col("status") == "WIN", F.col("wager") > 100)


@query(f"WITH {SESSIONS} SELECT 'negative_win' AS check_name, count(*) FILTER (player_win < 0) AS failed, round(count(*) FILTER (player_win < 0) / count(*), 6) + 0 AS share FROM sessions UNION ALL SELECT 'no_turnover', count(*) FILTER (turnover = 0), round(count(*) FILTER (turnover = 0) / count(*), 6) + 0 FROM sessions UNION ALL SELECT 'extreme', count(*) FILTER (turnover > 300000), round(count(*) FILTER (turnover > 300000) / count(*), 6) + 0 FROM sessions")
def a37_value_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(audit.value_checks(sessions(spark, sf_dir), {"negative_win": F.col("player_win") < 0, "no_turnover": F.col("turnover") == 0, "extreme": F.col("turnover") > 300000}))


@query(f"WITH {SESSIONS} SELECT end_us IS NULL AS no_end_us, casino_player_id IS NULL AS no_casino_player_id, count(*) AS rows FROM sessions GROUP BY ALL")
def a38_null_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.null_patterns(sessions(spark, sf_dir), "end_us", "casino_player_id")


@query(f"""WITH {SESSIONS}, s AS (SELECT DISTINCT player_id, casino_player_id FROM sessions WHERE casino_player_id IS NOT NULL), x AS (SELECT player_id, count(*) AS n FROM s GROUP BY 1), y AS (SELECT casino_player_id, count(*) AS n FROM s GROUP BY 1)
SELECT 'player_id to casino_player_id' AS direction, n, count(*) AS keys FROM x GROUP BY n UNION ALL SELECT 'casino_player_id to player_id', n, count(*) FROM y GROUP BY n""")
def a39_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.cardinality(sessions(spark, sf_dir), "player_id", "casino_player_id")


@query(f"WITH {SESSIONS}, {LATEST}, l AS (SELECT *, (lud_us - end_us) / 1000000 AS lag FROM latest) SELECT count(*) AS rows, count(*) FILTER (start_us IS NULL) AS no_start, count(*) FILTER (end_us IS NULL) AS no_end, count(*) FILTER (end_us < start_us) AS negative, {', '.join(f'round(quantile_cont({e}, {p}), 6) + 0 AS p{int(100 * p)}_{n}' for n, e in (('lag', 'lag'), ('duration', '(end_us - start_us) / 60000000'), ('load', '(etl_us - lud_us) / 1000000')) for p in (0.5, 0.9, 0.99))} FROM l")
def a41_time_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(audit.time_quality(sessions(spark, sf_dir)))


@query(f"""WITH {SESSIONS}, c AS (SELECT *, CASE WHEN lower(trim(casino_player_id)) IN ('', 'null') THEN NULL ELSE trim(casino_player_id) END AS card FROM sessions)
SELECT session_id, count(*) AS versions, max(card) AS card FROM c GROUP BY session_id HAVING count(*) > 1 AND arg_min(coalesce(card, ''), lud_us) = '' AND max(card) IS NOT NULL""")
def a42_late_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.late_cards(sessions(spark, sf_dir))


@query(f"WITH {SCORED}, b AS (SELECT bet_id, round(score + CASE WHEN bet_id % 10 = 0 THEN 0.01 ELSE 0 END, 6) AS score, label FROM scored WHERE bet_id % 3 <> 0), j AS (SELECT a.score AS x, b.score AS y, a.label AS p, b.label AS q FROM (SELECT bet_id, round(score, 6) AS score, label FROM scored) a JOIN b USING (bet_id)) SELECT count(*) AS rows, 'score' AS column_name, count(*) FILTER (x IS DISTINCT FROM y) AS differ FROM j UNION ALL SELECT count(*), 'label', count(*) FILTER (p IS DISTINCT FROM q) FROM j")
def j22_frame_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = scored(spark, sf_dir).select("bet_id", F.round("score", 6).alias("score"), "label")
    b = a.where("bet_id % 3 <> 0").withColumn("score", F.round(F.col("score") + F.when(F.col("bet_id") % 10 == 0, 0.01).otherwise(0), 6))
    return audit.frame_diff(a, b, "bet_id")


@query("""WITH s AS (SELECT l_linenumber % 2 AS side, feature_name, v FROM (SELECT l_linenumber, 'l_quantity' AS feature_name, l_quantity AS v FROM lineitem UNION ALL SELECT l_linenumber, 'l_tax', l_tax FROM lineitem)),
a AS (SELECT side, feature_name, avg(v) AS m, quantile_cont(v, 0.5) AS h, quantile_cont(v, 0.95) AS t FROM s GROUP BY ALL)
SELECT x.feature_name, round(y.m - x.m, 6) + 0 AS mean_diff, round(y.h - x.h, 6) + 0 AS p50_diff, round(y.t - x.t, 6) + 0 AS p95_diff, 0.0::DOUBLE AS null_rate_diff FROM a x JOIN a y ON x.feature_name = y.feature_name AND x.side = 0 AND y.side = 1""")
def j23_stats_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem")
    return rounded(audit.stats_compare(l.where("l_linenumber % 2 = 0"), l.where("l_linenumber % 2 = 1"), ["l_quantity", "l_tax"]))


@query(f"""WITH {SCORED}, a AS (SELECT bet_id, score FROM scored WHERE bet_id % 5 <> 0), b AS (SELECT bet_id, score + CASE WHEN bet_id % 7 = 0 THEN 0.25 ELSE 0 END AS score FROM scored WHERE bet_id % 3 <> 0)
SELECT count(a.bet_id) AS left_rows, count(b.bet_id) AS right_rows, count(*) FILTER (b.bet_id IS NULL) AS only_left, count(*) FILTER (a.bet_id IS NULL) AS only_right, round(max(abs(a.score - b.score)), 6) + 0 AS max_diff, count(*) FILTER (abs(a.score - b.score) > 0.000001) AS over_tolerance FROM a FULL JOIN b ON a.bet_id = b.bet_id""")
def j24_alert_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    b = s.where("bet_id % 3 <> 0").withColumn("score", F.col("score") + F.when(F.col("bet_id") % 7 == 0, 0.25).otherwise(0.0))
    return rounded(audit.alert_diff(s.where("bet_id % 5 <> 0"), b))


@query("SELECT l_orderkey FROM lineitem WHERE l_quantity > 45 EXCEPT SELECT o_orderkey FROM orders WHERE o_totalprice > 200000")
def u2_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_orderkey").subtract(read(spark, sf_dir, "orders").where("o_totalprice > 200000").select("o_orderkey"))


@query("SELECT l_orderkey FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT o_orderkey FROM orders WHERE o_totalprice > 200000")
def u3_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_orderkey").intersect(read(spark, sf_dir, "orders").where("o_totalprice > 200000").select("o_orderkey"))


def _drift(c: str) -> str:
    return f"""(WITH e AS (SELECT l_shipdate < TIMESTAMP '1995-01-01' AS r, greatest(0, least(9, floor(({c} - lo) / nullif(hi - lo, 0) * 10))) AS bin FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-01-01')),
g AS (SELECT k.bin, count(*) FILTER (r) AS r, count(*) FILTER (NOT r) AS c FROM (SELECT unnest(range(10))::DOUBLE AS bin) k LEFT JOIN e USING (bin) GROUP BY k.bin),
s AS (SELECT greatest(coalesce(r / nullif(sum(r) OVER (), 0), 0), 1e-6) AS pr, greatest(coalesce(c / nullif(sum(c) OVER (), 0), 0), 1e-6) AS pc, abs(coalesce(sum(r) OVER (ORDER BY bin) / nullif(sum(r) OVER (), 0), 0) - coalesce(sum(c) OVER (ORDER BY bin) / nullif(sum(c) OVER (), 0), 0)) AS k FROM g) SELECT '{c}' AS feature_name, round(sum((pc - pr) * ln(pc / pr)), 9) + 0 AS psi, round(max(k), 9) + 0 AS ks FROM s)"""


@query(" UNION ALL ".join(f"SELECT * FROM {_drift(c)}" for c in NUMBERS))
def m23_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem")
    return rounded(audit.drift(l.where("l_shipdate < '1995-01-01'"), l.where("l_shipdate >= '1995-01-01'"), NUMBERS), 9)


@query(f"WITH {BETS} SELECT session_id, count(*) AS bets, round(sum(wager), 6) + 0 AS wager, min(us) AS first_us, max(us) AS last_us FROM bets GROUP BY 1")
def a16_session_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.session_totals(bets(spark, sf_dir)))


NOW = END - 5 * DAY


@query(f"WITH {SCORED} SELECT table_id, count(*) AS rows, round(avg(CASE WHEN score >= 0.6 AND is_rated THEN 1.0 ELSE 0.0 END), 6) + 0.0::DOUBLE AS alert_rate, round(avg(score), 6) + 0 AS mean_score, round(avg(score - 0.6), 6) + 0 AS mean_margin, count(*) FILTER (is_rated) AS rated FROM scored WHERE us > {NOW - 3 * DAY} AND us <= {NOW} GROUP BY 1")
def a17_prediction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = scored(spark, sf_dir).withColumns({"margin": F.col("score") - 0.6, "is_alert": (F.col("score") >= 0.6) & F.col("is_rated")})
    return rounded(serving.prediction_summary(p, NOW, 3 * DAY, "table_id"))


@query(f"WITH {SCORED} SELECT count(*) AS alerts, round(count(*) / greatest((max(us) - min(us)) / {60 * MINUTE}, 1.0), 6) + 0 AS per_hour FROM scored WHERE score >= 0.6")
def a18_alerts_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.alerts_per_hour(scored(spark, sf_dir).where("score >= 0.6")))


@query(f"WITH {SCORED}, a AS (SELECT us, label = 1 AS m FROM scored WHERE score >= 0.6), w(span, w) AS (VALUES ('day', {DAY}), ('week', {7 * DAY})) SELECT span, count(*) AS total, count(*) FILTER (m) AS matches, round(count(*) FILTER (m) / count(*), 6) + 0 AS precision FROM w JOIN a ON us > {NOW} - w AND us <= {NOW} GROUP BY span")
def a19_rolling_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = scored(spark, sf_dir).where("score >= 0.6").withColumn("is_match", F.col("label") == 1)
    return rounded(serving.rolling_precision(a, NOW, {"day": DAY, "week": 7 * DAY}))


@query(f"WITH {SCORED}, s AS (SELECT bet_id, us, score >= 0.6 AS al FROM scored WHERE bet_id % 5 <> 0), a AS (SELECT bet_id, us FROM scored WHERE score >= 0.6 AND bet_id % 4 <> 0), j AS (SELECT s.bet_id AS s, a.bet_id AS a, al FROM (SELECT * FROM s WHERE us < {NOW}) s FULL JOIN (SELECT * FROM a WHERE us < {NOW}) a ON s.bet_id = a.bet_id) SELECT count(s) AS scored, count(a) AS alerts, round(count(a) / count(s), 9) AS alert_ratio, count(*) FILTER (coalesce(al, FALSE) AND a IS NULL) AS missed, count(*) FILTER (s IS NULL) AS unscored FROM j")
def a26_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir).withColumn("is_alert", F.col("score") >= 0.6)
    return rounded(serving.coverage(s.where("bet_id % 5 <> 0"), s.where("is_alert and bet_id % 4 <> 0"), 0, NOW), 9)


@query(f"WITH {BETS} SELECT max(us) AS newest_us, count(*) AS rows, count(*) FILTER (us > {NOW} - 36000000000) AS recent FROM bets")
def a27_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.freshness(bets(spark, sf_dir), NOW, 600)


@query(f"WITH {BETS}, seats AS (SELECT table_id, bet_id % 5 AS seat, session_id, us, bet_id FROM bets), k AS (SELECT * FROM seats QUALIFY row_number() OVER (PARTITION BY table_id, seat ORDER BY us DESC, session_id DESC) = 1), w AS (SELECT k.*, b.wager FROM k JOIN bets b USING (bet_id)) SELECT table_id, count(*) AS active_seats, round(sum(wager), 6) + 0 AS sum_bet, round(avg(wager), 6) + 0 AS avg_bet FROM w GROUP BY 1")
def a32_floor_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir).select("table_id", (F.col("bet_id") % 5).alias("seat"), "session_id", "us", F.when(F.col("bet_id") % 2 == 0, F.col("wager")).alias("avg_bet"), F.col("wager").alias("last_bet"))
    return rounded(serving.floor_occupancy(b).drop("seats"))


SEATS = f"{BETS}, k AS (SELECT table_id, bet_id % 5 AS seat, session_id, us, bet_id, wager FROM bets QUALIFY row_number() OVER (PARTITION BY table_id, bet_id % 5 ORDER BY us DESC, session_id DESC) = 1)"


def _floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir).select("table_id", (F.col("bet_id") % 5).alias("seat"), "session_id", "us", F.when(F.col("bet_id") % 2 == 0, F.col("wager")).alias("avg_bet"), F.col("wager").alias("last_bet"))
    return serving.floor_occupancy(b)


@query(f"WITH {SEATS} SELECT table_id, CAST(seat AS VARCHAR) AS seat, session_id, round(wager, 6) AS bet FROM k")
def a32_floor_seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested seats of each table, a row each."""
    seats = _floor(spark, sf_dir).select("table_id", F.explode("seats").alias("seat", "v"))
    return seats.select("table_id", "seat", "v.session_id", F.round("v.bet", 6).alias("bet"))


@query(f"WITH {SEATS} SELECT count(DISTINCT table_id) AS tables, count(*) AS seats, round(sum(wager), 6) AS sum_bet, round(avg(wager), 6) AS avg_bet FROM k")
def a32_floor_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.floor_totals(_floor(spark, sf_dir)))


@query(f"WITH {BETS} SELECT count(*) FILTER (player_id % 4 <> 0) AS rated, count(*) FILTER (player_id % 4 = 0) AS unrated, count(DISTINCT player_id) FILTER (player_id % 4 = 0) AS unrated_players FROM bets")
def a43_unrated_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.unrated_volume(bets(spark, sf_dir).withColumn("is_rated", F.col("player_id") % 4 != 0))


@query(f"WITH {SCORED} SELECT bet_id, round(score - 0.6, 6) + 0 AS margin FROM scored WHERE score - 0.6::DOUBLE >= 0 AND is_rated AND us >= {NOW} AND bet_id % 9 <> 0")
def j26_new_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    return rounded(serving.new_alerts(s, s.where("bet_id % 9 = 0"), 0.6, NOW).select("bet_id", "margin"))


@query(f"WITH {BETS}, m AS (SELECT DISTINCT player_id, player_id // 3 AS canonical_id FROM bets), n AS (SELECT DISTINCT player_id FROM bets WHERE us >= {END - 6 * 60 * MINUTE}), p AS (SELECT player_id FROM m WHERE canonical_id IN (SELECT canonical_id FROM m JOIN n USING (player_id)) UNION SELECT player_id FROM n) SELECT bet_id FROM bets WHERE player_id IN (SELECT player_id FROM p)")
def j27_touched_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir)
    m = b.select("player_id").distinct().withColumn("canonical_id", F.floor(F.col("player_id") / 3))
    return serving.touched_history(b, b.where(F.col("us") >= END - 6 * 60 * MINUTE), m).select("bet_id")


@query(f"WITH {BETS}, t AS (SELECT session_id, count(*) AS session_bets, sum(wager) AS session_wager FROM bets GROUP BY 1), p AS (SELECT player_id, count(DISTINCT session_id) AS player_sessions, avg(wager) AS player_average FROM bets GROUP BY 1) SELECT bet_id, session_bets, round(session_wager, 6) + 0 AS session_wager, player_sessions, round(player_average, 9) + 0 AS player_average FROM bets JOIN t USING (session_id) JOIN p USING (player_id) WHERE wager > 60")
def j25_alert_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bets(spark, sf_dir)
    return rounded(serving.alert_context(b.where("wager > 60").select("bet_id", "session_id", "player_id"), b).select("bet_id", "session_bets", "session_wager", "player_sessions", "player_average"), 9)


@query(f"WITH {SCORED}, v AS (SELECT bet_id AS alert_id, us, CASE bet_id % 3 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'MISS' ELSE 'MATCH' END AS o, CASE bet_id % 4 WHEN 0 THEN 'MATCH' WHEN 1 THEN 'MISS' ELSE 'PENDING' END AS n FROM scored), t AS (SELECT alert_id, us, CASE WHEN n = 'MATCH' THEN 'MATCH' WHEN o = 'PENDING' AND n = 'MISS' THEN 'MISS' ELSE o END AS k FROM v) SELECT alert_id, CASE WHEN k = 'PENDING' AND {NOW} - us > {DAY} THEN 'MISS' ELSE k END AS verdict FROM t")
def w19_merge_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir).select(F.col("bet_id").alias("alert_id"), F.col("us").alias("alert_us"))
    k = F.col("alert_id")
    old = s.withColumn("verdict", F.when(k % 3 == 0, "PENDING").when(k % 3 == 1, "MISS").otherwise("MATCH"))
    new = s.withColumn("verdict", F.when(k % 4 == 0, "MATCH").when(k % 4 == 1, "MISS").otherwise("PENDING"))
    return serving.merge_verdicts(old, new, NOW, DAY).select("alert_id", "verdict")


@query(f"""WITH {SCORED.replace("scored AS", "base AS")}, scored AS (SELECT 'pace' AS rule, -wager AS score, label FROM base UNION ALL SELECT 'score', score, label FROM base), {curve_sql("rule")},
b AS (SELECT * FROM curve WHERE alerts >= 5 AND recall >= 0.1 QUALIFY row_number() OVER (PARTITION BY rule ORDER BY round(precision, 12) DESC, threshold) = 1), ap AS (SELECT rule, sum(gain * precision) AS a FROM curve GROUP BY rule)
SELECT rule, round(a, 6) + 0 AS average_precision, threshold, round(precision, 6) + 0 AS precision FROM ap JOIN b USING (rule)""")
def m14_baseline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = rules.baseline_report(scored(spark, sf_dir), {"pace": rules.pace_rule(F.col("wager")), "score": rules.single_feature(F.col("score"))})
    return rounded(got.select("rule", "average_precision", "threshold", "precision"))


@query(f"""WITH {MAPPING} SELECT player_id, round(coalesce(-sum(player_win) / nullif(sum(turnover), 0), 0), 9) + 0 AS loss, round(sum(theo_win) / greatest(avg(theo_win) * 2, 1e-6), 6) + 0 AS adt FROM latest GROUP BY player_id""")
def m13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stakeflow.operators.dedup import dedup_sessions

    by = dedup_sessions(sessions(spark, sf_dir)).groupBy("player_id").agg(F.sum("player_win").alias("w"), F.sum("turnover").alias("t"), F.sum("theo_win").alias("theo"), F.avg("theo_win").alias("adt"))
    return by.select("player_id", (F.round(rules.loss_rule(F.col("w"), F.col("t")), 9) + 0).alias("loss"), (F.round(rules.adt_rule(F.col("theo"), F.col("adt"), 2.0), 6) + 0).alias("adt"))
