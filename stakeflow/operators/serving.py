"""What live scoring and its monitors compute: totals, summaries, coverage, freshness, floor occupancy, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MINUTE = 60_000_000
HOUR = 60 * MINUTE


def session_totals(bets: DataFrame) -> DataFrame:
    return bets.groupBy("session_id").agg(F.count("*").alias("bets"), F.sum("wager").alias("wager"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))


def prediction_summary(preds: DataFrame, now_us: int, window: int = 60 * MINUTE, *by: str) -> DataFrame:
    """Of the trailing window: rows, alert rate, mean score and margin, rated rows."""
    df = preds.where((F.col("us") > now_us - window) & (F.col("us") <= now_us))
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.avg(F.col("is_alert").cast("double")).alias("alert_rate"), F.avg("score").alias("mean_score"), F.avg("margin").alias("mean_margin"), F.count_if("is_rated").alias("rated"))


def alerts_per_hour(alerts: DataFrame, floor_hours: float = 1.0) -> DataFrame:
    span = F.greatest((F.max("us") - F.min("us")) / HOUR, F.lit(floor_hours))
    return alerts.agg(F.count("*").alias("alerts"), (F.count("*") / span).alias("per_hour"))


def rolling_precision(results: DataFrame, now_us: int, windows: dict[str, int]) -> DataFrame:
    """Matches by results validated in each window, in one pass."""
    inside = lambda w: (F.col("us") > now_us - w) & (F.col("us") <= now_us)
    one = results.agg(*[x for k, w in windows.items() for x in (F.count_if(inside(w)).alias(f"n_{k}"), F.count_if(inside(w) & F.col("is_match")).alias(f"m_{k}"))])
    return one.select(F.expr(f"stack({len(windows)}, {', '.join(f'{k!r}, n_{k}, m_{k}' for k in windows)}) AS (span, total, matches)")).withColumn("precision", F.col("matches") / F.nullif("total", F.lit(0)))


def freshness(df: DataFrame, now_us: int, minutes: int) -> DataFrame:
    return df.agg(F.max("us").alias("newest_us"), F.count("*").alias("rows"), F.count_if(F.col("us") > now_us - minutes * MINUTE).alias("recent"))


def coverage(scored: DataFrame, alerts: DataFrame, lo_us: int, hi_us: int) -> DataFrame:
    """Scored rows and alerts in a window, scored rows that should have alerted, alerts without a scored row,
    and alerts by scored rows."""
    inside = (F.col("us") >= lo_us) & (F.col("us") < hi_us)
    s, a = scored.where(inside).select("bet_id", "is_alert"), alerts.where(inside).select("bet_id", F.lit(1).alias("_a"))
    j = s.withColumn("_s", F.lit(1)).join(a, "bet_id", "full")
    return j.agg(F.count("_s").alias("scored"), F.count("_a").alias("alerts"), F.count_if(F.coalesce(F.col("is_alert"), F.lit(False)) & F.col("_a").isNull()).alias("missed"), F.count_if(F.col("_s").isNull()).alias("unscored"), (F.count("_a") / F.nullif(F.count("_s"), F.lit(0))).alias("alert_ratio"))


def unrated_volume(bets: DataFrame) -> DataFrame:
    return bets.agg(F.count_if("is_rated").alias("rated"), F.count_if(~F.col("is_rated")).alias("unrated"), F.count_distinct(F.when(~F.col("is_rated"), F.col("player_id"))).alias("unrated_players"))


def floor_occupancy(seats: DataFrame) -> DataFrame:
    """One row a table of open sessions (table_id, seat, session_id, us, avg_bet, last_bet): the newest at each seat, its
    bet by average, else last, else 0; sums, averages and active seats, with the seats as a map."""
    w = Window.partitionBy("table_id", "seat").orderBy(F.desc("us"), F.desc("session_id"))
    one = seats.withColumn("_k", F.row_number().over(w)).where("_k = 1")
    one = one.withColumn("bet", F.coalesce(F.when(F.col("avg_bet") > 0, F.col("avg_bet")), "last_bet", F.lit(0.0)))
    return one.groupBy("table_id").agg(F.count("*").alias("active_seats"), F.sum("bet").alias("sum_bet"), F.avg("bet").alias("avg_bet"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("seat").cast("string"), F.struct("session_id", "bet").alias("v"))))).alias("seats"))


def floor_totals(occupancy: DataFrame) -> DataFrame:
    """One row over the tables of ``floor_occupancy``: tables, seats, and the sum and average of the seats' bets."""
    return occupancy.agg(F.count("*").alias("tables"), F.coalesce(F.sum("active_seats"), F.lit(0)).alias("seats"), F.sum("sum_bet").alias("sum_bet"), (F.sum("sum_bet") / F.nullif(F.sum("active_seats"), F.lit(0))).alias("avg_bet"))


def new_alerts(scored: DataFrame, sent: DataFrame, threshold: float, floor_us: int) -> DataFrame:
    """Rated rows at or above the threshold, not before the floor, and not yet sent; with margin and reason of score."""
    df = scored.withColumn("margin", F.col("score") - threshold).where((F.col("margin") >= 0) & F.col("is_rated") & (F.col("us") >= floor_us))
    return df.join(sent.select("bet_id").distinct(), "bet_id", "left_anti")


def touched_history(bets: DataFrame, new: DataFrame, mapping: DataFrame) -> DataFrame:
    """All bets of players that share a canonical id with a new bet's player."""
    of = mapping.join(new.select("player_id").distinct(), "player_id", "left_semi").select("canonical_id").distinct()
    players = mapping.join(of, "canonical_id", "left_semi").select("player_id").unionByName(new.select("player_id")).distinct()
    return bets.join(players, "player_id", "left_semi")


def effective_threshold(runtime: DataFrame, bundle: float, now_us: int, max_age: int | None = None) -> DataFrame:
    """threshold and source: the newest runtime one (us, threshold) that isn't older than ``max_age``, else the bundle's."""
    near = F.col("us").isNotNull() & F.col("threshold").isNotNull() & (F.col("us") <= now_us)
    near = near if max_age is None else near & (F.col("us") >= now_us - max_age)
    best = runtime.agg(F.max_by("threshold", F.when(near, F.col("us"))).alias("t"))
    return best.select(F.coalesce("t", F.lit(bundle)).alias("threshold"), F.when(F.col("t").isNull(), "bundle").otherwise("runtime").alias("source"))


def alert_context(alerts: DataFrame, bets: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Adds the session's totals, the player's sessions, and the player's average wager. With ``state`` (session_id, bets,
    wager), what was known of sessions before, the greater of both totals."""
    player = bets.groupBy("player_id").agg(F.count_distinct("session_id").alias("player_sessions"), F.avg("wager").alias("player_average"))
    totals = session_totals(bets).select("session_id", F.col("bets").alias("session_bets"), F.col("wager").alias("session_wager"))
    if state is not None:
        totals = totals.join(state.select("session_id", "bets", "wager"), "session_id", "full")
        totals = totals.select("session_id", F.greatest("session_bets", "bets").alias("session_bets"), F.greatest("session_wager", "wager").alias("session_wager"))
    return alerts.join(totals, "session_id", "left").join(player, "player_id", "left")


def merge_verdicts(old: DataFrame, new: DataFrame, now_us: int, finality: int = HOUR) -> DataFrame:
    """Old and new verdicts of alerts (alert_id, alert_us, verdict): new ones, upgrades to MATCH and PENDING to MISS
    are taken; what is pending past finality is MISS."""
    o = old.select("alert_id", F.col("alert_us").alias("_ou"), F.col("verdict").alias("_ov"))
    n = new.select("alert_id", F.col("alert_us").alias("_nu"), F.col("verdict").alias("_nv"))
    j = o.join(n, "alert_id", "full").withColumn("alert_us", F.coalesce("_ou", "_nu"))
    taken = F.when(F.col("_ov").isNull(), F.col("_nv")).when(F.col("_nv") == "MATCH", "MATCH").when((F.col("_ov") == "PENDING") & (F.col("_nv") == "MISS"), "MISS").otherwise(F.col("_ov"))
    final = F.when((taken == "PENDING") & (F.lit(now_us) - F.col("alert_us") > finality), "MISS").otherwise(taken)
    return j.select("alert_id", "alert_us", final.alias("verdict"))


def latest_version(rows: DataFrame) -> DataFrame:
    """The newest non-empty model version."""
    return rows.agg(F.max_by("model_version", F.when(F.coalesce(F.trim("model_version"), F.lit("")) != "", F.col("us"))).alias("model_version"))
