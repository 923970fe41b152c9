"""What live scoring and validation fetch: recent bets, their sessions, alerts by seat, and bets of an identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeflow.operators import ranking, sequence, serving
from stakeflow.operators.dedup import newest, only_ids, unflagged

MINUTE = 60_000_000
DAY = 1440 * MINUTE
PLACEHOLDER = -1


def real(df: DataFrame) -> DataFrame:
    return df.where(F.col("player_id").isNotNull() & (F.col("player_id") != PLACEHOLDER))


def scan_bets_live(bets: DataFrame, start_us: int, now_us: int, delay: int = MINUTE) -> DataFrame:
    """Bets with a wager of real players from ``start`` to ``delay`` ago; their day is the event's where it is missing."""
    df = real(bets).where((F.col("us") >= start_us) & (F.col("us") <= now_us - delay) & (F.col("wager") > 0))
    return df.withColumn("gaming_day", F.coalesce("gaming_day", F.to_date(F.timestamp_micros("us"))))


def session_enrich(bets: DataFrame, sessions: DataFrame) -> DataFrame:
    """Adds session_start_us, session_end_us and casino_player_id of the session row of the latest end, open ones last of
    all; the bet's own time where there is none."""
    last = newest(sessions.select("session_id", "start_us", "end_us", "casino_player_id"), "session_id", F.desc_nulls_first("end_us"))
    df = bets.join(last.select("session_id", F.col("start_us").alias("_s"), F.col("end_us").alias("_e"), "casino_player_id"), "session_id", "left")
    return df.withColumns({"session_start_us": F.coalesce("_s", "us"), "session_end_us": F.coalesce("_e", "us")}).drop("_s", "_e")


def alert_players(alerts: DataFrame) -> DataFrame:
    """player_id to canonical_id of the alerts; a player of several goes with the first by name, one of none stands alone."""
    df = real(alerts).select("player_id", F.coalesce("canonical_id", F.col("player_id").cast("string")).alias("canonical_id"))
    return df.groupBy("player_id").agg(F.min("canonical_id").alias("canonical_id"))


def bets_of_identities(bets: DataFrame, players: DataFrame, start_us: int, end_us: int) -> DataFrame:
    """canonical_id, bet_id and us of bets with a wager in ``[start, end]``, a row each, of the players of ``players``."""
    df = real(bets).where((F.col("us") >= start_us) & (F.col("us") <= end_us) & (F.col("wager") > 0))
    return df.select("player_id", "bet_id", "us").join(players, "player_id").select("canonical_id", "bet_id", "us")


#: Rows of ``bets_by_id`` that a task puts in order, about.
TASK_ROWS = 500_000


def bets_by_id(bets: DataFrame, ids: DataFrame) -> DataFrame:
    """bet_id, us and the real player's id of the newest row of each bet in ``ids``; null for the placeholder.

    Rows are dealt into as many parts as their number asks for, whatever the session shuffles into, so that a task's memory
    doesn't grow with the table; only what the order and the result need is dealt."""
    tie = F.xxhash64("bet_id", *[c for c in bets.columns if c != "bet_id"])
    parts = max(bets.sparkSession.sparkContext.defaultParallelism, -(-bets.count() // TASK_ROWS))
    rows = bets.select("bet_id", "us", "player_id", tie.alias("_tie")).repartition(parts, "bet_id")
    df = newest(only_ids(rows, ids.select("bet_id").repartition(parts, "bet_id"), "bet_id"), "bet_id", F.desc_nulls_last("us"), F.col("_tie"))
    return df.select("bet_id", "us", F.when(F.col("player_id") != PLACEHOLDER, F.col("player_id")).alias("player_id"))


def sessions_of_identities(sessions: DataFrame, players: DataFrame, start_us: int, end_us: int, margin: int = DAY) -> DataFrame:
    """canonical_id, session_id, available_us and end_us of unflagged sessions with wagers around a window, newest first."""
    near = (F.coalesce("end_us", "lud_us") >= start_us - margin) & (F.coalesce("end_us", "lud_us") <= end_us + margin)
    df = unflagged(sessions.where(near), "is_manual", "is_deleted", "is_canceled")
    df = newest(df, "session_id", F.desc_nulls_last("lud_us"), F.desc_nulls_last("etl_us")).where("coalesce(turnover, 0) > 0 or coalesce(num_games_with_wager, 0) > 0")
    return df.join(players, "player_id").select("canonical_id", "session_id", F.coalesce("end_us", "lud_us").alias("available_us"), "end_us")


def validated(alerts: DataFrame, bets: DataFrame, now_us: int, players: DataFrame | None = None, **times) -> DataFrame:
    """alert_id, alert_us and verdict of alerts (alert_id, player_id, canonical_id, alert_us), by the bets of all players
    of their identity, those of the alerts if ``players`` (player_id, canonical_id) doesn't name them. Where an identity has no bet, the alert's own bet, looked up by its id, is its last one."""
    players = alert_players(alerts) if players is None else players
    lo, hi = alerts.agg(F.min("alert_us"), F.max("alert_us")).first()
    if lo is None:
        return alerts.select("alert_id", "alert_us", F.lit(None).cast("string").alias("verdict"))
    known = alerts.select("alert_id", F.coalesce("canonical_id", F.col("player_id").cast("string")).alias("player_id"), "alert_us")
    seen = bets_of_identities(bets, players, lo, min(now_us, hi + 45 * MINUTE)).select(F.col("canonical_id").alias("player_id"), "us")
    gaps = sequence.alert_gaps(known, seen).join(alerts.select("alert_id", "alert_us"), "alert_id")
    any_bet = seen.select("player_id").distinct()
    found = known.join(any_bet, "player_id", "left_anti").select("alert_id", F.col("alert_id").alias("bet_id"))
    own = bets_by_id(bets, found).select(F.col("bet_id").alias("alert_id"), F.lit(1).alias("_own"))
    gaps = gaps.join(own, "alert_id", "left").withColumn("n_bets", F.col("n_bets") + F.coalesce("_own", F.lit(0)))
    return sequence.verdicts(gaps, now_us, **times).select("alert_id", "alert_us", "verdict")


def revalidated(stored: DataFrame, alerts: DataFrame, bets: DataFrame, now_us: int, finality: int = 60 * MINUTE, last_us: int | None = None) -> DataFrame:
    """Stored verdicts (alert_id, alert_us, verdict) after late bets: those that aren't final are told again over all bets
    that are there now, and merged by the rules of finality. With ``last_us``, when the stored ones were told, those that
    finality had passed by then are final too."""
    final = F.col("verdict") == "MATCH"
    final = final if last_us is None else final | (F.lit(last_us) - F.col("alert_us") > finality)
    open_ = alerts.join(stored.where(final).select("alert_id"), "alert_id", "left_anti")
    return serving.merge_verdicts(stored, validated(open_, bets, now_us, alert_players(alerts)), now_us, finality)


def latest_by_seat(alerts: DataFrame, *columns: str) -> DataFrame:
    """The columns of the newest alert of each table and seat; seats as whole numbers in text, whatever they came as."""
    seat = F.coalesce(F.col("position_idx").cast("string").try_cast("double").cast("long").cast("string"), F.col("position_idx").cast("string"))
    df = alerts.where("table_id is not null and position_idx is not null").withColumns({"_table": F.col("table_id").cast("string"), "seat": seat})
    best = df.groupBy("_table", "seat").agg(F.max_by(F.struct("us", *columns), F.struct("us", "bet_id")).alias("_r"))
    return best.select(F.col("_table").alias("table_id"), "seat", "_r.*")


def seats_with_alerts(seats: DataFrame, alerts: DataFrame, *columns: str) -> DataFrame:
    """Seats (table_id, seat) with the columns of their newest alert, null without one."""
    latest = latest_by_seat(alerts, *columns).withColumnRenamed("us", "alert_us")
    return seats.withColumns({c: F.col(c).cast("string") for c in ("table_id", "seat")}).join(latest, ["table_id", "seat"], "left")


def label_join(predictions: DataFrame, truth: DataFrame, key: str = "bet_id", label: Column | None = None) -> DataFrame:
    """Predictions with their label, of those that have a binary one; repeated truths of a key count once, the greatest."""
    known = truth.select(key, (F.col("label") if label is None else label).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    return predictions.drop("label").join(known.groupBy(key).agg(F.max("label").alias("label")), key)


def batch_calibrate(predictions: DataFrame, truth: DataFrame, now_us: int, hours: float, recall_floor: float = 0.01, min_alerts: int = 5, per_hour: float | None = None) -> DataFrame:
    """A threshold from the rated predictions of the last hours with their truth: one row, or none where no point fits."""
    recent = predictions.where((F.col("us") > now_us - int(hours * 60 * MINUTE)) & (F.col("us") <= now_us) & F.col("is_rated"))
    return ranking.pick_threshold(ranking.pr_curve(label_join(recent, truth)), recall_floor, min_alerts, per_hour, hours)


def autolabels(sample: DataFrame, bets: DataFrame, end_us: int, **times) -> DataFrame:
    """Walk-away labels of the sampled bets (bet_id), over all bets of their players."""
    players = only_ids(bets, sample, "bet_id").select("player_id").distinct()
    labelled = sequence.walkaway_labels(only_ids(bets, players, "player_id"), end_us, **times)
    return only_ids(labelled, sample, "bet_id").select("bet_id", "player_id", "us", "label", "censored")


def results_since(results: DataFrame, last_id: int) -> tuple[DataFrame, int, bool]:
    """Results after the last id that was loaded, the id to go on from, and whether the table was reset: where its ids end
    before the last one, all of it is loaded again."""
    most = results.agg(F.max("result_id")).first()[0] or 0
    reset = most < last_id
    return (results if reset else results.where(F.col("result_id") > last_id)), most, reset
