"""Which loyalty card a player's id stands for, and when that was known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeflow.functions.ids import clean_card_id
from stakeflow.operators.dedup import dedup_sessions, unflagged

MINUTE = 60_000_000
PLACEHOLDER = -1


def valid_sessions(sessions: DataFrame, cutoff_us: int | None = None) -> DataFrame:
    """Newest versions, unflagged, of real players, that ended (or were updated) by the cutoff, with wagers."""
    df = unflagged(dedup_sessions(sessions), "is_manual", "is_deleted", "is_canceled")
    df = df.where(F.col("player_id").isNotNull() & (F.col("player_id") != PLACEHOLDER)).withColumn("known_us", F.coalesce("end_us", "lud_us"))
    df = df if cutoff_us is None else df.where(F.col("known_us") <= cutoff_us)
    return df.where("turnover > 0 or num_games_with_wager > 0")


def identity_links(sessions: DataFrame, cutoff_us: int | None = None, delay: int = 7 * MINUTE) -> DataFrame:
    """player_id, card, lud_us, link_us: which card a session linked to a player, usable ``delay`` after its end."""
    df = valid_sessions(sessions, cutoff_us).withColumn("card", clean_card_id(F.col("casino_player_id")))
    return df.where("card is not null").select("player_id", "card", "lud_us", (F.col("known_us") + delay).alias("link_us"))


def dummy_players(sessions: DataFrame, cutoff_us: int | None = None) -> DataFrame:
    """Players of exactly one session and at most one game."""
    by = valid_sessions(sessions, cutoff_us).groupBy("player_id").agg(F.count("*").alias("n"), F.sum("num_games_with_wager").alias("games"))
    return by.where("n = 1 and coalesce(games, 0) <= 1").select("player_id")


def canonical_mapping(sessions: DataFrame, cutoff_us: int | None = None) -> DataFrame:
    """player_id to canonical_id: the card of the newest session with one, the larger of two; dummies have none. Cards and
    dummies come from one pass over the sessions."""
    df = valid_sessions(sessions, cutoff_us).withColumn("card", clean_card_id(F.col("casino_player_id")))
    newest = F.max(F.when(F.col("card").isNotNull(), F.struct("lud_us", "card"))).alias("_newest")
    by = df.groupBy("player_id").agg(newest, F.count("*").alias("_n"), F.sum("num_games_with_wager").alias("_games"))
    return by.where("_newest is not null and not (_n = 1 and coalesce(_games, 0) <= 1)").select("player_id", F.col("_newest.card").alias("canonical_id"))


def card_swaps(sessions: DataFrame, cutoff_us: int | None = None) -> DataFrame:
    """Players of more than one card."""
    return identity_links(sessions, cutoff_us).groupBy("player_id").agg(F.count_distinct("card").alias("cards")).where("cards > 1")


def with_fallback(bets: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds canonical_id, the player's id where the mapping has none, and is_rated."""
    df = bets.join(mapping, "player_id", "left").withColumn("is_rated", F.col("canonical_id").isNotNull())
    return df.withColumn("canonical_id", F.coalesce("canonical_id", F.col("player_id").cast("string")))


def resolve_identity(bets: DataFrame, sessions: DataFrame, mapping: DataFrame, delay: int = 7 * MINUTE) -> DataFrame:
    """Adds canonical_id: the card of the bet's own session if that was known at the bet's time, else the mapping's,
    else the player's id; null for the placeholder."""
    own = dedup_sessions(sessions).select("session_id", clean_card_id(F.col("casino_player_id")).alias("_card"), (F.coalesce("end_us", "lud_us") + delay).alias("_known"))
    df = bets.join(own, "session_id", "left").join(mapping.withColumnRenamed("canonical_id", "_mapped"), "player_id", "left")
    real = F.col("player_id").isNotNull() & (F.col("player_id") != PLACEHOLDER)
    card = F.coalesce(F.when(F.col("_known") <= F.col("us"), F.col("_card")), F.when(real, F.coalesce("_mapped", F.col("player_id").cast("string"))))
    return df.withColumn("canonical_id", card).drop("_card", "_known", "_mapped")
