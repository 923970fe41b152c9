"""Newest-version dedup and data-quality filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key in the order given; ties go by a hash of all columns, so that the choice is the same
    for any partitioning."""
    tie = F.xxhash64(*df.columns)
    w = Window.partitionBy(key).orderBy(*order, tie)
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def dedup_sessions(sessions: DataFrame) -> DataFrame:
    return newest(sessions, "session_id", F.desc_nulls_last("lud_us"), F.desc_nulls_last("etl_us"))


def capped_observed(etl_us: Column, us: Column, cap: int = 122_000_000) -> Column:
    """The observed time, at most ``cap`` after the event where both are known."""
    return F.when(etl_us.isNotNull() & us.isNotNull(), F.least(etl_us, us + cap)).otherwise(etl_us)


def dedup_bets(bets: DataFrame, cap: int | None = 122_000_000) -> DataFrame:
    seen = F.col("etl_us") if cap is None else capped_observed(F.col("etl_us"), F.col("us"), cap)
    return newest(bets.withColumn("observed_us", seen), "bet_id", F.desc_nulls_last("observed_us"))


def dedup_games(games: DataFrame) -> DataFrame:
    return newest(games, "game_id", F.desc_nulls_last("ts_ms"), F.desc_nulls_last("etl_us"), F.desc_nulls_last("us"))


def resolved_games(games: DataFrame, seen_by_us: int | None = None, tables: DataFrame | None = None, start_us: int | None = None, end_us: int | None = None) -> DataFrame:
    """Rounds of ``tables`` in ``[start, end)`` visible by a time, or by the end if that is earlier; the newest version of
    each, of which the resolved ones stay."""
    seen = min((t for t in (seen_by_us, end_us) if t is not None), default=None)
    g = games if seen is None else games.where(F.col("etl_us") <= seen)
    g = g if start_us is None else g.where(F.col("us") >= start_us)
    g = g if end_us is None else g.where(F.col("us") < end_us)
    g = g if tables is None else only_ids(g, tables, "table_id")
    return dedup_games(g).where("game_status = 'RESOLVED'")


def unflagged(df: DataFrame, *flags: str) -> DataFrame:
    """Rows whose flags are null or 0; texts are read as numbers where they are."""
    for f in flags:
        df = df.where(F.coalesce(F.col(f).cast("string").try_cast("int"), F.lit(0)) == 0)
    return df


def bet_dq(bets: DataFrame, start_us: int, end_us: int) -> DataFrame:
    """Bets in ``[start, end)`` with ids and a positive wager."""
    return bets.where((F.col("us") >= start_us) & (F.col("us") < end_us) & F.col("bet_id").isNotNull() & F.col("session_id").isNotNull() & (F.col("wager") > 0))


def session_dq(sessions: DataFrame) -> DataFrame:
    """The newest versions, unflagged, with turnover or games."""
    return unflagged(dedup_sessions(sessions), "is_manual", "is_deleted", "is_canceled").where("turnover > 0 or num_games_with_wager > 0")


def only_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


def without_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in no row of ``ids``; null ids exclude nothing."""
    return df.join(ids.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def negative_sample(df: DataFrame, fraction: float, seed: int = 0, label: str = "label", key: str = "bet_id") -> DataFrame:
    """All positives, and the negatives whose hashed key falls below the fraction: the same rows at every run."""
    part = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("double") / 2**32
    return df.where((F.col(label) == 1) | (part < fraction))
