"""Run and trip facts, and the maps between bets, runs, days and trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stakeflow.functions.ids import derive_run_id, derive_trip_id
from stakeflow.operators.sequence import run_sequence, trip_sequence

MINUTE = 60_000_000


def run_fact(bets: DataFrame, gap: int = 30 * MINUTE) -> DataFrame:
    """A row for each run of bets (player_id, bet_id, us, gaming_day): first and last bet, times, days, count and id."""
    at = F.struct("us", "bet_id")
    runs = run_sequence(bets, gap=gap).groupBy("player_id", "run_seq").agg(
        F.min_by("bet_id", at).alias("first_bet_id"),
        F.max_by("bet_id", at).alias("last_bet_id"),
        F.min("us").alias("run_start_us"),
        F.max("us").alias("run_end_us"),
        F.min_by("gaming_day", at).alias("start_day"),
        F.max_by("gaming_day", at).alias("end_day"),
        F.count("*").alias("bet_count"),
    )
    return runs.withColumn("run_id", derive_run_id(F.col("player_id"), F.col("run_start_us"), F.col("first_bet_id")))


def run_bet_map(bets: DataFrame, gap: int = 30 * MINUTE) -> DataFrame:
    """run_id, bet_id, player_id and end_day for each bet; the run's ends come by window over the same partitions."""
    w = Window.partitionBy("player_id", "run_seq")
    at = F.struct("us", "bet_id")
    df = run_sequence(bets, gap=gap).withColumns({"_first": F.min(at).over(w), "end_day": F.max_by("gaming_day", at).over(w)})
    return df.select(derive_run_id(F.col("player_id"), F.col("_first.us"), F.col("_first.bet_id")).alias("run_id"), "bet_id", "player_id", "gaming_day", "end_day")


def run_day_bridge(bets: DataFrame, gap: int = 30 * MINUTE) -> DataFrame:
    """The gaming days that each run has bets on."""
    return run_bet_map(bets, gap).select("run_id", "player_id", F.col("gaming_day").alias("bet_day"), "end_day").distinct()


def trip_fact(runs: DataFrame, coverage_end_day, empty_days: int = 3) -> DataFrame:
    """A row for each trip of runs; a player's last trip is closed once ``empty_days`` days are covered after it."""
    at = F.struct("run_start_us", "run_id")
    trips = trip_sequence(runs, empty_days).groupBy("player_id", "trip_seq").agg(
        F.min("run_start_us").alias("trip_start_us"), F.max("run_end_us").alias("trip_end_us"), F.min_by("run_id", at).alias("first_run_id"),
        F.max_by("end_day", at).alias("last_day"), F.count("*").alias("run_count"), F.sum("bet_count").alias("bet_count"),
    )
    last = F.lead("trip_seq").over(Window.partitionBy("player_id").orderBy("trip_seq")).isNull()
    trips = trips.withColumn("closed", ~last | (F.datediff(F.lit(coverage_end_day), "last_day") >= empty_days))
    trips = trips.withColumn("trip_end_day", F.when(F.col("closed"), F.date_add("last_day", empty_days)))
    return trips.withColumn("trip_id", derive_trip_id(F.col("player_id"), F.col("trip_start_us"), F.col("first_run_id")))


def trip_run_map(runs: DataFrame, empty_days: int = 3) -> DataFrame:
    tagged = trip_sequence(runs, empty_days)
    first = F.first(F.struct("run_start_us", "run_id")).over(Window.partitionBy("player_id", "trip_seq").orderBy("run_start_us", "run_id"))
    df = tagged.withColumn("_first", first)
    return df.select(derive_trip_id(F.col("player_id"), F.col("_first.run_start_us"), F.col("_first.run_id")).alias("trip_id"), "run_id", "player_id", "run_in_trip")


def sample_weights(bets: DataFrame, *keys: str) -> DataFrame:
    """Adds weight: one by the number of rows of its keys."""
    return bets.withColumn("weight", 1 / F.count("*").over(Window.partitionBy(*keys)))
