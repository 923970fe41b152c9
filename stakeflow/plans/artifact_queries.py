"""Ordered fingerprints of the artifacts that other queries build, over their whole rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from stakeflow.operators import audit
from stakeflow.plans import sequence_queries
from stakeflow.plans.adapters import BETS, bets

QUERIES: dict = {}
ORACLES: dict = {}

#: For each artifact: the query that builds it, and the columns that order it.
ARTIFACTS = {
    "run_fact": ("a5_run_fact", ["run_id"]),
    "run_bet_map": ("a6_run_bet_map", ["run_id", "bet_id"]),
    "run_day_bridge": ("a7_run_day_bridge", ["run_id", "player_id", "bet_day"]),
    "trip_fact": ("a8_trip_fact", ["trip_id"]),
    "trip_run_map": ("a8_trip_run_map", ["trip_id", "run_in_trip"]),
}
CLEANED = ["bet_id", "player_id", "gaming_day", "us", "etl_us"]


def _sql(name: str, source: str, order: list[str], columns: list[str]) -> str:
    """Two levels of the tree, which hold 16 million rows."""
    parts = ", ".join(f"'{c}=' || coalesce('v' || CAST({c} AS VARCHAR), 'n')" for c in sorted(columns))
    first = ", ".join(f"{c} ASC NULLS LAST" for c in order)
    return f"""SELECT '{name}' AS artifact, sum(n)::BIGINT AS rows, CASE WHEN count(*) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY k)) END AS fingerprint FROM (
  SELECT i // {audit.CHUNK} AS k, count(*) AS n, sha256(string_agg(d, '' ORDER BY i)) AS h FROM (
    SELECT d, row_number() OVER (ORDER BY {first}, d) - 1 AS i FROM (SELECT *, sha256(concat_ws(chr(31), {parts})) AS d FROM ({source}))) GROUP BY k)"""


def a11_ordered_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row an artifact: its rows, and the hash of them in order; of whole cleaned bets, runs, trips and their maps."""
    frames = {name: (sequence_queries.QUERIES[q](spark, sf_dir), order) for name, (q, order) in ARTIFACTS.items()}
    frames["cleaned_bets"] = (bets(spark, sf_dir).select(CLEANED), ["us", "bet_id"])
    rows = [audit.ordered_fingerprint(df, order).selectExpr(f"'{name}' AS artifact", "rows", "fingerprint") for name, (df, order) in frames.items()]
    return reduce(DataFrame.unionByName, rows)


COLUMNS = {
    "run_fact": "player_id run_seq first_bet_id last_bet_id run_start_us run_end_us start_day end_day bet_count run_id",
    "run_bet_map": "run_id bet_id player_id gaming_day end_day",
    "run_day_bridge": "run_id player_id bet_day end_day",
    "trip_fact": "player_id trip_seq trip_start_us trip_end_us first_run_id last_day run_count bet_count closed trip_end_day trip_id",
    "trip_run_map": "trip_id run_id player_id run_in_trip",
}
QUERIES["a11_ordered_fingerprints"] = a11_ordered_fingerprints
ORACLES["a11_ordered_fingerprints"] = " UNION ALL ".join([*(_sql(name, sequence_queries.ORACLES[q], order, COLUMNS[name].split()) for name, (q, order) in ARTIFACTS.items()), _sql("cleaned_bets", f"WITH {BETS} SELECT {', '.join(CLEANED)} FROM bets", ["us", "bet_id"], CLEANED)])
