"""Types, row rules and filters that raw bets and sessions go through before anything is computed of them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeflow.operators.dedup import dedup_sessions, only_ids, unflagged, without_ids

PLACEHOLDER = -1
KEYS = ("bet_id", "session_id", "player_id")
#: Columns of money, held as decimals at the source.
MONEY = tuple("base_ha bonus casino_loss_from_nn casino_win commission max_wager payout_ha payout_odds std_dev theo_win theo_win_cash true_odds wager wager_nn tip_amount increment_wager bet_cards_sum adjusted_theo_win payout_value".split())
#: Numbers of a bet that are 0 where they are missing.
FILLED = ("wager", "payout_odds", "base_ha", "is_back_bet", "position_idx", "casino_win")


def as_number(c: Column) -> Column:
    """The number that a value or a text stands for; null where it stands for none."""
    return c.cast("string").try_cast("double")


def as_key(c: Column) -> Column:
    return F.coalesce(c.cast("string").try_cast("long"), as_number(c).try_cast("long"))


def normalize_types(df: DataFrame, keys: Iterable[str] = KEYS, categories: Iterable[str] = ("table_id",)) -> DataFrame:
    """Keys as longs, null where they are none; categories as text. Columns that aren't there are passed over."""
    return df.withColumns({c: as_key(F.col(c)) for c in keys if c in df.columns} | {c: F.col(c).cast("string") for c in categories if c in df.columns})


def money_to_double(df: DataFrame, columns: Iterable[str] = MONEY) -> DataFrame:
    return df.withColumns({c: as_number(F.col(c)) for c in columns if c in df.columns})


def coerce_features(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Columns that aren't numbers become doubles, null for what is none; numbers stay of their type."""
    numeric = {c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")}
    return df.withColumns({c: as_number(F.col(c)) for c in columns if c in df.columns and c not in numeric})


def recover_player_id(bets: DataFrame, sessions: DataFrame) -> DataFrame:
    """Bets whose player is missing take their session's, if it has a real one, the smallest of several."""
    own = sessions.where(F.col("player_id").isNotNull() & (F.col("player_id") != PLACEHOLDER)).groupBy("session_id").agg(F.min("player_id").alias("_own"))
    lost = F.col("player_id").isNull() | (F.col("player_id") == PLACEHOLDER)
    return bets.join(own, "session_id", "left").withColumn("player_id", F.when(lost, F.coalesce("_own", "player_id")).otherwise(F.col("player_id"))).drop("_own")


def clean_bets(bets: DataFrame, sessions: DataFrame, start_us: int, end_us: int) -> DataFrame:
    """All that training asks of bets: keys as longs, times in ``[start, end)``, ids and a positive wager; the session's
    player where the bet has none, and none without one; the day by the time, a status column, and numbers filled by 0."""
    df = normalize_types(bets)
    df = df.where((F.col("us") >= start_us) & (F.col("us") < end_us) & F.col("bet_id").isNotNull() & F.col("session_id").isNotNull() & (as_number(F.col("wager")) > 0))
    df = recover_player_id(df, sessions).where(F.col("player_id").isNotNull() & (F.col("player_id") != PLACEHOLDER))
    day = F.to_date(F.timestamp_micros("us"))
    more = {"gaming_day": F.coalesce("gaming_day", day) if "gaming_day" in df.columns else day}
    more |= {} if "status" in df.columns else {"status": F.lit(None).cast("string")}
    return df.withColumns(more | {c: F.coalesce(as_number(F.col(c)), F.lit(0.0)) for c in FILLED if c in df.columns})


def preprocessed_bets(bets: DataFrame, day: Column, dummies: DataFrame | None = None, eligible: DataFrame | None = None) -> DataFrame:
    """Bets of a day of real players, with ids, unflagged; without ``dummies``, and of ``eligible`` players only, if given."""
    df = bets.where(F.col("player_id").isNotNull() & (F.col("player_id") != PLACEHOLDER) & F.col("bet_id").isNotNull() & (F.col("gaming_day") == day))
    df = unflagged(df, *[c for c in ("is_deleted", "is_canceled", "is_manual") if c in df.columns])
    df = df if dummies is None else without_ids(df, dummies, "player_id")
    return df if eligible is None else only_ids(df, eligible, "player_id")


@dataclass(frozen=True)
class RowRule:
    """A rule on rows that match ``condition``: ``exclude`` them, ``tag`` them by its id, or ``cap`` their observed time."""

    id: str
    condition: str
    action: str = "exclude"
    enabled: bool = True
    priority: int = 0
    cap_seconds: int = 122


#: The declared rules. Times are microseconds.
BET_RULES = (
    RowRule("BET-INGEST-FIX-004", "etl_us is not null and us is not null", "cap", priority=5),
    RowRule("BET-INGEST-FIX-001", "etl_us - us > 1209600000000", "exclude", enabled=False, priority=10),
    RowRule("BET-INGEST-FIX-002", "to_date(timestamp_micros(etl_us)) = date'2025-05-27'", "cap", enabled=False, priority=20),
    RowRule("BET-INGEST-FIX-003", "to_date(timestamp_micros(etl_us)) = date'2025-07-21'", "cap", enabled=False, priority=21),
)


def apply_rules(df: DataFrame, rules: Iterable[RowRule] = BET_RULES) -> tuple[DataFrame, DataFrame]:
    """The rows that the enabled rules keep, with observed_us and the ids of the rules that touched each in ``rule_ids``;
    and the excluded ones, as a correction log. All conditions are of the row as it came; unknown ones don't match."""
    rules = sorted((r for r in rules if r.enabled), key=lambda r: (r.priority, r.id))
    hit = lambda r: F.coalesce(F.expr(r.condition), F.lit(False))
    seen = F.col("etl_us")
    for r in rules:
        if r.action == "cap":
            seen = F.when(hit(r), F.least(seen, F.col("us") + r.cap_seconds * 1_000_000)).otherwise(seen)
    ids = F.array_compact(F.array(*[F.when(hit(r), r.id) for r in rules], F.lit(None).cast("string")))
    out = F.lit(False)
    for r in rules:
        out = out | hit(r) if r.action == "exclude" else out
    marked = df.withColumns({"observed_us": seen, "rule_ids": ids, "_out": out})
    return marked.where(~F.col("_out")).drop("_out"), marked.where("_out").drop("_out")


def core_window(labelled: DataFrame, start_us: int, end_us: int) -> DataFrame:
    """Labelled rows that aren't censored, in ``[start, end)``."""
    return labelled.where(~F.coalesce(F.col("censored"), F.lit(False)) & (F.col("us") >= start_us) & (F.col("us") < end_us))


def eval_date(instant: Column, zone: str = "Asia/Hong_Kong") -> Column:
    """The local date of an instant."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def one_off_ids(sessions: DataFrame, card: Column, length: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Cards of one session, of unflagged ones: how many have at most one game and how many more; and of the former how
    many there are, at how many tables, in how many sessions."""
    df = sessions.withColumn("_card", card).where("_card is not null")
    by = df.where("is_manual = 0").groupBy("_card").agg(F.count_distinct("session_id").alias("n"), F.sum("num_games_with_wager").alias("games"))
    by = by.where(F.col("n") == 1) if length is None else by.where((F.col("n") == 1) & (F.char_length("_card") == length))
    few = F.col("games") <= 1
    kinds = by.groupBy(F.when(few, "0_or_1_game").otherwise("multi_games").alias("game_type")).agg(F.count("*").alias("ids"))
    spread = df.join(by.where(few).select("_card"), "_card", "left_semi").agg(F.count_distinct("_card").alias("ids"), F.count_distinct("table_id").alias("tables"), F.count("*").alias("sessions"))
    return kinds, spread


def available_sessions(sessions: DataFrame, now_us: int, delay: int = 7 * 60_000_000) -> DataFrame:
    """Newest unflagged sessions with wagers that were known ``delay`` before now."""
    df = unflagged(dedup_sessions(sessions), "is_manual", "is_deleted", "is_canceled").where("coalesce(turnover, 0) > 0 or coalesce(num_games_with_wager, 0) > 0")
    return df.where(F.coalesce("end_us", "lud_us") <= now_us - delay)
