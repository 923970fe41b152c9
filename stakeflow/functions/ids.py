"""Identifiers, cleaning and buckets, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_card_id(card: Column) -> Column:
    """Trimmed; empty and any spelling of null become null."""
    return F.when(F.lower(F.trim(card)).isin("", "null"), F.lit(None)).otherwise(F.trim(card))


def time_text(us: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.ffffff`` of microseconds."""
    return F.concat(F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), F.lpad(F.pmod(us, F.lit(1_000_000)).cast("string"), 6, "0"))


def hashed_id(prefix: str, **fields: Column) -> Column:
    """``prefix_`` and 32 digits of the SHA-256 of the fields as JSON with sorted keys and no blanks."""
    parts = [F.lit("{")]
    for i, k in enumerate(sorted(fields)):
        parts += [F.lit(("," if i else "") + f'"{k}":'), fields[k]]
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat(*parts, F.lit("}")), 256), 1, 32))


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))


def derive_run_id(player_id: Column, run_start_us: Column, first_bet_id: Column, version: str = "v1", namespace: str = "events") -> Column:
    return hashed_id("run", player_id=player_id.cast("string"), run_start_ts=quoted(time_text(run_start_us)), first_bet_id=first_bet_id.cast("string"), run_definition_version=quoted(F.lit(version)), source_namespace=quoted(F.lit(namespace)))


def derive_trip_id(player_id: Column, start_us: Column, first_run_id: Column, version: str = "v1", namespace: str = "events") -> Column:
    return hashed_id("trip", player_id=player_id.cast("string"), trip_start_ts=quoted(time_text(start_us)), first_run_id=quoted(first_run_id), trip_definition_version=quoted(F.lit(version)), source_namespace=quoted(F.lit(namespace)))


def bet_size_bucket(wager: Column, edges: tuple[int, ...] = (0, 100, 500, 2000, 10000)) -> Column:
    """``lo_hi`` for lo <= wager < hi, ``last_plus`` beyond, ``unknown`` for null, NaN and less than the first edge."""
    out = F.when(wager.isNull() | F.isnan(wager) | (wager < edges[0]), "unknown")
    for lo, hi in zip(edges, edges[1:]):
        out = out.when(wager < hi, f"{lo}_{hi}")
    return out.otherwise(f"{edges[-1]}_plus")


def tenure_bucket(days: Column, unknown: str | None = None) -> Column:
    """T0_seg to a week, T1 to 30 days, T2 to 90, then T3; null and negative are ``unknown``."""
    return F.when(days.isNull() | (days < 0), F.lit(unknown)).when(days <= 7, "T0_seg").when(days <= 30, "T1").when(days <= 90, "T2").otherwise("T3")


def score_bin(score: Column, bins: int = 10) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(score * bins))).cast("int")


def time_segments(us: Column) -> dict[str, Column]:
    """Hour, day of week from Monday 0, weekend flag, and the day's sine and cosine."""
    ts = F.timestamp_micros(us)
    minutes = F.pmod(us, F.lit(86_400_000_000)) / 60_000_000
    turn = minutes / 1440 * 2 * F.pi()
    return {"hour_of_day": F.hour(ts), "day_of_week": F.weekday(ts), "is_weekend": (F.weekday(ts) >= 5).cast("int"), "time_of_day_sin": F.sin(turn), "time_of_day_cos": F.cos(turn)}
