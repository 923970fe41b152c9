"""Rolling player profiles as of snapshots, frozen profiles, and patrons' histories."""

from __future__ import annotations

import heapq
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakeflow.functions.ids import clean_card_id
from stakeflow.operators.dedup import dedup_sessions, unflagged
from stakeflow.operators.ranking import value_quantiles
from stakeflow.sources.materialise import written

MINUTE = 60_000_000
DAY = 1440 * MINUTE

#: Days of the windows of each measure.
WINDOWS = {
    "sessions": (7, 30, 90, 180, 365), "active_days": (30, 90, 365), "turnover_sum": (7, 30, 90, 180, 365), "player_win_sum": (30, 90, 180, 365), "theo_win_sum": (30, 180),
    "num_bets_sum": (30, 180), "num_games_with_wager_sum": (30, 180), "win_session_rate": (30, 180), "avg_session_duration_min": (30, 180), "distinct_table_cnt": (30, 90), "distinct_pit_cnt": (30,), "distinct_gaming_area_cnt": (30,),
}


def profile_sessions(sessions: DataFrame, mapping: DataFrame) -> DataFrame:
    """Newest, unflagged sessions with wagers of mapped players, with the time and day that they count at."""
    df = unflagged(dedup_sessions(sessions), "is_manual", "is_deleted", "is_canceled").where("turnover > 0 or num_games_with_wager > 0")
    df = df.withColumn("session_us", F.coalesce("end_us", "lud_us")).withColumn("session_date", F.to_date(F.timestamp_micros("session_us")))
    return df.join(mapping, "player_id")


def player_profile(rows: DataFrame, snapshots: DataFrame, delay: int = 7 * MINUTE, max_lookback_days: int = 365, reach_days: int = 366) -> DataFrame:
    """A row for each snapshot and canonical_id of ``rows`` (profile_sessions): 45 measures of the windows before it.

    ``snapshots`` (snapshot_us) are days, and few. A session counts once it is ``delay`` old. Ids of at most one game in
    reach have no profile. Windows longer than ``max_lookback_days`` are null.

    Sessions are summed up by id, day and place first, and only these sums go to the snapshots. A day or place is within
    a window if its latest session is, so that distinct counts need no sets.
    """
    times = sorted({r.snapshot_us for r in snapshots.select("snapshot_us").collect()})
    parts = [_profile_of(rows, [t for t in times if t % DAY == phase], phase, delay, max_lookback_days, reach_days) for phase in sorted({t % DAY for t in times})]
    return reduce(DataFrame.unionByName, parts) if parts else _profile_of(rows.limit(0), [0], 0, delay, max_lookback_days, reach_days)


def _profile_of(rows: DataFrame, times: list[int], phase: int, delay: int, most_days: int, reach_days: int) -> DataFrame:
    """For snapshots at one time of the day: days are counted from there."""
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in rows.columns else F.lit(0.0)
    place = lambda c: F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")
    t = F.col("session_us") - phase
    ended = F.col("end_us").isNotNull()
    sums = {"sessions": F.count("*").cast("double"), "wins": F.sum(F.when(value("player_win") > 0, 1.0).otherwise(0.0)), "timed": F.sum(F.when(ended, 1.0).otherwise(0.0)), "minutes": F.sum(F.when(ended, (F.col("session_us") - F.col("start_us")) / MINUTE).otherwise(0.0))}
    sums |= {c: F.sum(value(c)) for c in ("turnover", "player_win", "theo_win", "num_bets", "num_games_with_wager")}
    keys = ["canonical_id", F.col("session_date").alias("date"), F.floor(t / DAY).alias("day"), F.floor((t + delay) / DAY).alias("late"), F.ceil((t + delay) / DAY).alias("known"), place("table_id").alias("table"), place("pit_id").alias("pit"), place("gaming_area").alias("area")]
    daily = rows.groupBy(*keys).agg(*[c.alias(k) for k, c in sums.items()])
    near = F.filter(F.array(*[F.lit((x - phase) // DAY) for x in times]), lambda s: (F.col("known") <= s) & (F.col("late") >= s - reach_days))
    at = daily.withColumn("snap", F.explode(near))
    within = lambda d: F.col("snap") - F.col("day") <= d
    total = lambda c, d: F.sum(F.when(within(d), F.col(c)))
    plain = {"turnover_sum": "turnover", "player_win_sum": "player_win", "theo_win_sum": "theo_win", "num_bets_sum": "num_bets", "num_games_with_wager_sum": "num_games_with_wager"}
    cols, places = {}, {}
    for name, days in WINDOWS.items():
        for d in days:
            to = places if name == "active_days" or name.startswith("distinct_") else cols
            if d > most_days:
                c = F.max(F.lit(None).cast("double"))
            elif name == "sessions":
                c = F.coalesce(total("sessions", d), F.lit(0.0))
            elif name == "win_session_rate":
                c = total("wins", d) / F.nullif(total("sessions", d), F.lit(0.0))
            elif name == "avg_session_duration_min":
                c = total("minutes", d) / F.nullif(total("timed", d), F.lit(0.0))
            elif name in plain:
                c = total(plain[name], d)
            else:
                kind = {"active_days": "date", "distinct_table_cnt": "table", "distinct_pit_cnt": "pit", "distinct_gaming_area_cnt": "area"}[name]
                c = F.count_if((F.col("kind") == kind) & within(d)).cast("double")
            to[f"{name}_{d}d"] = c
    whole = at.groupBy("snap", "canonical_id").agg(F.max("date").alias("_last"), F.min("date").alias("_first"), F.sum("num_games_with_wager").alias("_games"), *[c.alias(k) for k, c in cols.items()]).where("_games > 1")
    kinds = F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in ("date", "table", "pit", "area")]), lambda x: x["value"].isNotNull() | (x["kind"] == "table")))
    each = at.select("snap", "canonical_id", "day", "turnover", kinds.alias("x")).select("*", "x.*").groupBy("snap", "canonical_id", "kind", "value").agg(F.max("day").alias("day"), *[total("turnover", d).alias(f"_t{d}") for d in (30, 90)])
    of_table = F.col("kind") == "table"
    places = {k: F.count_if(F.col("value").isNotNull() & (F.col("kind") == "table") & within(int(k.rsplit("_", 1)[1][:-1]))).cast("double") if k.startswith("distinct_table") and int(k.rsplit("_", 1)[1][:-1]) <= most_days else c for k, c in places.items()}
    spread = each.groupBy("snap", "canonical_id").agg(*[c.alias(k) for k, c in places.items()], *[F.max(F.when(of_table, F.col(f"_t{d}"))).alias(f"_t{d}") for d in (30, 90)])
    return _with_ratios(whole.join(spread, ["snap", "canonical_id"]).withColumn("snapshot_us", F.col("snap") * DAY + phase))


def _with_ratios(out: DataFrame) -> DataFrame:
    """Days since the first and last session, ratios of the sums, and shares of the top table."""
    day = F.to_date(F.timestamp_micros("snapshot_us"))
    out = out.withColumns({"days_since_last_session": F.datediff(day, "_last").cast("double"), "days_since_first_session": F.datediff(day, "_first").cast("double")})
    per = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0.0))
    out = out.withColumns({
        **{f"turnover_per_bet_mean_{d}d": per(f"turnover_sum_{d}d", f"num_bets_sum_{d}d") for d in (30, 180)},
        **{f"actual_rtp_{d}d": 1 + per(f"player_win_sum_{d}d", f"turnover_sum_{d}d") for d in (30, 180)},
        "actual_vs_theo_ratio_30d": per("player_win_sum_30d", "theo_win_sum_30d"),
        "turnover_30d_over_180d": per("turnover_sum_30d", "turnover_sum_180d"),
        "sessions_30d_over_180d": per("sessions_30d", "sessions_180d"),
        "sessions_7d_over_30d": per("sessions_7d", "sessions_30d"),
        "active_days_per_session_30d": per("active_days_30d", "sessions_30d"),
        **{f"top_table_share_{d}d": per(f"_t{d}", f"turnover_sum_{d}d") for d in (30, 90)},
    })
    out = out.withColumn("turnover_per_bet_30d_over_180d", per("turnover_per_bet_mean_30d", "turnover_per_bet_mean_180d"))
    return out.drop("snap", "_first", "_last", "_games", "_t30", "_t90")


#: Amounts are counted in ten-thousandths, so that sums of signed events are exact.
CENTS = 10_000


def profile_backfill(rows: DataFrame, snapshots: DataFrame, delay: int = 7 * MINUTE, max_lookback_days: int = 365, reach_days: int = 366) -> DataFrame:
    """As ``player_profile``, for snapshots in any number, such as the days of years.

    A day's sums of an id enter each window at the snapshot from which they are known, and leave it when they are too old:
    two signed events a window, and not a copy a snapshot. Running sums over an id's events hold between one event and the
    next, and are read off at the snapshots there. A day or place stands in a window from one of its sessions until that is
    too old or the next one is known, so that its events count distinct values; what an id's first session in reach is
    follows from when the one before it leaves. The largest table's turnover is swept by table. Amounts are rounded to
    ten-thousandths, of which an id may have 9e18.

    Sessions that are known after the last snapshot, or out of all windows and the reach before the first, change no sum
    between the two, and go; the days' sums of the others are written down, as five kinds of events come from them.
    """
    times = sorted({r.snapshot_us for r in snapshots.select("snapshot_us").collect()})  # a row a snapshot
    parts = [_backfill_of(rows, [t for t in times if t % DAY == phase], phase, delay, max_lookback_days, reach_days) for phase in sorted({t % DAY for t in times})]
    return reduce(DataFrame.unionByName, parts) if parts else _backfill_of(rows.limit(0), [0], 0, delay, max_lookback_days, reach_days)


_AMOUNTS = {"turnover_sum": "turnover", "player_win_sum": "player_win", "theo_win_sum": "theo_win", "num_bets_sum": "num_bets", "num_games_with_wager_sum": "num_games_with_wager"}
_PLACES = {"active_days": "date", "distinct_table_cnt": "table", "distinct_pit_cnt": "pit", "distinct_gaming_area_cnt": "area"}


def _backfill_of(rows: DataFrame, times: list[int], phase: int, delay: int, most_days: int, reach_days: int) -> DataFrame:
    cents = lambda c: F.round(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * CENTS).cast("long") if c in rows.columns else F.lit(0).cast("long")
    place = lambda c: F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")
    t, ended = F.col("session_us") - phase, F.col("end_us").isNotNull()
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    sums = {"sessions": F.count("*"), "wins": one(cents("player_win") > 0), "timed": one(ended), "minutes": F.sum(F.when(ended, F.col("session_us") - F.col("start_us")).otherwise(0)), **{c: F.sum(cents(c)) for c in _AMOUNTS.values()}}
    keys = ["canonical_id", F.col("session_date").alias("date"), F.floor(t / DAY).alias("day"), F.floor((t + delay) / DAY).alias("late"), F.ceil((t + delay) / DAY).alias("known"), place("table_id").alias("table"), place("pit_id").alias("pit"), place("gaming_area").alias("area")]
    lo, hi = (min(times) - phase) // DAY, (max(times) - phase) // DAY
    oldest = lo - max(reach_days, *[d for ds in WINDOWS.values() for d in ds])
    seen_by_any = (F.ceil((t + delay) / DAY) <= hi) & (F.floor((t + delay) / DAY) >= oldest)
    daily = written(rows.where(seen_by_any).groupBy(*keys).agg(*[c.alias(k) for k, c in sums.items()]))

    measures = {"sessions": WINDOWS["sessions"], "wins": WINDOWS["win_session_rate"], "timed": WINDOWS["avg_session_duration_min"], "minutes": WINDOWS["avg_session_duration_min"], **{c: WINDOWS[k] for k, c in _AMOUNTS.items()}}
    widths = sorted({d for ds in measures.values() for d in ds})
    deltas = {f"{c}_{d}": (c, d) for c, ds in measures.items() for d in ds} | {"games_reach": ("num_games_with_wager", 0), "sessions_reach": ("sessions", 0)}

    def event(at: Column, width: int | None, sign: int) -> Column:
        """A row of changes: of all windows where sums enter, of one where they leave it; width 0 is the reach."""
        return F.struct(at.alias("s"), *[(sign * F.col(c) if width in (None, d) else F.lit(0).cast("long")).alias(k) for k, (c, d) in deltas.items()])

    moves = daily.groupBy("canonical_id", "day", "late", "known").agg(*[F.sum(c).alias(c) for c in sums])
    moves = moves.select("canonical_id", F.explode(F.array(event(F.col("known"), None, 1), *[event(F.col("day") + d + 1, d, -1) for d in widths], event(F.col("late") + reach_days + 1, 0, -1))).alias("e")).select("canonical_id", "e.*")

    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in dict.fromkeys(_PLACES.values())]))
    seen = daily.select("canonical_id", "day", "known", kinds.alias("x")).select("canonical_id", "day", "known", "x.*").where("value is not null").groupBy("canonical_id", "kind", "value", "known").agg(F.max("day").alias("day"))
    again = F.lead("known").over(Window.partitionBy("canonical_id", "kind", "value").orderBy("known"))
    spans = {f"{name}_{d}d": (kind, d) for name, kind in _PLACES.items() for d in WINDOWS[name]}
    stays = seen.withColumn("next", again).select("canonical_id", F.explode(F.array(
        F.struct(F.col("known").alias("s"), *[F.when(F.col("kind") == kind, 1).otherwise(0).cast("long").alias(k) for k, (kind, _) in spans.items()]),
        *[F.struct(F.least(F.col("day") + d + 1, "next").alias("s"), *[(F.when(F.col("kind") == kind, -1).otherwise(0) if d == e else F.lit(0)).cast("long").alias(k) for k, (kind, e) in spans.items()]) for d in sorted({d for _, d in spans.values()})],
    )).alias("e")).select("canonical_id", "e.*")

    order = Window.partitionBy("canonical_id").orderBy("known", "late", "date")
    days = daily.select("canonical_id", "known", "late", "date").distinct().withColumn("left", F.lag("late").over(order) + reach_days + 1)
    dates = days.select("canonical_id", F.greatest("known", "left").alias("s"), F.col("date").alias("first"), F.lit(None).cast("date").alias("last")).unionByName(days.select("canonical_id", F.col("known").alias("s"), F.lit(None).cast("date").alias("first"), F.col("date").alias("last")))

    tables = daily.groupBy("canonical_id", "table", "known", "day").agg(F.sum("turnover").alias("turnover"))
    swept = tables.groupBy("canonical_id").applyInPandas(_top_tables, "canonical_id string, s long, t30 long, t90 long")

    every = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [moves, stays, dates, swept])
    added = [*deltas, *spans]
    at = every.groupBy("canonical_id", "s").agg(*[F.sum(c).alias(c) for c in added], *[F.max(c).alias(c) for c in ("first", "last", "t30", "t90")])
    so_far = Window.partitionBy("canonical_id").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    held = at.select("canonical_id", "s", F.lead("s").over(Window.partitionBy("canonical_id").orderBy("s")).alias("until"), *[F.coalesce(F.sum(c).over(so_far), F.lit(0)).alias(c) for c in added], *[F.max(c).over(so_far).alias(f"_{c}") for c in ("first", "last")], *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in ("t30", "t90")])
    inside = F.filter(F.array(*[F.lit((x - phase) // DAY) for x in times]), lambda x: (x >= F.col("s")) & (F.col("until").isNull() | (x < F.col("until"))))
    at = held.where((F.col("s") <= hi) & (F.col("until").isNull() | (F.col("until") > lo)) & (F.col("sessions_reach") > 0) & (F.col("games_reach") > CENTS)).withColumn("snap", F.explode(inside))

    cols = {}
    for name, ds in WINDOWS.items():
        for d in ds:
            some = lambda c, d=d: F.when(F.col(f"sessions_{d}") > 0, c)
            ratio = lambda a, b, d=d: F.col(f"{a}_{d}") / F.nullif(F.col(f"{b}_{d}").cast("double"), F.lit(0.0))
            if name in _PLACES:
                c = F.col(f"{name}_{d}d").cast("double")
            elif name == "sessions":
                c = F.col(f"sessions_{d}").cast("double")
            elif name == "win_session_rate":
                c = ratio("wins", "sessions")
            elif name == "avg_session_duration_min":
                c = ratio("minutes", "timed") / MINUTE
            else:
                c = some(F.col(f"{_AMOUNTS[name]}_{d}") / CENTS)
            cols[f"{name}_{d}d"] = F.lit(None).cast("double") if d > most_days else c
    tops = [F.when(F.col(f"sessions_{d}") > 0, F.col(f"t{d}") / CENTS).alias(f"_t{d}") for d in (30, 90)]
    return _with_ratios(at.select("snap", "canonical_id", (F.col("snap") * DAY + phase).alias("snapshot_us"), "_first", "_last", F.lit(0).alias("_games"), *tops, *[c.alias(k) for k, c in cols.items()]))


def _top_tables(rows: pd.DataFrame) -> pd.DataFrame:
    """The largest turnover of any table within 30 and 90 days, wherever it changes, of one id's sums by table and day."""
    out: dict[int, list] = {}
    tables = [None if pd.isna(x) else x for x in rows["table"]]
    for column, d in enumerate((30, 90)):
        enter = [(int(s), int(v), 1, x) for s, v, x in zip(rows["known"], rows["turnover"], tables)]
        leave = [(int(s) + d + 1, -int(v), -1, x) for s, v, x in zip(rows["day"], rows["turnover"], tables)]
        steps = sorted(enter + leave, key=lambda e: e[0])
        held: dict = {}  # turnover and number of sums of each table
        heap: list = []  # with entries that no longer hold, which go once they are on top
        for i, (s, v, n, x) in enumerate(steps):
            before = held.get(x, (0, 0))
            held[x] = (before[0] + v, before[1] + n)
            heapq.heappush(heap, (-held[x][0], x is None, x or ""))
            if i + 1 == len(steps) or steps[i + 1][0] != s:
                while heap and not ((now := held[None if heap[0][1] else heap[0][2]])[0] == -heap[0][0] and now[1]):
                    heapq.heappop(heap)
                out.setdefault(s, [None, None])[column] = -heap[0][0] if heap else None
    return pd.DataFrame([(rows["canonical_id"].iloc[0], s, a, b) for s, (a, b) in out.items()], columns=["canonical_id", "s", "t30", "t90"]).astype({"t30": "Int64", "t90": "Int64"})


def frozen_profile(rows: DataFrame, at_us: int, days: int = 30) -> DataFrame:
    """One row an id as of a time: active days, theo and turnover in ``(at - days, at]``, and tenure in days."""
    t = F.col("session_us")
    df = rows.where(t <= at_us)
    w = t > at_us - days * DAY
    return df.groupBy("canonical_id").agg(
        F.count_distinct(F.when(w, F.col("session_date"))).alias("active_days_30d"), F.coalesce(F.sum(F.when(w, F.col("theo_win"))), F.lit(0.0)).alias("theo_win_sum_30d"),
        F.coalesce(F.sum(F.when(w, F.col("turnover"))), F.lit(0.0)).alias("turnover_sum_30d"), F.floor((F.lit(at_us) - F.min(t)) / DAY).alias("days_since_first_session"),
    )


def latest_profile(profiles: DataFrame, at_us: int, columns: list[str], per_column: bool = True) -> DataFrame:
    """The newest values at or before a time for each id: of each column that isn't null, or of the whole newest row."""
    df = profiles.where(F.col("snapshot_us") <= at_us).groupBy("canonical_id")
    if per_column:
        return df.agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("snapshot_us"))).alias(c) for c in columns])
    return df.agg(F.max_by(F.struct(*columns), "snapshot_us").alias("_r")).select("canonical_id", "_r.*")


def patron_history(sessions: DataFrame) -> DataFrame:
    """Of each id (card, else player): sessions, first and last time, span in days, and whether it is rated."""
    card = clean_card_id(F.col("casino_player_id"))
    df = dedup_sessions(sessions).select(F.coalesce(card, F.col("player_id").cast("string")).alias("canonical_id"), card.isNotNull().alias("rated"), F.coalesce("end_us", "lud_us").alias("us"))
    by = df.groupBy("canonical_id").agg(F.count("*").alias("sessions"), F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.bool_or("rated").alias("rated"))
    return by.withColumn("span_days", (F.col("last_us") - F.col("first_us")) / DAY)


def history_summary(history: DataFrame, thresholds: tuple[int, ...] = (10, 50, 100), top: int = 5) -> tuple[DataFrame, DataFrame]:
    """Of ``patron_history``: ids, quantiles of sessions and the share of ids above each threshold, by rated; and the ids
    of the longest spans. Quantiles come from counts by value, so that no task holds all of them."""
    counts = history.groupBy("rated", "sessions").agg(F.count("*").alias("n"))
    shares = counts.groupBy("rated").agg(F.sum("n").alias("ids"), *[(F.sum(F.when(F.col("sessions") > t, F.col("n")).otherwise(0)) / F.sum("n")).alias(f"over_{t}") for t in thresholds])
    quantiles = value_quantiles(history, "sessions", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, "rated")
    return shares.join(quantiles, "rated"), history.orderBy(F.desc("span_days"), "canonical_id").limit(top)


def merged_profiles(ids: DataFrame, *sources: DataFrame, key: str = "canonical_id") -> DataFrame:
    """For each id the first value that isn't null of each column, of sources in order, and the number of the source that
    had the id first, from 1."""
    out = ids.select(key).distinct()
    columns = list(dict.fromkeys(c for s in sources for c in s.columns if c != key))
    for i, s in enumerate(sources):
        out = out.join(s.select(key, F.lit(i + 1).alias(f"_in{i}"), *[F.col(c).alias(f"_{i}_{c}") for c in columns if c in s.columns]), key, "left")
    merged = [F.coalesce(*[F.col(f"_{i}_{c}") for i, s in enumerate(sources) if c in s.columns]).alias(c) for c in columns]
    return out.select(key, *merged, F.coalesce(*[F.col(f"_in{i}") for i in range(len(sources))]).alias("source"))


def profiles_at(ids: DataFrame, profiles: DataFrame, at_us: int, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """For each id its newest profile at or before a time, nulls without one; and counts of ids, of those without a
    profile, and of rows that came too late."""
    wanted = ids.select("canonical_id").where("canonical_id is not null").distinct()
    near = profiles.join(wanted, "canonical_id", "left_semi")
    best = near.where(F.col("snapshot_us") <= at_us).groupBy("canonical_id").agg(F.max_by(F.struct("snapshot_us", *columns), "snapshot_us").alias("_r"))
    out = wanted.join(best, "canonical_id", "left").select("canonical_id", "_r.*")
    late = near.agg(F.count_if(F.col("snapshot_us") > at_us).alias("dropped_rows"))
    return out, out.agg(F.count("*").alias("ids"), F.count_if(F.col("snapshot_us").isNull()).alias("missing")).join(F.broadcast(late))  # one row each
