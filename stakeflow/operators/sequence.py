"""Sequence operators over bets in time order: labels, streaks, runs, trips, head counts.

Rows of a key go by ``us`` (microseconds), then ``bet_id``. All are closed forms over window functions: one shuffle on
the key, and frames that Spark evaluates as it streams over a partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

MINUTE = 60_000_000


def in_order(*key: str):
    return Window.partitionBy(*key).orderBy("us", "bet_id")


def so_far(*key: str):
    return in_order(*key).rowsBetween(Window.unboundedPreceding, 0)


def known(bets: DataFrame, key: str) -> DataFrame:
    return bets.where(F.col(key).isNotNull() & F.col("us").isNotNull())


def walkaway_labels(bets: DataFrame, end_us: int, key: str = "player_id", gap: int = 30 * MINUTE, horizon: int = 15 * MINUTE) -> DataFrame:
    """Adds gap_start, censored and label: whether a pause of ``gap`` starts within ``horizon`` of the bet, itself and
    ties included. The last bet of a key starts one if the gap ends by ``end_us``, else it is censored. Rows without
    key or time go."""
    nxt = F.lead("us").over(in_order(key))
    df = known(bets, key).withColumn("_next", nxt)
    start = F.when(F.col("_next").isNull(), F.col("us") + gap <= end_us).otherwise(F.col("_next") - F.col("us") >= gap)
    df = df.withColumn("gap_start", start).withColumn("censored", F.col("_next").isNull() & (F.col("us") + gap > end_us))
    ahead = Window.partitionBy(key).orderBy("us").rangeBetween(0, horizon)
    return df.withColumn("label", F.max(F.col("gap_start").cast("int")).over(ahead)).drop("_next")


def streak(bets: DataFrame, counted: Column, resets: Column, key: str = "player_id", lookback: int | None = None, name: str = "streak", cutoff_us: int | None = None) -> DataFrame:
    """Adds how many ``counted`` rows there are since the last row that ``resets``; that row is 0.

    With ``lookback`` only rows later than it before the row count. Rows after ``cutoff_us`` go.
    """
    df = known(bets, key)
    df = df if cutoff_us is None else df.where(F.col("us") <= cutoff_us)
    one = F.when(counted, 1).otherwise(0)
    df = df.withColumn("_group", F.sum(F.when(resets, 1).otherwise(0)).over(so_far(key)))
    whole = F.sum(F.when(resets, 0).otherwise(one)).over(in_order(key, "_group").rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn(name, whole)
    if lookback is not None:
        old = Window.partitionBy(key).orderBy("us").rangeBetween(Window.unboundedPreceding, -lookback)
        within = F.sum(one).over(so_far(key)) - F.coalesce(F.sum(one).over(old), F.lit(0))
        df = df.withColumn(name, F.least(name, within))
    return df.drop("_group").withColumn(name, F.col(name).cast("long"))


def loss_streak(bets: DataFrame, push_resets: bool = False, **kw) -> DataFrame:
    reset = F.col("status").isin("WIN", "PUSH") if push_resets else F.col("status") == "WIN"
    return streak(bets, F.col("status") == "LOSE", reset, name="loss_streak", **kw)


def non_win_streak(bets: DataFrame, **kw) -> DataFrame:
    counted = F.coalesce(F.col("status").isin("LOSE", "PUSH"), F.lit(False))
    return streak(bets, counted, ~counted, name="non_win_streak", **kw)


def run_boundary(bets: DataFrame, key: str = "player_id", gap: int = 30 * MINUTE, lookback: int | None = None) -> DataFrame:
    """Adds run_id (from 0), run_start_us, minutes_since_run_start, bets_in_run, wager_in_run, net_in_run (the player's)
    and net_per_bet. A run starts at a pause of ``gap``; with ``lookback``, also at the first row inside it.

    Amounts are summed over the rows they are of, and not told from running totals, so that what was lost or is NaN
    elsewhere leaves them alone; null amounts don't count."""
    o = in_order(key)
    df = known(bets, key).withColumn("_new", F.when(F.lag("us").over(o).isNull() | (F.col("us") - F.lag("us").over(o) >= gap), 1).otherwise(0))
    df = df.withColumns({"_n": F.row_number().over(o), "_runs": F.sum("_new").over(so_far(key))})
    here = F.struct("_n", "us", "_runs")
    df = df.withColumn("_start", F.last(F.when(F.col("_new") == 1, here), ignorenulls=True).over(so_far(key)))
    first, frame = F.lit(1), so_far(key, "_runs")
    if lookback is not None:
        inside = Window.partitionBy(key).orderBy("us").rangeBetween(-(lookback - 1), 0)
        df = df.withColumn("_first", F.min(here).over(inside))
        df = df.withColumn("_start", F.greatest("_start", "_first"))
        first = F.col("_first._runs")
        df, up_to_row = tie_key(df, key)
        frame = up_to_row(lookback - 1, "_runs")
    df = df.withColumns({
        "run_id": (F.col("_runs") - first).cast("long"),
        "run_start_us": F.col("_start.us"),
        "minutes_since_run_start": (F.col("us") - F.col("_start.us")) / MINUTE,
        "bets_in_run": (F.col("_n") - F.col("_start._n") + 1).cast("long"),
        "wager_in_run": F.sum("wager").over(frame),
        "net_in_run": -F.sum("casino_win").over(frame),
    })
    df = df.withColumn("net_per_bet", F.col("net_in_run") / F.col("bets_in_run"))
    return df.drop("_new", "_n", "_runs", "_start", "_first", "_tie_us")


def run_sequence(bets: DataFrame, key: str = "player_id", gap: int = 30 * MINUTE) -> DataFrame:
    """Adds run_seq, from 1: how many pauses of ``gap`` or starts there have been."""
    last = F.lag("us").over(in_order(key))
    df = known(bets, key).withColumn("_new", F.when(last.isNull() | (F.col("us") - last >= gap), 1).otherwise(0))
    return df.withColumn("run_seq", F.sum("_new").over(so_far(key)).cast("long")).drop("_new")


def table_head_count(bets: DataFrame, start: int = 31 * MINUTE, end: int = MINUTE, placeholder: int = -1, bucket: int | None = None, cutoff_us: int | None = None) -> DataFrame:
    """Adds head_count: distinct players at the table from ``start`` to ``end`` before the bet, bounds included.

    A placeholder or null player isn't counted, nor are bets less than ``end`` before the cutoff. A player's bets that
    reach one another are a stay, which counts one from its beginning to its end; the count is a running sum of both.
    One table may hold a third of all rows, so that its time is cut into buckets, each of which begins with the stays
    that reach into it.
    """
    width = bucket or 4 * start
    rows = bets.where("table_id is not null and us is not null")
    pool = rows.where(F.col("player_id").isNotNull() & (F.col("player_id") != placeholder)).select("table_id", "player_id", "us")
    pool = pool if cutoff_us is None else pool.where(F.col("us") <= cutoff_us - end)
    order = Window.partitionBy("table_id", "player_id").orderBy("us")
    apart = F.when(F.col("us") - F.lag("us").over(order) <= start - end, 0).otherwise(1)
    stays = pool.withColumn("_new", apart).withColumn("_stay", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stays = stays.groupBy("table_id", "player_id", "_stay").agg((F.min("us") + end).alias("_from"), (F.max("us") + start + 1).alias("_to"))
    first = F.floor(F.col("_from") / width)
    none = F.lit(None).cast(rows.select(F.struct(*rows.columns).alias("r")).schema["r"].dataType)
    step = lambda b, at, n: F.struct(b.alias("bucket"), at.alias("us"), F.lit(n).alias("step"))
    begun = F.transform(F.sequence(first, F.floor((F.col("_to") - 1) / width)), lambda b: step(b, F.greatest(F.col("_from"), b * width), 1))
    last = F.floor(F.col("_to") / width)  # a stay that ends with its bucket needs no end
    ended = F.when(last * width < F.col("_to"), F.array(step(last, F.col("_to"), -1))).otherwise(F.array().cast("array<struct<bucket:bigint,us:bigint,step:int>>"))
    steps = stays.select("table_id", F.explode(F.concat(begun, ended)).alias("s")).select("table_id", F.col("s.bucket").alias("_bucket"), "s")
    events = steps.select(F.col("table_id").alias("_table"), "_bucket", F.col("s.us").alias("_us"), F.col("s.step").alias("_step"), F.lit(0).alias("_kind"), none.alias("_row"))
    seen = rows.select(F.col("table_id").alias("_table"), F.floor(F.col("us") / width).alias("_bucket"), F.col("us").alias("_us"), F.lit(0).alias("_step"), F.lit(1).alias("_kind"), F.struct(*rows.columns).alias("_row"))
    run = Window.partitionBy("_table", "_bucket").orderBy("_us", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    counted = seen.unionByName(events).withColumn("head_count", F.sum("_step").over(run).cast("long")).where("_kind = 1")
    return counted.select("_row.*", "head_count")


def trip_sequence(runs: DataFrame, empty_days: int = 3) -> DataFrame:
    """Adds trip_seq (from 1) and run_in_trip (from 0) to runs (player_id, run_id, run_start_us, start_day, end_day):
    a trip starts after ``empty_days`` whole days without a run."""
    o = Window.partitionBy("player_id").orderBy("run_start_us", "run_id")
    gone = F.datediff("start_day", F.lag("end_day").over(o))
    df = runs.withColumn("_new", F.when(gone.isNull() | (gone > empty_days), 1).otherwise(0))
    df = df.withColumn("trip_seq", F.sum("_new").over(o.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_new")
    in_trip = Window.partitionBy("player_id", "trip_seq").orderBy("run_start_us", "run_id")
    return df.withColumn("run_in_trip", (F.row_number().over(in_trip) - 1).cast("long"))


def session_running(bets: DataFrame) -> DataFrame:
    """Adds the session's bets, wager, average wager, minutes and bets a minute up to the bet."""
    w = so_far("session_id")
    df = bets.where("session_id is not null and us is not null")
    df = df.withColumns({"session_bets": F.row_number().over(in_order("session_id")).cast("long"), "session_wager": F.sum("wager").over(w), "session_minutes": F.greatest(F.lit(0.0), (F.col("us") - F.min("us").over(w)) / MINUTE)})
    return df.withColumns({"session_average": F.col("session_wager") / F.col("session_bets"), "bets_per_minute": F.when(F.col("session_minutes") > 0, F.col("session_bets") / F.col("session_minutes")).otherwise(0.0)})


def tie_key(df: DataFrame, key: str, order: str = "bet_id", name: str = "_tie_us") -> tuple[DataFrame, Callable[..., WindowSpec]]:
    """Adds a time that tells ties apart, and gives the RANGE frame on it from ``width`` before a row, inclusive, up to the
    row itself; among the rows of the key that have the same ``within``, if named.

    A microsecond has twice as many steps as there are rows of a key at one time, at most (counted here). A frame that
    reaches back by the width and that many steps takes all rows at its first microsecond and none before it. Where
    longs don't hold the steps, decimals do.
    """
    most, lo, hi = df.groupBy(key, "us").agg(F.count("*").alias("n")).where("us is not null").agg(F.max("n"), F.min("us"), F.max("us")).first()
    most, lo, reach = (most, lo, hi - lo + 1) if most else (1, 0, 1)
    step, us = 2 * most, F.col("us")
    at = (us - lo) * step if (reach + 1) * step < 2**62 else (us.cast("decimal(20,0)") - F.lit(lo)) * F.lit(step).cast("decimal(17,0)")
    one = Window.partitionBy(key)  # the partitions and order of the frames, so that rows are dealt and sorted once
    tie = F.row_number().over(one.orderBy("us", order)) - F.rank().over(one.orderBy("us")) + 1

    def up_to_row(width: int, *within: str) -> WindowSpec:
        back = min(width, reach) * step + most
        if back >= 2**63:
            raise ValueError(f"{most} rows at one time are too many for a window of {width}")
        return Window.partitionBy(key, *within).orderBy(name).rangeBetween(-back, 0)

    return df.withColumn(name, at + tie), up_to_row


def session_windows(bets: DataFrame, counts=(5, 15, 30), wagers=(10, 30), unit: int = MINUTE) -> DataFrame:
    """Adds bets_last_k and wager_last_k within the session, for each k minutes."""
    df, up_to_row = tie_key(bets.where("session_id is not null and us is not null"), "session_id")
    more = {f"bets_last_{k}": F.count("*").over(up_to_row(k * unit)) for k in counts}
    more |= {f"wager_last_{k}": F.sum("wager").over(up_to_row(k * unit)) for k in wagers}
    return df.withColumns(more).drop("_tie_us")


def alert_gaps(alerts: DataFrame, bets: DataFrame, gap: int = 30 * MINUTE, horizon: int = 15 * MINUTE, look: int = 45 * MINUTE) -> DataFrame:
    """For each alert (alert_id, player_id, alert_us): gap_found, whether after its last bet a pause of ``gap`` starts
    within ``horizon`` of it, the open end counting up to ``look``; late_bet, whether a bet is later than ``horizon``;
    and n_bets within ``look``. The join is on the player with a time bucket, so that it is an equality."""
    a = alerts.withColumn("_b", F.explode(F.sequence(F.floor(F.col("alert_us") / look), F.floor((F.col("alert_us") + look) / look))))
    b = bets.select("player_id", "us", F.floor(F.col("us") / look).alias("_b"))
    near = a.join(b, ["player_id", "_b"]).where((F.col("us") > F.col("alert_us")) & (F.col("us") <= F.col("alert_us") + look))
    points = near.select("alert_id", "alert_us", "us", F.lit(1).alias("bet"))
    ends = alerts.select("alert_id", "alert_us", F.col("alert_us").alias("us"), F.lit(0).alias("bet"))
    close = alerts.select("alert_id", "alert_us", (F.col("alert_us") + look).alias("us"), F.lit(0).alias("bet"))
    o = Window.partitionBy("alert_id").orderBy("us", "bet")
    walk = points.unionByName(ends).unionByName(close).withColumn("_last", F.lag("us").over(o))
    found = (F.col("us") - F.col("_last") >= gap) & (F.col("_last") - F.col("alert_us") <= horizon)
    late = (F.col("bet") == 1) & (F.col("us") > F.col("alert_us") + horizon)
    return walk.groupBy("alert_id").agg(F.coalesce(F.bool_or(found), F.lit(False)).alias("gap_found"), F.bool_or(late).alias("late_bet"), F.sum("bet").cast("long").alias("n_bets"))


def verdicts(gaps: DataFrame, now_us: int, wait: int = 47 * MINUTE, finality: int = 60 * MINUTE) -> DataFrame:
    """Adds verdict to ``alert_gaps`` with alert_us: TOO_RECENT before ``wait``; PENDING without bets or, with a gap,
    until ``finality``; then MISS if a late bet was seen, else MATCH; without a gap the same test at once."""
    age = F.lit(now_us) - F.col("alert_us")
    done = F.when(F.col("late_bet"), "MISS").otherwise("MATCH")
    return gaps.withColumn("verdict", F.when(age < wait, "TOO_RECENT").when(F.col("n_bets") == 0, "PENDING").when(F.col("gap_found") & (age < finality), "PENDING").otherwise(done))
