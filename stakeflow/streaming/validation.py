"""Delayed validation of alerts over streams: keyed state, event-time timers, and late bets.

The clock is the observed time, when a row was seen, and not when its bet was made: bets that come late are ordinary
rows, and what the watermark has passed is what a validator of that minute would have known. The open alerts and recent bets
of identities are the state, dealt into buckets; a bucket's verdicts are told again when its rows come, and when its next
alert is due.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

MINUTE = 60_000_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
LOG = "canonical_id string, alert_id long, alert_us long, verdict string, told_us long"
#: The open alerts of a bucket, with what they were told last, and its recent bets; ``who`` is a place among its identities.
ALERTS = np.dtype([("who", "<i8"), ("us", "<i8"), ("id", "<i8"), ("verdict", "i1")])
BETS = np.dtype([("who", "<i8"), ("us", "<i8"), ("id", "<i8"), ("counts", "?")])
STATE = "identities array<string>, alerts binary, bets binary"
#: Identities are dealt by their hash into so many rows of state.
BUCKETS = 2048
UNTOLD, PENDING, MISS, MATCH = range(4)
STAGES = np.array([None, "PENDING", "MISS", "MATCH"], object)
#: Kinds of rows; bets that don't count have no wager.
OTHER_BET, BET, ALERT = range(3)


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, on disk; the session's own setting comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


class Verdicts:
    """The open alerts and recent bets of a bucket of identities: one row of state, of packed arrays, with one timer, so that a
    batch costs a call a bucket, whatever its alerts and identities.

    An alert is told from ``wait`` on, and goes once it is a MATCH, or ``finality`` has passed; bets go when they are older
    than what an alert that comes ``finality`` late could look at. The timer is for the next moment at which a verdict can
    change without new rows, or the last bet goes."""

    def __init__(self, gap: int, horizon: int, look: int, wait: int, finality: int):
        self.gap, self.horizon, self.look, self.wait, self.finality = gap, horizon, look, wait, finality
        self.keep = 2 * finality + look

    def step(self, _: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs() * 1000
        names, alerts, bets = state.getOption or ([], b"", b"")
        place = {n: k for k, n in enumerate(names)}
        alerts, bets = [np.frombuffer(alerts, ALERTS)], [np.frombuffer(bets, BETS)]
        for part in () if state.hasTimedOut else parts:
            codes, new = pd.factorize(part["canonical_id"].to_numpy(object))
            who = np.array([place.setdefault(n, len(place)) for n in new], "i8")[codes]
            us, ids, kind = (part[c].to_numpy() for c in ("us", "id", "kind"))
            alerts.append(_packed(ALERTS, kind == ALERT, who=who, us=us, id=ids))
            bets.append(_packed(BETS, kind != ALERT, who=who, us=us, id=ids, counts=kind == BET))
        names = np.array(list(place), object)
        alerts = _first(np.concatenate(alerts), "who", "id")  # with what it was told, if it was here before
        bets = _first(np.concatenate(bets), "who", "us", "id", "counts")
        verdict, final = self.told(alerts, bets, now)
        told = verdict != alerts["verdict"]
        if told.any():
            yield pd.DataFrame({"canonical_id": names[alerts["who"][told]], "alert_id": alerts["id"][told], "alert_us": alerts["us"][told], "verdict": STAGES[verdict[told]], "told_us": now})
        alerts["verdict"] = verdict
        alerts = alerts[~final]
        since = np.full(len(names), now - self.keep)
        np.minimum.at(since, alerts["who"], alerts["us"])
        bets = bets[bets["us"] >= since[bets["who"]]]
        left = np.union1d(alerts["who"], bets["who"])
        if len(left):
            alerts["who"], bets["who"] = np.searchsorted(left, alerts["who"]), np.searchsorted(left, bets["who"])
            state.update((names[left].tolist(), alerts.tobytes(), bets.tobytes()))
            # it is due when the watermark has passed it, and not when it is reached
            state.setTimeoutTimestamp(max(-(-self.due(alerts, bets, now) // 1000) - 1, 1))
        else:
            state.remove()

    def told(self, alerts: np.ndarray, bets: np.ndarray, now: int) -> tuple[np.ndarray, np.ndarray]:
        """The verdict of each alert, as it was while it is too soon, and whether it is final. It goes by the bets of its identity
        that are later than the alert, to the end of the look-ahead: those in the places from ``first`` to ``last``."""
        at, age = alerts["us"], now - alerts["us"]
        counted = bets[bets["counts"]]
        times, moments = counted["us"], np.unique(counted["us"])
        key = lambda who, us: who * (len(moments) + 1) + np.searchsorted(moments, us, "right")
        keys = key(counted["who"], times)
        first, near, last = (np.searchsorted(keys, key(alerts["who"], at + x), "right") for x in (0, self.horizon, self.look))
        some, end, padded = last > first, at + self.look, np.append(times, 0)
        pauses = np.append(0, np.cumsum(np.diff(times, append=times[-1:]) >= self.gap))  # that begin before each place
        gap = np.where(some, padded[first], end) - at >= self.gap
        gap |= pauses[np.maximum(np.minimum(near, last - 1), first)] > pauses[first]
        gap |= some & (last <= near) & (end - padded[last - 1] >= self.gap)
        alone = np.isin(alerts["who"], counted["who"], invert=True)
        if alone.any():  # the alert's own bet is the last one
            theirs = bets[np.isin(bets["who"], alerts["who"][alone])]
            own = set(zip(theirs["who"].tolist(), theirs["id"].tolist()))
            some[alone] = [x in own for x in zip(alerts["who"][alone].tolist(), alerts["id"][alone].tolist())]
        verdict = np.where(~some | (gap & (age < self.finality)), PENDING, np.where(last > near, MISS, MATCH))
        verdict = np.where((alerts["verdict"] == MISS) & (verdict != MATCH), MISS, verdict)
        final = (age >= self.wait) & ((verdict == MATCH) | (age > self.finality))
        verdict = np.where(final & (verdict == PENDING), MISS, verdict)
        return np.where(age < self.wait, alerts["verdict"], verdict), final

    def due(self, alerts: np.ndarray, bets: np.ndarray, now: int) -> int:
        """When the next verdict is told, a pause stops holding one back, or finality has passed; without an open alert, when no
        bet is recent."""
        if not len(alerts):
            return int(bets["us"].max()) + self.keep + 1
        age = now - alerts["us"]
        return int((alerts["us"] + np.where(age < self.wait, self.wait, self.finality + (age >= self.finality))).min())


def _packed(kind: np.dtype, chosen: np.ndarray, **columns: np.ndarray) -> np.ndarray:
    out = np.zeros(int(chosen.sum()), kind)
    for c, values in columns.items():
        out[c] = values[chosen]
    return out


def _first(rows: np.ndarray, *by: str) -> np.ndarray:
    """The first of the rows that are equal in some columns, in their order."""
    rows = rows[np.lexsort([rows[c] for c in by[::-1]])]
    same = np.logical_and.reduce([rows[c][1:] == rows[c][:-1] for c in by])
    return rows[np.append(True, ~same)[: len(rows)]]


def verdict_log(alerts: DataFrame, bets: DataFrame, delay: str = "0 seconds", gap: int = 30 * MINUTE, horizon: int = 15 * MINUTE, look: int = 45 * MINUTE, wait: int = 47 * MINUTE, finality: int = 60 * MINUTE, buckets: int = BUCKETS) -> DataFrame:
    """A row, LOG, for each verdict of an alert and each change of it, as a stream in append mode.

    ``alerts`` (alert_id, canonical_id, alert_us, seen) and ``bets`` (bet_id, canonical_id, us, wager, seen) are streams;
    ``seen`` is a timestamp, and the watermark of it, ``delay`` behind, the time at which verdicts are told. Alerts younger
    than ``wait`` have none. Bets without a wager only stand for an alert's own bet. Repeated alerts and bets count once;
    rows without an identity, id or time go. Start it within ``keyed_state``; a checkpoint goes on with as many ``buckets`` as
    it began with."""
    a = alerts.select("canonical_id", F.col("alert_id").alias("id"), F.col("alert_us").alias("us"), F.lit(ALERT).alias("kind"), "seen")
    b = bets.select("canonical_id", F.col("bet_id").alias("id"), "us", F.when(F.col("wager") > 0, BET).otherwise(OTHER_BET).alias("kind"), "seen")
    rows = a.unionByName(b).where("canonical_id is not null and id is not null and us is not null").withWatermark("seen", delay)
    step = Verdicts(gap, horizon, look, wait, finality).step
    return rows.withColumn("bucket", F.pmod(F.xxhash64("canonical_id"), F.lit(buckets))).groupBy("bucket").applyInPandasWithState(step, LOG, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _told() -> Column:
    """The order of an alert's rows: after a restart, rows are told at the watermark of the run before, and may change what
    that told at the same time. Verdicts only go from PENDING to MISS, and from either to MATCH."""
    return F.struct("told_us", F.when(F.col("verdict") == "MATCH", 2).when(F.col("verdict") == "MISS", 1).otherwise(0))


def current_verdicts(log: DataFrame, told_by: int | None = None) -> DataFrame:
    """alert_id, alert_us, verdict: the last row of each alert in a log, up to a time."""
    log = log if told_by is None else log.where(F.col("told_us") <= told_by)
    return log.groupBy("alert_id").agg(F.max_by("alert_us", _told()).alias("alert_us"), F.max_by("verdict", _told()).alias("verdict"))


def precision_stream(log: DataFrame, size: str, slide: str, delay: str = "0 seconds") -> DataFrame:
    """start_us, total, matches and precision of the alerts told to be a MATCH or a MISS in each sliding window, over the stream
    of a log: deduplication, then windows, in append mode, so that both forget what the watermark has passed. What is
    told again as it was doesn't count."""
    told = log.where("verdict in ('MATCH', 'MISS')").withColumn("told", F.timestamp_micros("told_us")).withWatermark("told", delay).dropDuplicatesWithinWatermark(["alert_id", "verdict"])
    w = told.groupBy(F.window("told", size, slide)).agg(F.count("*").alias("total"), F.count_if(F.col("verdict") == "MATCH").alias("matches"))
    return w.select(F.unix_micros("window.start").alias("start_us"), "total", "matches", (F.col("matches") / F.col("total")).alias("precision"))


def reopened(log: DataFrame) -> DataFrame:
    """alert_id, first, last, and n of alerts whose verdict changed after it was first told: what late bets did."""
    w = Window.partitionBy("alert_id")
    seen = log.withColumn("n", F.count("*").over(w)).where("n > 1")
    return seen.groupBy("alert_id").agg(F.min_by("verdict", _told()).alias("first"), F.max_by("verdict", _told()).alias("last"), F.max("n").alias("n"))
