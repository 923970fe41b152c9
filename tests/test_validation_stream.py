"""The stream of verdicts against batch validation at every stop."""

import random
import tempfile

from pyspark.sql import functions as F

from stakeflow.operators import live
from stakeflow.streaming import queries as streams
from stakeflow.streaming import validation

MINUTE = 60_000_000
BETS = "bet_id long, player_id long, canonical_id string, us long, wager double, seen timestamp"


def made(seed, n):
    """Bets of ten identities over five hours, seen up to 80 minutes late; every fifth is an alert, seen at once or late."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        player = r.randint(1, 20) if i >= 100 else i // 5 + 1  # each player has an alert from the first stop on
        us = r.randint(0, 300 if i >= 100 else 30) * MINUTE + r.randint(0, 5) * 1000
        seen = us + r.choice([0, 0, 0, 1, 5, 30, 50, 80]) * MINUTE
        rows.append((i, player, str(player // 2), us, float(r.randint(1, 9)), seen))
    alerts = [(i, p, c, us, us + (r.choice([0, 1, 10, 55]) if i >= 100 else 0) * MINUTE) for i, p, c, us, _, _ in rows if i % 5 == 0]
    return rows, alerts


def frames(spark, rows, alerts):
    b = spark.createDataFrame(rows, "bet_id long, player_id long, canonical_id string, us long, wager double, seen_us long")
    a = spark.createDataFrame(alerts, "alert_id long, player_id long, canonical_id string, alert_us long, seen_us long")
    return b.withColumn("seen", F.timestamp_micros("seen_us")), a.withColumn("seen", F.timestamp_micros("seen_us"))


def run(spark, at):
    """All that is there, one file at a time, from where the last run stopped."""
    b = streams.stream_table(spark, f"{at}/bets", spark.read.parquet(f"{at}/bets").schema, 1)
    a = streams.stream_table(spark, f"{at}/alerts", spark.read.parquet(f"{at}/alerts").schema, 1)
    with validation.keyed_state(spark):
        q = validation.verdict_log(a, b).writeStream.option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{at}/log")
        q.awaitTermination()
    return spark.read.schema(validation.LOG).parquet(f"{at}/log")


def test_verdicts_are_those_of_batch_validation_at_every_stop(spark):
    rows, alerts = made(1, 400)
    b, a = frames(spark, rows, alerts)
    at = tempfile.mkdtemp(prefix="spark-verdicts-")
    stored, last, reopened = None, None, 0
    for stop in (90 * MINUTE, 150 * MINUTE, 210 * MINUTE, 400 * MINUTE):
        new = (F.col("seen_us") <= stop) & (F.col("seen_us") > (-1 if last is None else last))
        b.where(new).coalesce(1).write.mode("append").parquet(f"{at}/bets")
        a.where(new).coalesce(1).write.mode("append").parquet(f"{at}/alerts")
        log = run(spark, at)  # a restart from the checkpoint each time
        now = max(s for *_, s in [*rows, *alerts] if s <= stop) // 1000 * 1000
        known_b, known_a = b.where(F.col("seen_us") <= stop), a.where(F.col("seen_us") <= stop)
        told = live.validated(known_a, known_b, now) if stored is None else None
        merged = live.serving.merge_verdicts(told.limit(0), told, now) if stored is None else live.revalidated(stored, known_a, known_b, now, last_us=last_now)
        stored = spark.createDataFrame(merged.where("verdict <> 'TOO_RECENT'").collect(), merged.schema)
        want = {r.alert_id: (r.alert_us, r.verdict) for r in stored.collect()}
        got = {r.alert_id: (r.alert_us, r.verdict) for r in validation.current_verdicts(log).collect()}
        assert got == want, {k: (got.get(k), want.get(k)) for k in set(got) | set(want) if got.get(k) != want.get(k)}
        reopened, last, last_now = validation.reopened(log).count(), stop, now
    assert len(got) == len(alerts) and {v for _, v in got.values()} == {"MATCH", "MISS"} and reopened > 0
    again = run(spark, at)  # nothing new: the same log
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, log.collect()))


def test_precision_of_windows_is_that_of_the_batch(spark):
    """Windows of an hour, every quarter, over a log that grows between runs: each that has gone by is the batch's, once."""
    r = random.Random(4)
    log = [("a", i, 0, r.choice(["MATCH", "MISS", "PENDING"]), r.randint(0, 240) * MINUTE) for i in range(300)]
    log += [("a", i, 0, v, t + 1000) for _, i, _, v, t in log[::7]]  # told again as they were
    df = spark.createDataFrame(log, validation.LOG)
    at = tempfile.mkdtemp(prefix="spark-precision-")
    for lo, hi in ((-1, 100), (100, 180), (180, 400)):
        df.where((F.col("told_us") > lo * MINUTE) & (F.col("told_us") <= hi * MINUTE)).coalesce(1).write.mode("append").parquet(f"{at}/log")
        stream = validation.precision_stream(streams.stream_table(spark, f"{at}/log", df.schema), "60 minutes", "15 minutes")
        stream.writeStream.option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{at}/out").awaitTermination()
    got = {x.start_us: (x.total, x.matches) for x in spark.read.parquet(f"{at}/out").collect()}
    assert len(got) == spark.read.parquet(f"{at}/out").count() and len(got) > 12
    once = {(i, v): t for _, i, _, v, t in reversed(log) if v != "PENDING"}
    for start, counts in got.items():
        inside = [v for (_, v), t in once.items() if start <= t < start + 60 * MINUTE]
        assert counts == (len(inside), inside.count("MATCH")), start
        results = spark.createDataFrame([(t, v == "MATCH") for (_, v), t in once.items()], "us long, is_match boolean")
    last = max(got)  # a window of the stream is the batch's trailing one at its end
    one = live.serving.rolling_precision(results, last + 60 * MINUTE - 1, {"h": 60 * MINUTE}).first()
    assert (one.total, one.matches) == got[last]


def test_of_verdicts_told_at_one_time_the_later_stage_counts(spark):
    """A restart tells rows at the watermark of the run before: which row is read first mustn't matter."""
    rows = [("a", 1, 0, "PENDING", 5), ("a", 1, 0, "MISS", 5), ("a", 2, 0, "MISS", 5), ("a", 2, 0, "MATCH", 5), ("a", 3, 0, "PENDING", 5), ("a", 3, 0, "MATCH", 5), ("a", 4, 0, "PENDING", 4), ("a", 4, 0, "MISS", 5)]
    for told in (rows, rows[::-1]):
        log = spark.createDataFrame(told, validation.LOG).coalesce(1)
        assert {r.alert_id: r.verdict for r in validation.current_verdicts(log).collect()} == {1: "MISS", 2: "MATCH", 3: "MATCH", 4: "MISS"}
        assert {r.alert_id: (r["first"], r["last"]) for r in validation.reopened(log).collect()} == {1: ("PENDING", "MISS"), 2: ("MISS", "MATCH"), 3: ("PENDING", "MATCH"), 4: ("PENDING", "MISS")}
