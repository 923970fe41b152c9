"""The state behind the stream of verdicts: a row a bucket with one timer, gone when all is told, and verdicts of a bucket at once."""

import json
import random
import tempfile
from bisect import bisect_right

import numpy as np
from pyspark.sql import functions as F

from stakeflow.streaming import queries as streams
from stakeflow.streaming import validation

MINUTE = 60_000_000
T = 1_700_000_000_000_000
BETS = "bet_id long, canonical_id string, us long, wager double, seen_us long"


def told(spark, *stops, **options):
    """The log after batches of bets (those over 60 are alerts), and the rows of state after each."""
    at = tempfile.mkdtemp(prefix="spark-verdict-state-")
    counts = []
    for rows in stops:
        df = spark.createDataFrame(rows, BETS).withColumn("seen", F.timestamp_micros("seen_us")).drop("seen_us")
        df.coalesce(1).write.mode("append").parquet(f"{at}/bets")
        b = streams.stream_table(spark, f"{at}/bets", df.schema)
        a = b.where("wager > 60").select(F.col("bet_id").alias("alert_id"), "canonical_id", F.col("us").alias("alert_us"), "seen")
        with validation.keyed_state(spark):
            q = validation.verdict_log(a, b, **options).writeStream.option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{at}/log")
            q.awaitTermination()
        progress = [json.loads(p.json) for p in q.recentProgress]
        counts.append([p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]])
    return sorted(map(tuple, spark.read.schema(validation.LOG).parquet(f"{at}/log").collect()), key=str), counts


def test_state_has_a_row_a_bucket_and_goes_with_the_last_bet(spark):
    """Rows of state don't grow with an identity's alerts and bets, each alert's verdict is told, and nothing stays behind."""
    rows = [(10 * i + k, f"c{k}", T + i * 1000, 61.0, T + i * 1000) for i in range(60) for k in range(4)]
    clock = lambda minutes: [(minutes, "clock", T + minutes * MINUTE, 1.0, T + minutes * MINUTE)]
    old = [(9999, "old", T - 600 * MINUTE, 1.0, T + 61 * MINUTE)]  # nobody can look at it any more when it comes
    log, counts = told(spark, rows, clock(48), clock(61) + old, clock(600))
    assert max(max(c) for c in counts) <= 5, counts
    assert counts[-1][-1] <= 1, counts  # the clock's own bet
    last = {}
    for _, alert, at, verdict, us in sorted(log, key=lambda r: r[4]):
        last[alert] = verdict
    assert last == {r[0]: "MATCH" if r[0] < 590 else "MISS" for r in rows}  # nothing comes after an identity's last alert


def test_a_pause_holds_a_verdict_back_until_finality_and_not_longer(spark):
    """At the very moment that an alert is ``finality`` old, its pause no longer counts, though no row of its own comes."""
    clock = lambda minutes: [(minutes, "clock", T + minutes * MINUTE, 1.0, T + minutes * MINUTE)]
    first = [(1000, "a", T, 61.0, T), (1001, "a", T + 5 * MINUTE, 1.0, T + 5 * MINUTE)]
    log, _ = told(spark, first, clock(50), clock(60))
    assert log == [("a", 1000, T, "MATCH", T + 60 * MINUTE), ("a", 1000, T, "PENDING", T + 50 * MINUTE)]
    log, _ = told(spark, first, clock(50), clock(60), buckets=1)  # with another identity in its bucket
    assert log == [("a", 1000, T, "MATCH", T + 60 * MINUTE), ("a", 1000, T, "PENDING", T + 50 * MINUTE)]


def test_verdicts_of_a_bucket_are_those_of_a_walk_over_each_identity():
    r = random.Random(7)
    v = validation.Verdicts(30 * MINUTE, 15 * MINUTE, 45 * MINUTE, 47 * MINUTE, 60 * MINUTE)
    seen = set()
    for _ in range(60):
        bets = sorted({(r.randint(0, 5), T + r.randint(0, 150) * MINUTE, r.randint(0, 60), r.random() < 0.8) for _ in range(r.choice([0, 1, 3, 60]))})
        bets = [b for b in bets if b[0] != 2 or not b[3]]  # an identity whose bets have no wager
        alerts = sorted({(w, i): (w, T + r.randint(0, 150) * MINUTE, i, r.choice([0, 0, 1, 2])) for w, i in ((r.randint(0, 5), r.randint(0, 60)) for _ in range(30))}.values())
        now = T + r.randint(40, 220) * MINUTE
        got, final = v.told(np.array(alerts, validation.ALERTS), np.array(bets, validation.BETS), now)
        for (who, at, alert, before), g, f in zip(alerts, got, final):
            times = [us for w, us, _, counts in bets if w == who and counts]
            after = times[bisect_right(times, at) : bisect_right(times, at + v.look)]
            own = not times and any(w == who and b == alert for w, _, b, _ in bets)
            gap = any(a - at <= v.horizon and b - a >= v.gap for a, b in zip([at, *after], [*after, at + v.look]))
            if now - at < v.wait:
                want, end = before, False
            else:
                want = 1 if not (after or own) or (gap and now - at < v.finality) else 2 if after and after[-1] > at + v.horizon else 3
                want = 2 if before == 2 and want != 3 else want
                end = want == 3 or now - at > v.finality
                want = 2 if end and want == 1 else want
            assert (g, f) == (want, end), (who, at, alert, before, now)
            seen.add((int(g), bool(f)))
    assert seen >= {(0, False), (1, False), (2, False), (2, True), (3, True)}
