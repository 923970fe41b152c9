"""Keyed tables by buckets: what a batch touches, batches that run again, expiry, and streams."""

import glob
import os
import random
import tempfile

from pyspark.sql import functions as F

from stakeflow.sources.keyed import DAY, KeyedTable
from stakeflow.streaming import queries as streams

HOUR = 3_600_000_000
SCHEMA = "session_id long, bets long, wager double, first_us long, last_us long"
RULES = {"bets": "sum", "wager": "sum", "first_us": "min", "last_us": "max"}


def table(spark, at, **kw):
    return KeyedTable(spark, at, "session_id", RULES, buckets=8, **kw)


def contents(t, spark):
    return sorted(map(tuple, t.read(spark.createDataFrame([], SCHEMA).schema).select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect()), key=str)


def files(at):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{at}/data/*/*/*.parquet")}


def test_a_batch_of_one_key_rewrites_one_bucket(spark):
    at = tempfile.mkdtemp(prefix="spark-keyed-")
    t = table(spark, at)
    first = spark.range(200).select(F.col("id").alias("session_id"), F.lit(1).cast("long").alias("bets"), F.lit(2.0).alias("wager"), F.col("id").alias("first_us"), F.col("id").alias("last_us"))
    assert t.put(first, 0) == set(range(8))
    before = files(at)
    one = spark.createDataFrame([(7, 1, 3.0, 900, 900), (7, 1, 1.0, 5, 5)], SCHEMA)
    assert len(t.put(one, 1)) == 1
    after = files(at)
    assert all(after[p] == before[p] for p in before) and len(after) == len(before) + 1  # the last version stays for its readers
    assert (7, 3, 6.0, 5, 900) in contents(t, spark) and len(contents(t, spark)) == 200
    same = contents(t, spark)
    t.put(one, 1)  # a batch that runs again
    assert contents(t, spark) == same and len(files(at)) == len(after)
    t.put(one, 2), t.put(one, 3)
    assert len(files(at)) == len(before) + 1 and (7, 7, 14.0, 5, 900) in contents(t, spark)
    t.put(one.limit(0), 4)
    assert len(contents(t, spark)) == 200


def test_old_rows_expire_and_null_keys_stay_together(spark):
    at = tempfile.mkdtemp(prefix="spark-keyed-")
    t = table(spark, at, time="last_us")
    t.put(spark.createDataFrame([(1, 1, 1.0, 0, 0), (2, 1, 1.0, 0, HOUR), (None, 1, 1.0, 0, HOUR), (None, 1, 1.0, 0, HOUR)], SCHEMA), 0)
    t.put(spark.createDataFrame([(3, 1, 1.0, 0, DAY + HOUR)], SCHEMA), 1)
    assert [r[:2] for r in sorted(contents(t, spark), key=str)] == [(2, 1), (3, 1), (None, 2)]  # 1 is a day and an hour old
    t.put(spark.createDataFrame([(1, 1, 5.0, 2 * DAY, 2 * DAY)], SCHEMA), 2)
    assert [r[:3] for r in contents(t, spark) if r[0] == 1] == [(1, 1, 5.0)]  # what had expired isn't added to


def test_a_stream_of_batches_is_one_aggregate(spark):
    r = random.Random(2)
    at = tempfile.mkdtemp(prefix="spark-keyed-")
    rows = [(r.randint(1, 30), 1, float(r.randint(1, 9)), us, us) for us in range(300)]
    for i in range(3):
        spark.createDataFrame(rows[i * 100 : i * 100 + 100], SCHEMA).coalesce(1).write.mode("append").parquet(f"{at}/in")
        stream = streams.stream_table(spark, f"{at}/in", spark.createDataFrame([], SCHEMA).schema, 1)
        table(spark, f"{at}/t").follow(stream, f"{at}/checkpoint").awaitTermination()
    want = {}
    for k, n, w, a, b in rows:
        x = want.get(k, (0, 0.0, a, b))
        want[k] = (x[0] + n, x[1] + w, min(x[2], a), max(x[3], b))
    assert contents(table(spark, f"{at}/t"), spark) == sorted(((k, *v) for k, v in want.items()), key=str)
