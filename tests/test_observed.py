"""The stream by observed time: rows that come late, cursors among ties, restarts, and visibility."""

import random
import tempfile

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from stakeflow.sources import observed

MINUTE = 60_000_000
SCHEMA = "bet_id long, us long, etl_us long, wager double"


def drained(spark, at, now, **kw):
    before = set() if not kw.pop("seen", None) else {r.bet_id for r in spark.read.parquet(f"{at}/out").collect()}
    stream = observed.observed_stream(spark, f"{at}/bets", now_us=now, **kw)
    stream.writeStream.format("parquet").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start(f"{at}/out").awaitTermination()
    rows = [r.bet_id for r in spark.read.schema(SCHEMA).parquet(f"{at}/out").collect()]
    assert len(rows) == len(set(rows))
    return set(rows) - before


def test_each_row_is_read_once_when_it_is_visible(spark):
    r = random.Random(3)
    rows = []
    for i in range(600):
        us = r.randint(0, 200) * MINUTE
        rows.append((i, us, None if r.random() < 0.2 else us + r.choice([0, 0, 1, 30, 90]) * MINUTE, 1.0))
    r.shuffle(rows)
    at = tempfile.mkdtemp(prefix="spark-observed-")
    when = lambda x: x[1] if x[2] is None else x[2]
    last = -1
    for stop in (60 * MINUTE, 61 * MINUTE, 150 * MINUTE, 400 * MINUTE):
        new = [x for x in rows if last < when(x) <= stop]
        spark.createDataFrame(new, SCHEMA).write.mode("append").parquet(f"{at}/bets")
        got = drained(spark, at, stop, seen=last >= 0)
        want = {x[0] for x in rows if when(x) <= stop - MINUTE} - {x[0] for x in rows if last >= 0 and when(x) <= last - MINUTE}
        assert got == want, stop
        assert drained(spark, at, stop, seen=True) == set()  # a restart reads nothing again
        last = stop
    late = [x for x in rows if x[2] is not None and x[2] - x[1] >= 30 * MINUTE]
    assert late and len(spark.read.parquet(f"{at}/out").collect()) == 600


def test_cursors_stand_between_rows_of_one_time(spark):
    """The cursor is of time and id: rows of its time with greater ids, that come later, are read later."""
    at = tempfile.mkdtemp(prefix="spark-observed-")
    spark.createDataFrame([(5, 0, 0, 1.0), (3, 0, 0, 1.0), (None, 0, 0, 1.0)], SCHEMA).write.mode("append").parquet(f"{at}/bets")
    assert drained(spark, at, MINUTE) == {3, 5}
    spark.createDataFrame([(9, 0, 0, 1.0), (4, None, None, 1.0), (1, 10, 20 * MINUTE, 1.0)], SCHEMA).write.mode("append").parquet(f"{at}/bets")
    assert drained(spark, at, MINUTE, seen=True) == {9}
    assert drained(spark, at, 21 * MINUTE, seen=True) == {1}


def test_a_longer_delay_and_spans(spark):
    at = tempfile.mkdtemp(prefix="spark-observed-")
    spark.range(100).select(F.col("id").alias("bet_id"), (F.col("id") * MINUTE).alias("us"), F.lit(None).cast("long").alias("etl_us"), F.lit(1.0).alias("wager")).write.parquet(f"{at}/bets")
    assert drained(spark, at, 50 * MINUTE, delay=observed.SESSION_DELAY, partitions=5) == set(range(44))
    reader = observed.ObservedReader({"path": f"{at}/bets", "partitions": "5"}, observed.from_arrow_schema(observed._dataset(f"{at}/bets").schema))
    spans = reader.partitions(reader.initialOffset(), {"us": 99 * MINUTE, "id": 99})
    sizes = [sum(b.num_rows for b in reader.read(s)) for s in spans]
    assert len(spans) == 5 and sum(sizes) == 100 and min(sizes) > 10


def test_memory_of_a_read_doesnt_follow_the_row_group():
    """A row group of 40 MB of two columns, beside a wide one that isn't asked for: a few pages are held at a time, and nulls of a file without a column."""
    n = 2_500_000
    at = tempfile.mkdtemp(prefix="spark-observed-")
    ids = pa.array(range(n))
    pq.write_table(pa.table({"bet_id": ids, "us": pc.multiply(ids, 7), "wager": pc.cast(ids, pa.float64()), "wide": pc.cast(ids, pa.string())}), f"{at}/one.parquet", row_group_size=n)
    pq.write_table(pa.table({"bet_id": [n, n + 1], "us": [7 * n, None]}), f"{at}/two.parquet")
    del ids
    reader = observed.ObservedReader({"path": at, "observed": "us", "partitions": "2"}, observed.from_arrow_schema(pa.schema({"bet_id": pa.int64(), "wager": pa.float64()})))
    held, most, found, nulls = pa.total_allocated_bytes(), 0, 0, 0
    for span in reader.partitions(reader.initialOffset(), reader.latestOffset()):
        for batch in reader.read(span):
            assert batch.schema.names == ["bet_id", "wager"]
            most, found, nulls = max(most, pa.total_allocated_bytes() - held), found + batch.num_rows, nulls + batch["wager"].null_count
    assert (found, nulls) == (n + 1, 1) and most < 16_000_000, (found, nulls, most)
