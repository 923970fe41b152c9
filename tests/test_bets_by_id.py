"""Bets by id: parts that grow with the table, and the same row among ties."""

import pytest
from pyspark.sql import functions as F

from stakeflow.operators import live
from stakeflow.operators.dedup import newest, only_ids


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_no_task_gets_more_rows_as_the_table_grows(spark, monkeypatch, broadcast):
    monkeypatch.setattr(live, "TASK_ROWS", 100, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        for n in (1000, 4000):
            bets = spark.range(n).select(F.col("id").alias("bet_id"), F.col("id").alias("us"), F.lit(7).cast("long").alias("player_id"), F.lit("x").alias("rest"))
            got = live.bets_by_id(bets, bets.where("bet_id % 2 = 0"))
            sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == n / 2 and max(sizes) <= 120, (n, sizes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ties_are_told_by_all_columns(spark):
    rows = [(w, i, us, p) for i in range(40) for us, p in ((5, -1), (5, 3), (None, 9), (5, None)) for w in (1.0, 2.0)]
    bets = spark.createDataFrame([*rows, (1.0, None, 5, 3)], "wager double, bet_id long, us long, player_id long")
    ids = spark.createDataFrame([(3,), (3,), (None,), (8,), (99,)], "bet_id long")
    want = newest(only_ids(bets, ids, "bet_id"), "bet_id", F.desc_nulls_last("us")).selectExpr("bet_id", "us", "nullif(player_id, -1)")
    assert sorted(map(str, live.bets_by_id(bets, ids).collect())) == sorted(str(r).replace("nullif(player_id, -1)", "player_id") for r in want.collect())
    assert live.bets_by_id(bets.limit(0), ids).count() == 0
