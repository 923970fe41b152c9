"""Exports with their watermark, weights and splits, and retention that deletes."""

import glob
import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from stakeflow.sources import tables

HOUR = 3_600_000_000


def predictions(spark, n):
    return spark.range(1, n + 1).select(F.col("id").alias("prediction_id"), (F.col("id") * HOUR).alias("us"), (F.col("id") / 100).alias("score"))


def test_export_goes_on_from_its_watermark(spark):
    at = tempfile.mkdtemp(prefix="spark-export-")
    df = predictions(spark, 60)
    assert tables.exported_until(spark, at) == 0
    assert tables.export_incremental(df, at, 40 * HOUR, most=30) == 30
    assert tables.export_incremental(df, at, 40 * HOUR, most=30) == 39  # the last one isn't old enough
    assert tables.export_incremental(df, at, 40 * HOUR, most=30) == 39 and tables.exported_until(spark, at) == 39
    got = spark.read.parquet(at)
    assert sorted(r.prediction_id for r in got.collect()) == list(range(1, 40))
    assert {(str(r.date), r.hour) for r in got.collect()} == {(f"1970-01-0{1 + i // 24}", i % 24) for i in range(1, 40)}
    # a batch whose watermark was lost replaces its own folders
    rows, _ = tables.export_batch(df, 30, 40 * HOUR, most=30)
    rows.withColumn("after", F.lit(30)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "hour", "after").parquet(at)
    assert spark.read.parquet(at).count() == 39


def test_retention_deletes_old_folders(spark):
    at = tempfile.mkdtemp(prefix="spark-export-")
    tables.export_incremental(predictions(spark, 100), at, 200 * HOUR, most=1000)
    dropped = tables.drop_partitions(spark, at, datetime(1970, 1, 3, 5), keep_from=datetime(1970, 1, 2, 3))
    assert dropped == ["date=1970-01-01", *[f"date=1970-01-02/hour={h}" for h in range(3)]]
    assert min(r.us for r in spark.read.parquet(at).collect()) == 27 * HOUR and tables.exported_until(spark, at) == 100
    tables.drop_partitions(spark, at, datetime(1970, 1, 3, 5))
    assert min(r.us for r in spark.read.parquet(at).collect()) == 53 * HOUR
    assert tables.drop_partitions(spark, at, datetime(1970, 1, 3, 5)) == []


def test_exports_carry_weights_and_splits(spark):
    at = tempfile.mkdtemp(prefix="spark-export-")
    df = spark.createDataFrame([(i, i % 2, float(i), None if i == 3 else i / 4, "valid" if i % 5 == 0 else "train") for i in range(40)], "bet_id long, label int, x double, weight double, split string").repartition(3)
    tables.export_libsvm(df, f"{at}/svm", "label", ["x"], "weight", "split", ("train", "valid"))
    for name, n in (("train", 32), ("valid", 8)):
        said = lambda path: [line for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f).read().splitlines()]
        lines, weights = said(f"{at}/svm/{name}"), [float(x) for x in said(f"{at}/svm/{name}.weight")]
        assert len(lines) == len(weights) == n
        for line, w in zip(lines, weights):
            x = float(line.split(":")[1]) if ":" in line else 0.0
            assert w == (0.0 if x == 3 else x / 4) and (int(x) % 5 == 0) == (name == "valid")
    tables.export_csv(df, f"{at}/csv", "split")
    back = spark.read.csv(f"{at}/csv", header=True, inferSchema=True)
    assert sorted((r.bet_id, r.weight, r.split) for r in back.where("weight is not null").collect()) == sorted((r.bet_id, r.weight, r.split) for r in df.where("weight is not null").collect())


def test_wall_times_stay_as_they_are(spark):
    row = spark.sql("SELECT timestamp'2026-01-01 10:00:00' AS t").select(tables.to_local_naive(F.col("t")).cast("string").alias("a"), tables.to_local_naive(F.col("t"), naive=True).cast("string").alias("b")).first()
    assert row.a == "2026-01-01 18:00:00" and row.b == "2026-01-01 10:00:00"
