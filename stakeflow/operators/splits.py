"""Splits in time, months, folds and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from stakeflow.operators.ranking import global_index

DAY = 86_400_000_000


def time_ordered_split(df: DataFrame, train: float = 0.70, valid: float = 0.15, order: tuple[str, ...] = ("us", "canonical_id", "bet_id")) -> DataFrame:
    """Adds split: the first share of rows in order is train, the next valid, the rest test; nulls last."""
    n = df.count()
    return _cut(df, order, {"train": 0, "valid": int(n * train), "test": int(n * (train + valid))})


def boundaries(df: DataFrame, order: tuple[str, ...], at: list[int]) -> dict[int, Row]:
    """The order's values in the rows of the given numbers, from 0, in order, nulls last. Only the order's columns are
    dealt, and only the rows asked for come to the driver."""
    keys = df.select(*order)
    rows = global_index(keys, *[F.asc_nulls_last(c) for c in order]).where(F.col("row_index").isin(at)).collect()
    return {r.row_index: r for r in rows}


def not_before(row: Row, order: tuple[str, ...]) -> Column:
    """Whether a row isn't before another in an order, nulls last."""
    out = F.lit(True)
    for c in reversed(order):
        if row[c] is None:
            out = F.col(c).isNull() & out
        else:
            out = F.col(c).isNull() | (F.col(c) > F.lit(row[c])) | (F.col(c) == F.lit(row[c])) & out
    return out


def _cut(df: DataFrame, order: tuple[str, ...], starts: dict[str, int]) -> DataFrame:
    """Adds split: the last name whose first row, by its number, isn't after the row. The order has no ties."""
    at = boundaries(df, order, [n for n in starts.values() if n])
    split = F.lit(None).cast("string")
    for name, n in sorted(starts.items(), key=lambda x: x[1]):
        if not n:
            split = F.lit(name)
        elif n in at:
            split = F.when(not_before(at[n], order), name).otherwise(split)
    return df.withColumn("split", split)


def split_summary(df: DataFrame) -> DataFrame:
    pos = F.sum("label").cast("long")
    return df.groupBy("split").agg(F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.count("*").alias("rows"), pos.alias("positives"), (F.count("*") - pos).alias("negatives"))


def monthly_windows(spark: SparkSession, start: str, end: str) -> DataFrame:
    """month, start, end and extended_end of the calendar months in ``[start, end)``, clipped; the last reaches a day on."""
    one = spark.range(1).select(F.to_timestamp(F.lit(start)).alias("lo"), F.to_timestamp(F.lit(end)).alias("hi"))
    months = one.select("lo", "hi", F.explode(F.sequence(F.date_trunc("month", "lo"), F.col("hi"), F.expr("INTERVAL 1 MONTH"))).alias("m")).where("m < hi")
    nxt = F.col("m") + F.expr("INTERVAL 1 MONTH")
    df = months.select(F.date_format("m", "yyyy-MM").alias("month"), F.greatest("m", "lo").alias("start"), F.least(nxt, "hi").alias("end"))
    return df.withColumn("extended_end", F.col("end") + F.expr("INTERVAL 1 DAY"))


def month_split(months: DataFrame, train: float = 0.70, valid: float = 0.15) -> DataFrame:
    """Adds split to months: the first of them train, then valid, then test, each one at least."""
    w = Window.orderBy("month")  # over months only
    n = F.count("*").over(Window.partitionBy())
    k = F.row_number().over(w)
    a = F.greatest(F.lit(1), F.least(F.floor(n * train), n - 2))
    b = a + F.greatest(F.lit(1), F.least(F.floor(n * valid), n - a - 1))
    return months.withColumn("split", F.when(k <= a, "train").when(k <= b, "valid").otherwise("test"))


def expanding_folds(df: DataFrame, period: str, holdout: int = 1, min_positives: int = 1) -> DataFrame:
    """fold, train_end, valid_period and counts: fold i validates on period i and trains on all before; the last
    ``holdout`` periods are left out, and folds of too few positives."""
    by = df.groupBy(period).agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("pos"))
    w = Window.orderBy(period)  # over periods only
    up = w.rowsBetween(Window.unboundedPreceding, -1)
    t = by.withColumns({"k": F.row_number().over(w), "all": F.count("*").over(Window.partitionBy()), "train_rows": F.sum("n").over(up), "train_end": F.lag(period).over(w)})
    t = t.where((F.col("k") > 1) & (F.col("k") <= F.col("all") - holdout) & (F.col("pos") >= min_positives))
    return t.select(F.row_number().over(w).alias("fold"), "train_end", F.col(period).alias("valid_period"), "train_rows", F.col("n").alias("valid_rows"), F.col("pos").alias("valid_positives"))


def purged_splits(df: DataFrame, n_splits: int = 4, purge: int = DAY, order: tuple[str, ...] = ("us", "bet_id")) -> DataFrame:
    """Rows of each fold and role: block k validates, and rows before it by more than ``purge`` train."""
    n = df.count()
    firsts = [-(-k * n // (n_splits + 1)) for k in range(n_splits + 1)]  # the first row of each block
    rows = boundaries(df, order, firsts[1:])
    block = F.lit(0)
    for k in range(1, n_splits + 1):
        block = F.when(not_before(rows[firsts[k]], order), k).otherwise(block) if firsts[k] in rows else block
    starts = F.array(*[F.struct(F.lit(k).alias("fold"), F.lit(rows[firsts[k]]["us"]).alias("valid_start")) for k in range(1, n_splits + 1) if firsts[k] in rows])
    each = df.withColumn("block", block).withColumn("s", F.explode(F.filter(starts, lambda s: F.col("block") <= s["fold"]))).select("*", "s.*").drop("s")
    role = F.when(F.col("block") == F.col("fold"), "valid").when(F.col("us") < F.col("valid_start") - purge, "train")
    return each.withColumn("role", role).where("role is not null").drop("block", "valid_start")


def hash_top_k(df: DataFrame, k: int, key: str = "bet_id") -> DataFrame:
    """The k rows of the smallest MD5 of the key."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(k)


def stratified_sample(df: DataFrame, bin_column: str, size: int, seed: int = 0, key: str = "bet_id") -> DataFrame:
    """``size`` rows of each bin, by the hash of seed and key."""
    w = Window.partitionBy(bin_column).orderBy(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256), key)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= size).drop("_k")


def month_ends(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The last days of months within two days, inclusive."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day"))
    return days.where(F.col("day") == F.last_day("day"))


def day_list(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day"))


def missing_snapshots(wanted: DataFrame, present: DataFrame) -> DataFrame:
    return wanted.join(present.select("day").distinct(), "day", "left_anti")


def missing_snapshots_by_id(present: DataFrame, key: str = "canonical_id") -> DataFrame:
    """The days from the first to the last of ``present`` (key, day) that each id lacks; rows without an id say nothing."""
    pairs = present.select(key, "day").where(F.col(key).isNotNull()).distinct()
    ends = present.agg(F.min("day").alias("_lo"), F.max("day").alias("_hi"))
    wanted = pairs.select(key).distinct().crossJoin(F.broadcast(ends)).select(key, F.explode(F.sequence("_lo", "_hi")).alias("day"))
    return wanted.join(pairs, [key, "day"], "left_anti")


def temporal_split(df: DataFrame, train: float, valid: float, order: tuple[str, ...] = ("us", "bet_id")) -> DataFrame:
    """Adds split: the first share in time is train, a share of the rest valid, what is left test. No part may be empty."""
    if not (0 < train < 1 and 0 < valid < 1):
        raise ValueError("shares lie between 0 and 1")
    n = df.count()
    a = max(1, int(n * train))
    b = a + max(1, int((n - a) * valid))
    if n < 8 or b >= n:
        raise ValueError(f"{n} rows are too few")
    return _cut(df, order, {"train": 0, "valid": a, "test": b})


def latest_month_end(day: Column) -> Column:
    """The last day of a month that is not after a day."""
    return F.when(day == F.last_day(day), day).otherwise(F.date_sub(F.trunc(day, "month"), 1))
