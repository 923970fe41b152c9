"""Scans, partitioned and keyed sinks, exports and retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.operators.dedup import dedup_sessions, unflagged
from stakeflow.sources.materialise import materialised

MINUTE = 60_000_000
DAY = 1440 * MINUTE


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV (with a header) or Parquet, by the path's suffix."""
    return spark.read.csv(path, header=True, inferSchema=True) if path.rstrip("/").lower().endswith(".csv") else spark.read.parquet(path)


def union_by_name(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def scan_bets(bets: DataFrame, start_us: int, end_us: int, columns: list[str] | None = None, history: int = 2 * DAY) -> DataFrame:
    """Bets with a positive wager of valid players in ``[start - history, end)``; plain comparisons, which reach the scan."""
    df = bets.where((F.col("us") >= start_us - history) & (F.col("us") < end_us) & (F.col("wager") > 0) & F.col("player_id").isNotNull() & (F.col("player_id") != -1))
    return df.select(*columns) if columns else df


def scan_sessions(sessions: DataFrame, start_us: int, end_us: int, margin: int = DAY) -> DataFrame:
    df = sessions.where((F.col("start_us") >= start_us - margin) & (F.col("start_us") < end_us + margin))
    return unflagged(dedup_sessions(df), "is_manual", "is_deleted", "is_canceled").where("turnover > 0 or num_games_with_wager > 0")


def scan_profiles(profiles: DataFrame, start_us: int, end_us: int, ids: DataFrame | None = None, reach: int = 365 * DAY) -> DataFrame:
    df = profiles.where((F.col("snapshot_us") >= start_us - reach) & (F.col("snapshot_us") <= end_us))
    return df if ids is None else df.join(ids.select("canonical_id").distinct(), "canonical_id", "left_semi")


def scan_open_sessions(sessions: DataFrame, now_us: int, hours: int = 12) -> DataFrame:
    """Sessions that started within the last hours and have no end."""
    df = sessions.where((F.col("start_us") >= now_us - hours * 60 * MINUTE) & (F.col("start_us") <= now_us))
    return dedup_sessions(df).where("end_us is null")


def list_partitions(df: DataFrame, day: str = "gaming_day") -> DataFrame:
    return df.select(day).where(F.col(day).isNotNull()).distinct().orderBy(day)


def date_range(df: DataFrame, candidates: list[str]) -> DataFrame:
    """Least and largest of the first candidate column that is there."""
    c = next((c for c in candidates if c in df.columns), None)
    if c is None:
        raise ValueError(f"none of {candidates} is a column")
    return df.agg(F.min(c).alias("first"), F.max(c).alias("last"))


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and SHA-256 of each file of a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def snapshot_id(inventory: DataFrame) -> str:
    """A hash of the inventory's lines: in order within 4,096 parts by hash, then of the parts' hashes in order."""
    line = F.concat_ws(" ", "name", F.col("size").cast("string"), "sha256")
    of = lambda c: F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(c))), 256)
    parts = inventory.select(line.alias("line")).groupBy(F.pmod(F.xxhash64("line"), F.lit(4096)).alias("part")).agg(of("line").alias("h"))
    return parts.agg(of(F.concat_ws(" ", F.lpad(F.col("part").cast("string"), 4, "0"), "h"))).first()[0]


def head_tail(df: DataFrame, n: int, *order: str, head: bool = True, tail: bool = True) -> DataFrame:
    parts = [df.orderBy(*[F.asc(c) for c in order]).limit(n)] if head else []
    parts += [df.orderBy(*[F.desc(c) for c in order]).limit(n)] if tail else []
    return union_by_name(*parts).dropDuplicates()


def write_partitions(df: DataFrame, path: str, day: str = "gaming_day") -> DataFrame:
    """Writes a Parquet folder for each day, replacing those days only; returns rows and time range of each."""
    df.repartition(day).sortWithinPartitions(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    us = [F.min("us").alias("first_us"), F.max("us").alias("last_us")] if "us" in df.columns else []
    return df.groupBy(day).agg(F.count("*").alias("rows"), *us)


def replace_snapshots(current: DataFrame, incoming: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """Current rows of days that aren't incoming, and the incoming rows."""
    return current.join(F.broadcast(incoming.select(day).distinct()), day, "left_anti").unionByName(incoming, allowMissingColumns=True)


#: How a column of a keyed table takes a new value; rows carry their version in ``_version``.
RULES = {
    "sum": lambda c: F.sum(c),
    "max": lambda c: F.max(c),
    "min": lambda c: F.min(c),
    "first": lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_version"))),
    "replace": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_version"))),
}


def upsert(current: DataFrame, incoming: DataFrame, key: str, rules: dict[str, str]) -> DataFrame:
    """A new version of a keyed table: each column by its rule, sum, max, min, first or replace."""
    both = current.withColumn("_version", F.lit(0)).unionByName(incoming.withColumn("_version", F.lit(1)), allowMissingColumns=True)
    return both.groupBy(key).agg(*[RULES[r](c).alias(c) for c, r in rules.items()])


def export_batch(predictions: DataFrame, after_id: int, now_us: int, lag: int = 5 * MINUTE, most: int = 10_000) -> tuple[DataFrame, int]:
    """The next rows by id that are old enough, with date and hour, and the id to go on from."""
    rows = predictions.where((F.col("prediction_id") > after_id) & (F.col("us") <= now_us - lag)).orderBy("prediction_id").limit(most)
    ts = F.timestamp_micros("us")
    rows = materialised(rows.withColumns({"date": F.to_date(ts), "hour": F.hour(ts)}))
    last = rows.agg(F.max("prediction_id")).first()[0]
    return rows, after_id if last is None else last


def retained(df: DataFrame, cutoff_us: int, exported_id: int | None = None) -> DataFrame:
    """Rows to keep: those since the cutoff, and those not yet exported."""
    keep = F.col("us") >= cutoff_us
    return df.where(keep if exported_id is None else keep | (F.col("prediction_id") > exported_id))


def export_incremental(predictions: DataFrame, path: str, now_us: int, lag: int = 5 * MINUTE, most: int = 10_000) -> int:
    """Writes the next rows by id to ``path/date=/hour=/after=`` and the id to go on from to ``path/_watermark``; returns it.

    ``after`` is the id that a batch went on from, so that one that runs again, as its watermark wasn't written, replaces its
    own folders."""
    spark = predictions.sparkSession
    last = exported_until(spark, path)
    rows, upto = export_batch(predictions, last, now_us, lag, most)
    if upto != last:
        rows.withColumn("after", F.lit(last)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "hour", "after").parquet(path)
        spark.createDataFrame([(upto,)], "prediction_id long").coalesce(1).write.mode("append").parquet(f"{path}/_watermark")
    return upto


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exported_until(spark: SparkSession, path: str) -> int:
    """The id that the last export ended with, 0 before the first."""
    at, files = _path(spark, f"{path}/_watermark")
    return (spark.read.schema("prediction_id long").parquet(f"{path}/_watermark").agg(F.max("prediction_id")).first()[0] or 0) if files.exists(at) else 0


def drop_partitions(spark: SparkSession, path: str, cutoff: datetime, keep_from: datetime | None = None, day: str = "date", hour: str | None = "hour") -> list[str]:
    """Deletes the day folders before the cutoff's day, and of that day the hours before its hour, if there are any; nothing from
    ``keep_from`` on, such as what isn't exported yet. Returns the folders deleted."""
    at, files = _path(spark, path)
    limit = cutoff if keep_from is None else min(cutoff, keep_from)
    dropped = []
    folders = lambda p, name: sorted((s.getPath() for s in files.listStatus(p) if s.getPath().getName().startswith(f"{name}=")), key=lambda q: q.getName())
    for d in folders(at, day):
        value = d.getName().removeprefix(f"{day}=")
        if value < limit.date().isoformat():
            dropped.append(d)
        elif value == limit.date().isoformat() and hour:
            dropped += [h for h in folders(d, hour) if int(h.getName().removeprefix(f"{hour}=")) < limit.hour]
    for p in dropped:
        files.delete(p, True)
    return [p.toString().split(f"{path.rstrip('/')}/")[-1] for p in dropped]


def export_libsvm(df: DataFrame, path: str, label: str, features: list[str], weight: str | None = None, split: str | None = None, splits: tuple[str, ...] = ("train", "valid", "test")) -> None:
    """LibSVM files; with ``weight``, ``path.weight`` has a line a row, part by part in the same order. With ``split``, a column,
    each of ``splits`` is a folder ``path/name`` of its own; null features and weights are 0."""
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(df.fillna(0, [*features, *([weight] if weight else [])]))
    rows = rows.select(F.col(label).cast("double").alias("label"), "features", *([F.col(weight).cast("double").alias("_weight")] if weight else []), *([F.col(split).alias("_split")] if split else []))
    rows = materialised(rows) if weight or split else rows  # both files are of the same rows in the same order
    for name in splits if split else [None]:
        part, to = (rows, path) if name is None else (rows.where(F.col("_split") == name), f"{path}/{name}")
        part.select("label", "features").write.mode("overwrite").format("libsvm").save(to)
        if weight:
            part.select(F.col("_weight").cast("string")).write.mode("overwrite").text(f"{to}.weight")


def export_csv(df: DataFrame, path: str, split: str | None = None) -> None:
    """CSV with a header and all columns, weights among them; with ``split``, a folder ``split=name`` for each of its values."""
    w = df.write.mode("overwrite")
    (w.partitionBy(split) if split else w).csv(path, header=True)


def baseline_slice(df: DataFrame, columns: dict[str, str], lo_us: int, hi_us: int, most: int, label: str = "label") -> DataFrame:
    """The first rows in time of a window without nulls, renamed; both labels must be among them."""
    rows = df.where((F.col("us") >= lo_us) & (F.col("us") < hi_us)).dropna(subset=list(columns)).orderBy("us", "bet_id").limit(most).select(*[F.col(a).alias(b) for a, b in columns.items()])
    rows = materialised(rows)
    if rows.select(columns.get(label, label)).distinct().count() < 2:
        raise ValueError("the slice has one class only")
    return rows


def recent(df: DataFrame, since_us: int, limit: int | None = None) -> DataFrame:
    """Rows since a time, the last ``limit`` of them, in order."""
    rows = df.where(F.col("us") >= since_us)
    return rows.orderBy("us", "bet_id") if limit is None else rows.orderBy(F.desc("us"), F.desc("bet_id")).limit(limit).orderBy("us", "bet_id")


def to_local_naive(ts: Column, zone: str = "Asia/Hong_Kong", naive: bool = False) -> Column:
    """The wall time of an instant in a zone, without one; ``naive`` input is wall time already, and only loses its zone."""
    return ts.cast("timestamp_ntz") if naive else F.from_utc_timestamp(ts, zone)


def days_of_layout(spark: SparkSession, path: str, day: str = "gaming_day") -> DataFrame:
    """The days that a partitioned folder has files for: the partition column alone, no column of the files is read."""
    return spark.read.parquet(path).select(day).distinct()


def write_backtest(scored: DataFrame, path: str, threshold: float) -> None:
    """Predictions as Parquet, and the rated ones at or above the threshold as CSV of bet_id and score."""
    scored.write.mode("overwrite").parquet(f"{path}/predictions")
    export_csv(scored.where((F.col("score") >= threshold) & F.col("is_rated")).select("bet_id", "score"), f"{path}/alerts")


def scan_window(df: DataFrame, time: str, start: str, end: str, columns: list[str]) -> DataFrame:
    """The columns of rows in ``[start, end)``. The bounds are of the column's own type, and the column stands alone, so
    that both the bounds and the columns reach the files' row groups."""
    kind = df.schema[time].dataType
    return df.where((F.col(time) >= F.lit(start).cast(kind)) & (F.col(time) < F.lit(end).cast(kind))).select(*columns)
