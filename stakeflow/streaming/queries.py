"""The operators over streams: dedup, totals, runs, windows, scoring by micro-batch, and late verdicts.

Batch functions are shared: what a stream scores in ``foreachBatch`` is what a batch computes over the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stakeflow.operators import serving
from stakeflow.sources.materialise import shared_folder
from stakeflow.sources.tables import upsert

HOUR = 3_600_000_000
#: A pause of 30 minutes splits a run; a session window of 30 minutes would join events that far apart.
RUN_GAP = "29 minutes 59.999999 seconds"


def stream_table(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream; the checkpoint's offsets are the cursor."""
    r = spark.readStream.schema(schema)
    return (r if files_per_batch is None else r.option("maxFilesPerTrigger", files_per_batch)).parquet(path)


def dedup_stream(bets: DataFrame, delay: str = "1 minute", ts: str = "ts", key: str = "bet_id") -> DataFrame:
    return bets.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def session_totals_stream(bets: DataFrame, delay: str = "7 minutes", ts: str = "ts") -> DataFrame:
    """Totals by session and day, of which state older than the watermark goes."""
    return bets.withWatermark(ts, delay).groupBy(F.window(ts, "24 hours"), "session_id").agg(F.count("*").alias("bets"), F.sum("wager").alias("wager"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def runs_stream(bets: DataFrame, gap: str = RUN_GAP, delay: str = "1 minute", ts: str = "ts") -> DataFrame:
    """A row for each run that a pause has closed."""
    runs = bets.withWatermark(ts, delay).groupBy("player_id", F.session_window(ts, gap)).agg(F.count("*").alias("bet_count"), F.sum("wager").alias("wager"), F.min(ts).alias("run_start"), F.max(ts).alias("run_end"))
    return runs.drop("session_window")


def kpi_stream(predictions: DataFrame, size: str = "60 minutes", slide: str = "15 minutes", delay: str = "5 minutes", ts: str = "ts") -> DataFrame:
    w = F.window(ts, size, slide)
    return predictions.withWatermark(ts, delay).groupBy(w).agg(F.count("*").alias("rows"), F.avg("score").alias("mean_score"), F.count_if("is_alert").alias("alerts")).select(F.col("window.start").alias("start"), "rows", "mean_score", "alerts")


def score_batches(bets: DataFrame, score: Callable[[DataFrame], DataFrame], history: Callable[[], DataFrame], mapping: Callable[[], DataFrame], threshold: Callable[[], float], floor_us: Callable[[], int], out: str, checkpoint: str, lookback: int = 8 * HOUR) -> StreamingQuery:
    """Scores each micro-batch with the history of the players it touches, ``lookback`` before its first bet, and appends
    alerts not sent before.

    ``history``, ``mapping``, ``threshold`` and ``floor_us`` are read again for each batch; ``score`` gets the bets of
    touched players and returns score and is_rated for each.
    """

    def batch(new: DataFrame, number: int) -> None:
        spark = new.sparkSession
        first = new.agg(F.min("us")).first()[0]
        past = history().where(F.col("us") >= (first or 0) - lookback)
        rows = serving.touched_history(past.unionByName(new.select(past.columns)).dropDuplicates(["bet_id"]), new, mapping())
        scored = score(rows).join(new.select("bet_id"), "bet_id", "left_semi")
        sent = _read(spark, out, "bet_id long")
        serving.new_alerts(scored, sent.where(F.col("batch") < number) if "batch" in sent.columns else sent, threshold(), floor_us()).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")  # a batch that runs again replaces its own folder

    return bets.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _read(spark: SparkSession, path: str, empty: str | StructType) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], empty)
        raise


def upsert_stream(rows: DataFrame, path: str, key: str, rules: dict[str, str], checkpoint: str) -> StreamingQuery:
    """Keeps a keyed table: every batch writes the version after the last one's, so that one that runs again writes the
    same version again."""

    def batch(new: DataFrame, number: int) -> None:
        one = upsert(new.limit(0), new, key, rules)
        spark = new.sparkSession
        old = _read(spark, f"{path}/version={number - 1}", one.schema) if number else one.limit(0)
        upsert(old, one, key, rules).write.mode("overwrite").parquet(f"{path}/version={number}")
        if number > 1:  # the last two versions stay, for a batch that runs again and for readers
            gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={number - 2}")
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def corrections(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """What late rows changed between two versions of facts: added, removed and changed keys, with both rows."""
    b, a = (df.select(key, F.struct(*columns).alias(n)) for df, n in ((before, "before"), (after, "after")))
    j = b.join(a, key, "full").where(~F.col("before").eqNullSafe(F.col("after")))
    return j.withColumn("reason", F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed"))


def stored(df: DataFrame, mode: str = "append") -> DataFrame:
    """All that a stream gives over the files that are there, as Parquet in the shared folder, with its checkpoint beside
    it: no row goes through the driver. A complete result takes the place of the batch's before it."""
    at = f"{shared_folder(df.sparkSession)}/stream-{uuid.uuid4().hex}"
    out = f"{at}/rows"
    w = df.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        q = w.format("parquet").start(out)
    else:
        df.sparkSession.createDataFrame([], df.schema).write.parquet(out)  # where no batch comes
        q = w.foreachBatch(lambda new, _: new.write.mode("overwrite").parquet(out)).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)
