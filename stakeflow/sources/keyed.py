"""A keyed table in hash buckets, of which a batch rewrites only those that its keys are in.

``data/batch=n/bucket=b`` has the rows of a bucket as batch n left them, and ``manifest/batch=n`` names for each bucket the
batch that wrote it last, with the latest time seen. A batch is there once its manifest is; it starts from the manifest
before its own number, so that one that runs again writes the same again. Readers of the last two manifests find their
files; older ones that neither names are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stakeflow.sources.tables import upsert

DAY = 86_400_000_000
MANIFEST = "bucket int, written long, clock_us long"


class KeyedTable:
    """``key`` and columns by the ``rules`` of ``upsert``. With ``age``, rows whose ``time`` is that much before the latest time
    of any batch are gone: hidden at once, and dropped when their bucket is rewritten."""

    def __init__(self, spark: SparkSession, path: str, key: str, rules: dict[str, str], buckets: int = 64, time: str | None = None, age: int = DAY):
        self.spark, self.path, self.key, self.rules, self.buckets, self.time, self.age = spark, path, key, rules, buckets, time, age

    def _files(self, *parts: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _batches(self, below: int | None = None) -> list[int]:
        """Numbers of the batches whose manifest is written, in order."""
        at, files = self._files("manifest")
        if not files.exists(at):
            return []
        names = [s.getPath().getName() for s in files.listStatus(at)]
        done = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=") and files.exists(self._files("manifest", n, "_SUCCESS")[0])]
        return sorted(n for n in done if below is None or n < below)

    def _manifest(self, batch: int) -> dict[int, tuple[int, int | None]]:
        return {r.bucket: (r.written, r.clock_us) for r in self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/batch={batch}").collect()}  # a row a bucket

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _rows(self, manifest: dict[int, tuple[int, int | None]], schema: StructType, only: set[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/data/batch={n}/bucket={b}" for b, (n, _) in sorted(manifest.items()) if only is None or b in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _alive(self, rows: DataFrame, clock: int | None) -> DataFrame:
        return rows if self.time is None or clock is None else rows.where(F.col(self.time) >= clock - self.age)

    def read(self, schema: StructType) -> DataFrame:
        """The rows of the last batch."""
        done = self._batches()
        manifest = self._manifest(done[-1]) if done else {}
        clock = max((c for _, c in manifest.values() if c is not None), default=None)
        return self._alive(self._rows(manifest, schema), clock)

    def put(self, new: DataFrame, number: int) -> set[int]:
        """Takes a batch in; returns the buckets that it rewrote. Rows with a null key are keyed by null."""
        before = self._batches(number)
        manifest = self._manifest(before[-1]) if before else {}
        one = upsert(new.limit(0), new, self.key, self.rules)
        touched = {r.b: r.t for r in new.groupBy(self._bucket().alias("b")).agg((F.max(self.time) if self.time else F.lit(None)).cast("long").alias("t")).collect()}  # a row a bucket
        last = max((c for _, c in manifest.values() if c is not None), default=None)
        clock = max((c for c in (*touched.values(), last) if c is not None), default=None)
        if touched:  # what was gone already isn't added to
            rows = upsert(self._alive(self._rows(manifest, one.schema, set(touched)), last), one, self.key, self.rules)
            out = self._alive(rows, clock).withColumn("bucket", self._bucket())
            out.repartition(min(self.buckets, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/batch={number}")
            for b in touched:
                at, files = self._files("data", f"batch={number}", f"bucket={b}")
                if files.exists(at):
                    manifest[b] = (number, clock)
                else:
                    manifest.pop(b, None)  # nothing in it is alive
        rows = [(b, n, clock) for b, (n, _) in manifest.items()]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/batch={number}")
        self._clean(number)
        return set(touched)

    def _clean(self, number: int) -> None:
        """Deletes buckets and manifests that neither this batch nor the one before it needs."""
        done = self._batches(number + 1)
        kept = {(n, b) for m in done[-2:] for b, (n, _) in self._manifest(m).items()}
        for m in done[:-2]:
            at, files = self._files("manifest", f"batch={m}")
            files.delete(at, True)
        at, files = self._files("data")
        for batch in files.listStatus(at) if files.exists(at) else []:
            n = int(batch.getPath().getName().removeprefix("batch="))
            buckets = [s.getPath() for s in files.listStatus(batch.getPath()) if s.getPath().getName().startswith("bucket=")]
            dead = [p for p in buckets if (n, int(p.getName().removeprefix("bucket="))) not in kept]
            if n <= number:
                for p in dead if len(dead) < len(buckets) else [batch.getPath()]:
                    files.delete(p, True)

    def follow(self, rows: DataFrame, checkpoint: str) -> StreamingQuery:
        """Takes the batches of a stream in."""
        return rows.writeStream.foreachBatch(lambda new, number: self.put(new, number) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
