"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

#: Words of a text: runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of the rows that Python takes in at once; one row may be longer.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8; none for null. Bytes are split at the six characters of WORD only."""
    return text.encode("utf-8", "replace").split() if text else []


def released() -> None:
    """Gives memory that Arrow and the allocator hold free back to the system: workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, rows: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``rows`` rows and about ``most`` bytes."""
    step = max(1, min(rows, batch.num_rows * most // max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        if part.num_rows > 1 and part.nbytes > 2 * most:  # long rows that stand together
            yield from slices(part, part.num_rows // 2, most)
        else:
            yield part


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: pa.Schema, rows: int = 1000) -> DataFrame:
    """``mapInArrow`` over slices bounded in rows and bytes: ``fn`` takes and returns columns as Python lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows):
                out = fn(part.to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)
        released()

    return df.mapInArrow(run, from_arrow_schema(schema))


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Where that is unset, a single machine, as in tests, gets a temporary folder;
    on a cluster that is an error, as executors and driver share no such folder."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            import tempfile

            where = tempfile.mkdtemp(prefix="spark-checkpoint-")
        sc.setCheckpointDir(where)
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there, so that its lineage ends."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As ``checkpointed``, as a Parquet table, which is a fraction of a checkpoint's size."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for t in tables:
        spark, folder = t.sparkSession, shared_folder(t.sparkSession)
        files = t.inputFiles()
        if files:
            path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            if path.getName().startswith("table-") and spark._jvm.org.apache.hadoop.fs.Path(folder).getName() == path.getParent().getName():
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Sides of joins are broadcast up to so many bytes.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` written down, and marked for broadcast if its rows, counted, are below ``most`` bytes; else to be shuffled."""
    df = written(df)
    return F.broadcast(df) if df.count() * row_bytes <= most else df


#: Rows from which frequent keys are found; one of so many rows that have a key makes it frequent, and so many at least.
SAMPLE_ROWS, HOT_SHARE, HOT_ROWS = 1_000_000, 2000, 64


def frequent(rows: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the keys that about one in two thousand rows of a table has, or more.

    They are found in a part of the rows, and there are at most 2,000 of them, whose hashes are all that the driver gets.
    Which keys are found changes only how a plan deals its rows, not its result.
    """
    n = rows.count()
    part = rows if n <= SAMPLE_ROWS else rows.sample(SAMPLE_ROWS / n, seed=1)
    found = part.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count("*").alias("n")).where(F.col("n") >= max(HOT_ROWS, min(n, SAMPLE_ROWS) / HOT_SHARE)).select("h").collect()
    return [r.h for r in found]


def with_group(rows: DataFrame, keys: list[str], measures: dict[str, Column], keep: Column) -> DataFrame:
    """Adds aggregates of each row's key to the rows of a table, and keeps those that ``keep`` holds for. Keys aren't null.

    Rows are dealt by key once, and aggregated there by a window. Those of frequent keys are dealt further by a hash of
    the row; their keys' aggregates are summed up in parts before, and broadcast, for at most 2,000 keys.
    """
    if not (found := frequent(rows, keys)):
        here = Window.partitionBy(*keys)
        return rows.withColumns({k: c.over(here) for k, c in measures.items()}).where(keep)
    hot = F.xxhash64(*keys).isin(found)
    sums = written(rows.where(hot).groupBy(*keys).agg(*[c.alias(f"__{k}") for k, c in measures.items()]))
    spread = F.when(hot, F.pmod(F.xxhash64(*rows.columns), F.lit(4096))).otherwise(0)
    marked = rows.join(F.broadcast(sums), keys, "left").withColumn("__spread", spread)
    here = Window.partitionBy(*keys, "__spread")
    out = marked.withColumns({k: F.coalesce(F.col(f"__{k}"), c.over(here)) for k, c in measures.items()})
    return out.where(keep).select(*rows.columns, *measures)


def with_side(rows: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows``, a table, joined to ``side``, which has a row a key at most: the sides of frequent keys, at most 2,000, are
    broadcast, so that no task gets all rows of such a key."""
    if not (found := frequent(rows, keys)):
        return rows.join(side, keys, how)
    hot = F.xxhash64(*keys).isin(found)
    return rows.where(~hot).join(side, keys, how).unionByName(rows.where(hot).join(F.broadcast(side.where(hot)), keys, how))


#: Texts of more characters teach nothing, so that a sample of rows is bounded in bytes too.
FIT_CHARS = 100_000


def sampled_ids(rows: DataFrame, group: str, k: int, key: str = "doc_id") -> dict[int, list]:
    """For each group, of which there are few, at most ``k`` keys of the smallest hashes, and how many rows it has, first.

    Groups are counted, and only rows below a hash that about one and a half times ``k`` of them are below come to the
    driver, which ranks them. Null groups and keys aren't taken.
    """
    rows = rows.where(F.col(group).isNotNull() & F.col(key).isNotNull()).select(F.col(group).alias("g"), F.col(key).alias("k"))
    sizes = {r.g: r.n for r in rows.groupBy("g").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    u = F.pmod(F.xxhash64("k"), F.lit(1 << 40))
    below = F.coalesce(*[F.when(F.col("g") == g, F.lit(min(1 << 40, ((3 * k) // 2 + 200) * (1 << 40) // n))) for g, n in sizes.items()])
    found: dict = {g: [] for g in sizes}
    for r in rows.where(u < below).select("g", "k", u.alias("u")).distinct().collect():
        found[r.g].append((r.u, r.k))
    return {g: [sizes[g], *[x for _, x in sorted(rs)[:k]]] for g, rs in found.items()}
