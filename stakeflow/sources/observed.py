"""A stream of a growing Parquet table by observed time: the cursor is (observed time, id), and not a list of files.

A row's observed time is the first of some columns that isn't null, as when it was inserted, else when it happened. Rows
become visible a while after that, bets a minute and sessions seven, so that what is still being written isn't missed.
Every batch reads what lies between two cursors, cut into spans of time, a task each; row groups outside are skipped by
their statistics. An old event that is inserted late is read then, once; a restart goes on from the cursor.

    spark.dataSource.register(Observed)
    spark.readStream.format("observed").option("path", ...).option("observed", "etl_us,us").option("id", "bet_id").load()
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

MINUTE = 60_000_000
#: How long bets and sessions stay invisible after they were observed.
BET_DELAY, SESSION_DELAY = MINUTE, 7 * MINUTE
#: Rows of a batch.
ROWS = 1 << 15
BEFORE_ALL = {"us": -(1 << 62), "id": -(1 << 62)}


def _dataset(path: str) -> ds.Dataset:
    if "://" in path or path.startswith("file:"):
        filesystem, path = pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
        return ds.dataset(path, format="parquet", filesystem=filesystem)
    return ds.dataset(path, format="parquet")


class Span(InputPartition):
    """Rows after one cursor, up to another."""

    def __init__(self, after: dict, upto: dict):
        self.after, self.upto = after, upto


class ObservedReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.id = options["path"], options.get("id", "bet_id")
        self.observed = options.get("observed", "etl_us,us").split(",")
        self.delay, self.parts = int(options.get("delay", BET_DELAY)), int(options.get("partitions", 8))
        self.now = int(options["now"]) if "now" in options else None
        self.names = [f.name for f in schema.fields]

    def _within(self, lo: int, hi: int) -> pc.Expression:
        """Rows observed from lo to hi, in terms that statistics of row groups can tell."""
        out = None
        for k, c in enumerate(self.observed):
            here = reduce(lambda x, y: x & y, [pc.field(p).is_null() for p in self.observed[:k]], (pc.field(c) >= lo) & (pc.field(c) <= hi))
            out = here if out is None else out | here
        return out

    def initialOffset(self) -> dict:
        return dict(BEFORE_ALL)

    def _batches(self, names: list[str], lo: int, hi: int) -> Iterator[pa.RecordBatch]:
        """``names`` of row groups that may have rows observed from lo to hi, a few pages of a row group at a time, so that
        memory doesn't follow files or row groups."""
        data = _dataset(self.path)
        types = [data.schema.field(n).type for n in names]
        for fragment in data.get_fragments():
            groups = [g.id for part in fragment.split_by_row_group(self._within(lo, hi), schema=data.schema) for g in part.row_groups]
            if not groups:
                continue
            with fragment.filesystem.open_input_file(fragment.path) as source:
                file = pq.ParquetFile(source, buffer_size=1 << 20, pre_buffer=False)
                there = [n for n in names if n in file.schema_arrow.names]
                for batch in file.iter_batches(ROWS, groups, there, use_threads=False):
                    columns = [batch[n].cast(t) if n in there else pa.nulls(batch.num_rows, t) for n, t in zip(names, types)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    def _at(self, batch: pa.RecordBatch) -> pa.Array:
        return pc.coalesce(*[batch[c] for c in self.observed])

    def latestOffset(self) -> dict:
        """The last visible row by (observed time, id); the beginning where there is none."""
        now = self.now if self.now is not None else time.time_ns() // 1000
        best = None
        for batch in self._batches([*dict.fromkeys([*self.observed, self.id])], BEFORE_ALL["us"], now - self.delay):
            at = self._at(batch)
            seen = pc.and_(pc.less_equal(at, now - self.delay), pc.is_valid(batch[self.id]))
            at, ids = at.filter(seen), batch[self.id].filter(seen)
            if len(at):
                us = pc.max(at)
                last = (us.as_py(), pc.max(ids.filter(pc.equal(at, us))).as_py())
                best = last if best is None else max(best, last)
        return dict(BEFORE_ALL) if best is None else {"us": best[0], "id": best[1]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        lo, hi = start["us"], end["us"]
        if (hi, end["id"]) <= (lo, start["id"]):
            return []
        low = lo if lo > BEFORE_ALL["us"] else self._first(hi)
        cuts = sorted({low + (hi - low) * k // self.parts for k in range(1, self.parts)} - {low, hi})
        # a cut is a cursor past every id of its time
        points = [start, *[{"us": c, "id": 1 << 62} for c in cuts], end]
        return [Span(a, b) for a, b in zip(points, points[1:])]

    def _first(self, hi: int) -> int:
        least = [pc.min(at.filter(pc.less_equal(at, hi))).as_py() for at in map(self._at, self._batches(self.observed, BEFORE_ALL["us"], hi))]
        return min((x for x in least if x is not None), default=hi)

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        (a, i), (b, j) = ((x["us"], x["id"]) for x in (partition.after, partition.upto))
        for batch in self._batches([*dict.fromkeys([*self.names, *self.observed, self.id])], a, b):
            at, key = self._at(batch), batch[self.id]
            after = pc.or_(pc.greater(at, a), pc.and_(pc.equal(at, a), pc.greater(key, i)))
            upto = pc.or_(pc.less(at, b), pc.and_(pc.equal(at, b), pc.less_equal(key, j)))
            found = batch.select(self.names).filter(pc.and_(pc.is_valid(key), pc.and_(after, upto)))
            if found.num_rows:
                yield found


class Observed(DataSource):
    """Options: path, observed (columns, the first that isn't null counts; longs of microseconds), id (a long), delay, now (for
    replays; else the clock), partitions. Rows without an id or an observed time are never visible. Of rows that share a
    cursor, copies, those that are there when it is passed are read, all of them."""

    @classmethod
    def name(cls) -> str:
        return "observed"

    def schema(self) -> StructType:
        return from_arrow_schema(_dataset(self.options["path"]).schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ObservedReader(dict(self.options), schema)


def observed_stream(spark: SparkSession, path: str, observed: str = "etl_us,us", key: str = "bet_id", delay: int = BET_DELAY, now_us: int | None = None, partitions: int = 8, schema: StructType | str | None = None) -> DataFrame:
    """``schema`` names the columns to read, else all are; the cursor's need not be among them."""
    spark.dataSource.register(Observed)
    r = spark.readStream.format("observed").option("path", path).option("observed", observed).option("id", key).option("delay", delay).option("partitions", partitions)
    r = r if schema is None else r.schema(schema)
    return (r if now_us is None else r.option("now", now_us)).load()
