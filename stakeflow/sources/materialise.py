"""Writing down a frame so that what follows reads the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's folder in ``spark.checkpoint.dir``; where that is unset, a single machine, as in tests,
    gets a temporary one, and a cluster an error."""
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


def materialised(df: DataFrame) -> DataFrame:
    """``df`` checkpointed to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As ``materialised``, as a Parquet table, of which what follows reads only the columns that it needs."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
