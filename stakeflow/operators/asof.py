"""As-of joins: for each left row the newest right row of its key, by one shuffle and a running last value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, strict: bool = False, tie: str | None = None, bucket: int | None = None) -> DataFrame:
    """Adds the columns of ``right`` but its key, from its newest row at or before (``strict``: before) the left time.

    Ties among right rows go to the largest ``tie``, by its own order; nulls are least. Left rows without a match, key or
    time get nulls. Both sides are put in one sequence per key, right rows before equal left ones unless ``strict``, and
    the last right row is carried on.

    With ``bucket``, a span of time, each key's sequence is cut into buckets, so that no task gets a key's rows. Each
    bucket's last right row is found first, and carried through the key's buckets, a row each, to the start of the next
    ones that left rows need; so each bucket is a sequence of its own.
    """
    payload, by = [c for c in right.columns if c != key], tie or right_time
    none = lambda type_: F.lit(None).cast(type_)
    place = lambda t: F.floor(F.col(t) / bucket) if bucket else F.lit(0).cast("long")
    r = right.where(F.col(right_time).isNotNull()).select(F.col(key).alias("_key"), place(right_time).alias("_bucket"), F.col(right_time).alias("_t"), F.lit(1 if strict else 0).alias("_side"), F.col(by).alias("_tie"), F.struct(*payload).alias("_r"))
    l = left.select(F.col(key).alias("_key"), place(left_time).alias("_bucket"), F.col(left_time).alias("_t"), F.lit(0 if strict else 1).alias("_side"), none(r.schema["_tie"].dataType).alias("_tie"), F.struct(*left.columns).alias("_l"))
    both = l.unionByName(r, allowMissingColumns=True)
    if bucket:
        lasts = r.groupBy("_key", "_bucket").agg(F.max_by("_r", F.struct("_t", "_tie")).alias("_r")).withColumn("_needs", F.lit(False))
        needed = l.where("_key is not null and _t is not null").select("_key", "_bucket").distinct().withColumn("_needs", F.lit(True))
        so_far = Window.partitionBy("_key").orderBy("_bucket", F.desc("_needs")).rowsBetween(Window.unboundedPreceding, 0)
        started = lasts.unionByName(needed, allowMissingColumns=True).withColumn("_r", F.last("_r", ignorenulls=True).over(so_far)).where("_needs and _r is not null")
        both = both.unionByName(started.select("_key", "_bucket", F.lit(-1).alias("_side"), "_r"), allowMissingColumns=True)  # a null time is first
    w = Window.partitionBy("_key", "_bucket").orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_m", F.last("_r", ignorenulls=True).over(w)).where("_l is not null")
    fits = F.col("_key").isNotNull() & F.col("_t").isNotNull()
    return carried.select("_l.*", *[F.when(fits, F.col(f"_m.{c}")).alias(c) for c in payload])


#: A month in microseconds: players' links and snapshots are days apart or more.
MONTH = 30 * 86_400_000_000


def pit_identity(bets: DataFrame, links: DataFrame, bucket: int | None = MONTH) -> DataFrame:
    """Adds canonical_id by the newest link usable at the bet, else the player's id, and pit_rated."""
    df = asof_join(bets, links.select("player_id", "card", "link_us"), "player_id", "us", "link_us", tie="card", bucket=bucket)
    df = df.withColumn("pit_rated", F.col("card").isNotNull())
    return df.withColumn("canonical_id", F.coalesce("card", F.col("player_id").cast("string"))).drop("card", "link_us")
