"""Data-quality audits, statistics, digests and comparisons of frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakeflow.functions.ids import clean_card_id
from stakeflow.operators.dedup import dedup_sessions
from stakeflow.operators.ranking import global_index, value_quantiles
from stakeflow.sources.materialise import materialised

SECOND, MINUTE = 1_000_000, 60_000_000
DAY = 1440 * MINUTE


def ingest_delay(df: DataFrame, event: str = "us", seen: str = "etl_us", late_sec: int = 3600, *by: str) -> DataFrame:
    """Exact quantiles, maximum, and late rows of the delay in seconds, of rows with both times."""
    d = df.where(F.col(event).isNotNull() & F.col(seen).isNotNull()).withColumn("_d", (F.col(seen) - F.col(event)) / SECOND)
    late = F.count_if(F.col("_d") > late_sec)
    out = d.groupBy(*by).agg(F.max("_d").alias("max_sec"), F.count("*").alias("rows"), late.alias("late"), (late / F.count("*")).alias("late_ratio"))
    q = value_quantiles(d, "_d", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, *by)
    both = q.join(out, [q[c].eqNullSafe(out[c]) for c in by]) if by else q.join(F.broadcast(out))
    return both.select(*[q[c] for c in by], "p50", "p95", "p99", "max_sec", "rows", "late", "late_ratio")


def delay_profile(df: DataFrame, *by: str, event: str = "us", seen: str = "etl_us") -> DataFrame:
    """Rows, nulls, rows seen in 1970, negative delays, the shares within a minute, seven minutes and over a day, and the
    delays' mean, deviation, bounds and quantiles; of rows with both times but for the first three."""
    d = (F.col(seen) - F.col(event)) / SECOND
    n = F.count("_d")
    x = df.withColumn("_d", d)
    share = lambda c: F.count_if(c) / F.nullif(n, F.lit(0))
    d = F.col("_d")
    year = F.count_if(F.year(F.timestamp_micros(F.col(seen))) == 1970)
    out = x.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(d.isNull()).alias("nulls"), year.alias("in_1970"), share(d < 0).alias("negative"), share(d <= 60).alias("in_1m"), share(d <= 420).alias("in_7m"), share(d > 86400).alias("over_1d"), F.avg("_d").alias("mean"), F.stddev_samp("_d").alias("sd"), F.min("_d").alias("least"), F.max("_d").alias("most"))
    q = value_quantiles(x, "_d", {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}, *by)
    on = [out[c].eqNullSafe(q[c]) for c in by] if by else F.lit(True)
    return out.join(q, on, "left").select(*[out[c] for c in out.columns], "p50", "p90", "p95", "p99")


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of the row's columns by name; nulls and empty strings differ."""
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n"))) for c in sorted(df.columns)]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def frame_digest(df: DataFrame) -> DataFrame:
    """Count, sum, exclusive or and sum of squares of row hashes: equal for equal rows in any order and partitioning."""
    h = F.conv(F.substring(row_digest(df), 1, 15), 16, 10).cast("long")
    return df.select(h.alias("h")).agg(F.count("*").alias("rows"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("sum"), F.coalesce(F.bit_xor("h"), F.lit(0)).cast("long").alias("xor"), F.sum(F.pmod("h", F.lit(1 << 30)).cast("decimal(38,0)") * F.pmod("h", F.lit(1 << 30)).cast("decimal(10,0)")).cast("decimal(38,0)").cast("string").alias("squares"))


#: Digests that one hash of the tree is over.
CHUNK = 4096


def ordered_fingerprint(df: DataFrame, order: list[str], columns: list[str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row: rows, and a hash of them in the order of ``order``, ascending with nulls last.

    Rows are hashed, numbered in one order over range partitions, and hashed again by chunks of ``chunk`` numbers, which
    are hashed by chunks in turn until one is left. A chunk is a span of row numbers, so that partitions don't matter, and
    no task has more than one chunk's digests of 64 characters. Rows of equal order go by their hash. Equal rows count each;
    an empty table has the hash of nothing. Columns are compared as text; nulls and empty strings differ."""
    here = df.select(columns or df.columns)
    rows = df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], row_digest(here).alias("d"))
    level = global_index(rows, *[F.col(f"_o{i}").asc_nulls_last() for i in range(len(order))], F.col("d"), name="i").select("i", "d")
    n = level.count()
    left = max(1, n)
    while True:
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "d"))), lambda x: x["d"]), "")
        left = -(-left // chunk)
        if left == 1:
            return level.agg(F.lit(n).cast("long").alias("rows"), F.sha2(joined, 256).alias("fingerprint"))  # a chunk of digests
        level = level.groupBy(F.floor(F.col("i") / chunk).alias("i")).agg(F.sha2(joined, 256).alias("d"))


def digest_until(df: DataFrame, until_us: int, time: str = "snapshot_us") -> DataFrame:
    """The digest of the rows up to a time."""
    return frame_digest(df.where(F.col(time) <= until_us))


def reproducible(build: Callable[[], DataFrame], partitions: tuple[int, ...] = (1, 7, 64)) -> DataFrame:
    """partitions, and the digest of what ``build`` gives when its shuffles have so many parts, and whether all agree."""
    spark = build().sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            out.append((n, *frame_digest(build()).first()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    same = len({x[1:] for x in out}) == 1
    return spark.createDataFrame([(*x, same) for x in out], "partitions int, rows long, sum string, xor long, squares string, same boolean")


def feature_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls, zeros, mean, population deviation, bounds and quantiles of each column: all moments in one wide aggregate,
    the quantiles from counts by value."""
    d = {c: F.col(c).cast("double") for c in columns}
    one = df.agg(F.count("*").alias("n"), *[F.struct(F.count_if(v.isNull()).alias("nulls"), F.count_if(v == 0).alias("zeros"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")).alias(f"_{c}") for c, v in d.items()])
    moments = one.select(F.col("n").alias("rows"), F.expr(f"stack({len(columns)}, {', '.join(f'{c!r}, `_{c}`' for c in columns)}) AS (feature_name, m)")).select("feature_name", "rows", "m.*")
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    long = df.select(F.expr(f"stack({len(columns)}, {stack}) AS (feature_name, v)"))
    names = {"p1": 0.01, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    q = value_quantiles(long, "v", names, "feature_name")
    return moments.join(F.broadcast(q), "feature_name", "left").select("feature_name", "rows", "nulls", "zeros", "mean", "std", "min", "max", *names)  # a row a column


def column_std(df: DataFrame, columns: list[str]) -> DataFrame:
    one = df.agg(*[F.coalesce(F.stddev_pop(c), F.lit(0.0)).alias(c) for c in columns])
    return one.select(F.expr(f"stack({len(columns)}, {', '.join(f'{c!r}, `{c}`' for c in columns)}) AS (feature_name, std)"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Absolute Pearson of all pairs a < b in one aggregation; 0 where undefined."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.agg(*[F.abs(F.coalesce(F.nanvl(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0)), F.lit(0.0))).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.expr(f"stack({len(pairs)}, {', '.join(f'{a!r}, {b!r}, c{i}' for i, (a, b) in enumerate(pairs))}) AS (a, b, r)"))


def prune_correlated(df: DataFrame, columns: list[str], most: float = 0.95) -> list[str]:
    """The columns, less those that correlate above ``most`` with one kept before; the matrix is small."""
    r = {frozenset((x.a, x.b)): x.r for x in correlations(df, columns).collect()}
    kept: list[str] = []
    for c in columns:
        if all(r[frozenset((c, k))] <= most for k in kept):
            kept.append(c)
    return kept


def mutual_information(df: DataFrame, columns: list[str], label: str = "label", bins: int = 10) -> DataFrame:
    """Of each column's bins (equal width) with the label, in nats."""
    bounds = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in columns])
    j = df.crossJoin(F.broadcast(bounds.select(*[F.col(c).alias(f"_b_{c}") for c in columns])))  # one row
    of = lambda c: F.least(F.lit(bins - 1), F.floor((F.col(c).cast("double") - F.col(f"_b_{c}.lo")) / F.nullif(F.col(f"_b_{c}.hi") - F.col(f"_b_{c}.lo"), F.lit(0.0)) * bins))
    long = j.select(label, F.explode(F.array(*[F.struct(F.lit(c).alias("feature_name"), of(c).alias("bin")) for c in columns])).alias("x")).select(label, "x.*")
    n = long.groupBy("feature_name", "bin", label).agg(F.count("*").alias("n"))
    w = lambda *k: F.sum("n").over(Window.partitionBy("feature_name", *k))
    n = n.withColumns({"_all": w(), "_bin": w("bin"), "_label": w(label)})
    return n.groupBy("feature_name").agg(F.sum(F.col("n") / F.col("_all") * F.log(F.col("n") * F.col("_all") / (F.col("_bin") * F.col("_label")))).alias("information"))


def screen_features(df: DataFrame, columns: list[str], label: str = "label", most: float = 0.95, k: int = 20) -> DataFrame:
    """The k columns of most information among those that vary and don't correlate with one kept before."""
    varied = [r.feature_name for r in column_std(df, columns).where("std > 0").collect()]
    kept = prune_correlated(df, [c for c in columns if c in varied], most) if varied else []
    return mutual_information(df, kept, label).orderBy(F.desc("information"), "feature_name").limit(k) if kept else df.sparkSession.createDataFrame([], "feature_name string, information double")


def version_counts(df: DataFrame, key: str) -> DataFrame:
    """How many keys have how many versions."""
    return df.groupBy(key).agg(F.count("*").alias("versions")).groupBy("versions").agg(F.count("*").alias("keys"))


def missing_ids(df: DataFrame, column: str, *by: str) -> DataFrame:
    """Rows whose id is null, empty, the text null, or present."""
    c = F.col(column)
    kind = F.when(c.isNull(), "null").when(F.trim(c) == "", "empty").when(F.lower(F.trim(c)) == "null", "text null").otherwise("present")
    return df.groupBy(*by, kind.alias("kind")).agg(F.count("*").alias("rows"))


def bounds_by(df: DataFrame, flag: str, *columns: str) -> DataFrame:
    return df.groupBy(flag).agg(F.count("*").alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def value_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """How many rows fail each check, and their share."""
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(c).alias(f"c{i}") for i, c in enumerate(checks.values())])
    return one.select("_n", F.expr(f"stack({len(checks)}, {', '.join(f'{k!r}, c{i}' for i, k in enumerate(checks))}) AS (check_name, failed)")).select("check_name", "failed", (F.col("failed") / F.nullif("_n", F.lit(0))).alias("share"))


def null_patterns(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*[F.col(c).isNull().alias(f"no_{c}") for c in columns]).agg(F.count("*").alias("rows"))


def cardinality(df: DataFrame, a: str, b: str) -> DataFrame:
    """How many values of a have how many of b, and the other way round."""
    def way(x: str, y: str) -> DataFrame:
        per = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x).agg(F.count_distinct(y).alias("n"))
        return per.groupBy("n").agg(F.count("*").alias("keys")).select(F.lit(f"{x} to {y}").alias("direction"), "n", "keys")

    return way(a, b).unionByName(way(b, a))


def status_overlap(df: DataFrame, key: str, first: Column, second: Column) -> DataFrame:
    """Distinct keys of either condition, and of both."""
    by = df.groupBy(key).agg(F.bool_or(first).alias("a"), F.bool_or(second).alias("b"))
    return by.agg(F.count_if("a").alias("first"), F.count_if("b").alias("second"), F.count_if(F.col("a") & F.col("b")).alias("both"))


def late_cards(sessions: DataFrame) -> DataFrame:
    """Sessions whose card was missing in their first version and there in a later one."""
    card = clean_card_id(F.col("casino_player_id"))
    by = sessions.groupBy("session_id").agg(F.count("*").alias("versions"), F.min_by(F.coalesce(card, F.lit("")), F.struct("lud_us", "etl_us")).alias("first"), F.max(card).alias("card"))
    return by.where("versions > 1 and first = '' and card is not null").select("session_id", "versions", "card")


def late_card_bets(bets: DataFrame, late: DataFrame, top: int = 20) -> tuple[DataFrame, DataFrame]:
    """Bets and wager of the sessions of ``late_cards``, in all, and the ``top`` sessions of most versions with theirs."""
    own = bets.join(late.select("session_id"), "session_id", "left_semi").groupBy("session_id").agg(F.count("*").alias("bets"), F.sum("wager").alias("wager"))
    each = late.join(own, "session_id", "left").fillna(0, ["bets", "wager"])
    return each.agg(F.count("*").alias("sessions"), F.sum("bets").alias("bets"), F.sum("wager").alias("wager")), each.orderBy(F.desc("versions"), F.desc("bets"), "session_id").limit(top)


def status_groups(df: DataFrame, key: str, status: str, value: str) -> DataFrame:
    """Of each status: rows, distinct keys, and the sum, mean and share of the value."""
    by = df.groupBy(status).agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
    whole = df.agg(F.sum(value).alias("_all"))
    return by.join(F.broadcast(whole)).withColumn("share", F.col("total") / F.nullif("_all", F.lit(0.0))).drop("_all")  # one row


def time_quality(sessions: DataFrame) -> DataFrame:
    """Missing starts and ends, negative durations, and quantiles of durations in minutes and of the lags in seconds from
    end to update and from update to load."""
    df = dedup_sessions(sessions)
    timed = {"duration": (F.col("end_us") - F.col("start_us")) / MINUTE, "lag": (F.col("lud_us") - F.col("end_us")) / SECOND, "load": (F.col("etl_us") - F.col("lud_us")) / SECOND}
    one = df.agg(F.count("*").alias("rows"), F.count_if(F.col("start_us").isNull()).alias("no_start"), F.count_if(F.col("end_us").isNull()).alias("no_end"), F.count_if(F.col("end_us") < F.col("start_us")).alias("negative"))
    long = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("name"), v.alias("v")) for k, v in timed.items()])).alias("x")).select("x.*")
    q = value_quantiles(long, "v", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, "name")
    for k in timed:
        one = one.join(F.broadcast(q.where(F.col("name") == k).select(*[F.col(p).alias(f"{p}_{k}") for p in ("p50", "p90", "p99")])), how="left")  # one row
    return one


def frame_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of common keys whose values differ, null-safe, for each common column."""
    common = [c for c in a.columns if c in b.columns and c != key]
    j = a.select(key, *[F.col(c).alias(f"_a_{c}") for c in common]).join(b.select(key, *[F.col(c).alias(f"_b_{c}") for c in common]), key)
    one = j.agg(F.count("*").alias("rows"), *[F.count_if(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))).alias(f"c{i}") for i, c in enumerate(common)])
    return one.select("rows", F.expr(f"stack({len(common)}, {', '.join(f'{c!r}, c{i}' for i, c in enumerate(common))}) AS (column_name, differ)"))


def stats_compare(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Differences of two frames' feature_stats, largest mean difference first."""
    left, right = (feature_stats(x, columns).select("feature_name", *[F.col(c).alias(f"{s}_{c}") for c in ("rows", "nulls", "mean", "p50", "p95")]) for x, s in ((a, "a"), (b, "b")))
    j = left.join(right, "feature_name", "full")
    j = j.select("feature_name", *[(F.col(f"b_{c}") - F.col(f"a_{c}")).alias(f"{c}_diff") for c in ("mean", "p50", "p95")], (F.col("b_nulls") / F.col("b_rows") - F.col("a_nulls") / F.col("a_rows")).alias("null_rate_diff"))
    return j.orderBy(F.desc(F.abs("mean_diff")), "feature_name")


def alert_diff(a: DataFrame, b: DataFrame, key: str = "bet_id", score: str = "score", tolerance: float = 1e-6) -> DataFrame:
    """Counts, keys of one side only, the largest score difference and rows over the tolerance."""
    j = a.select(key, F.col(score).alias("_a"), F.lit(1).alias("_in_a")).join(b.select(key, F.col(score).alias("_b"), F.lit(1).alias("_in_b")), key, "full")
    off = F.abs(F.col("_a") - F.col("_b"))
    return j.agg(F.count("_in_a").alias("left_rows"), F.count("_in_b").alias("right_rows"), F.count_if(F.col("_in_b").isNull()).alias("only_left"), F.count_if(F.col("_in_a").isNull()).alias("only_right"), F.max(off).alias("max_diff"), F.count_if(off > tolerance).alias("over_tolerance"))


def schema_diff(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    x, y = set(a.columns), set(b.columns)
    return {"only_left": sorted(x - y), "only_right": sorted(y - x), "common": sorted(x & y)}


def drift(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """Population stability index and Kolmogorov-Smirnov distance of binned columns; bins are the reference's width."""
    bounds = reference.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(f"_b_{c}") for c in columns])

    def binned(df: DataFrame, side: str) -> DataFrame:
        j = df.select(*columns).crossJoin(F.broadcast(bounds))  # one row
        at = lambda c: F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col(c) - F.col(f"_b_{c}.lo")) / F.nullif(F.col(f"_b_{c}.hi") - F.col(f"_b_{c}.lo"), F.lit(0.0)) * bins)))
        long = j.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature_name"), at(c).alias("bin")) for c in columns])).alias("x")).select("x.*").where("bin is not null")
        return long.groupBy("feature_name", "bin").agg(F.count("*").alias(side))

    grid = reference.sparkSession.range(bins).select(F.col("id").alias("bin"), F.explode(F.array(*map(F.lit, columns))).alias("feature_name"))
    n = reduce(lambda d, s: d.join(s, ["feature_name", "bin"], "left"), (binned(reference, "r"), binned(current, "c")), grid).fillna(0)
    w = Window.partitionBy("feature_name")
    up = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    share = lambda c: F.coalesce(F.col(c) / F.nullif(F.sum(c).over(w), F.lit(0)), F.lit(0.0))
    upto = lambda c: F.coalesce(F.sum(c).over(up) / F.nullif(F.sum(c).over(w), F.lit(0)), F.lit(0.0))
    n = n.withColumns({"pr": F.greatest(share("r"), F.lit(1e-6)), "pc": F.greatest(share("c"), F.lit(1e-6)), "ks": F.abs(upto("r") - upto("c"))})
    return n.groupBy("feature_name").agg(F.sum((F.col("pc") - F.col("pr")) * F.log(F.col("pc") / F.col("pr"))).alias("psi"), F.max("ks").alias("ks"))


#: Of trees: equal-frequency bins of a column, trees, their depth, the step of each, the weight that a split's sides start with.
BINS, TREES, DEPTH, RATE, RIDGE = 16, 10, 3, 0.3, 1.0
#: Gradients are summed as integers of this many parts, so that sums don't depend on their order.
PARTS = 1 << 20


def _bin_edges(df: DataFrame, columns: list[str], bins: int) -> list[list[float]]:
    """Of each column the values between equal shares of its rows, exact, from counts by value."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature_name"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("value")) for c in columns])).alias("x")).select("x.*")
    found = {r.feature_name: sorted({v for k, v in r.asDict().items() if k != "feature_name"}) for r in value_quantiles(long, "value", {f"q{i}": i / bins for i in range(1, bins)}, "feature_name").collect()}
    return [found.get(c, []) for c in columns]


def _leaf(tree: dict[int, tuple[int, int]], x: np.ndarray) -> np.ndarray:
    """The node of each row of bins: a split's sides are 2n + 1 and 2n + 2, the left one up to its bin."""
    node = np.zeros(len(x), np.int64)
    for n in sorted(tree):
        feature, bin_ = tree[n]
        here = node == n
        node[here] = 2 * n + 1 + (x[here, feature] > bin_)
    return node


def tree_gains(df: DataFrame, columns: list[str], label: str = "label", bins: int = BINS, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> DataFrame:
    """feature_name and gain: what each column's splits take off the loss of boosted trees for a 0/1 label, in all.

    Columns are cut into equal-frequency bins once; nulls are 0. Rows of equal bins and labels are one row with their count,
    as they have equal gradients. A level of a tree is one pass over these: each task adds gradients and curvatures up by
    node, column and bin, all columns at a time, and Spark adds these tables, which have nodes times columns times bins rows
    whatever the input. Sums are of integers, so that any partitioning gives the same trees; equal gains go to the earlier
    column and the lower bin. Rows without a 0/1 label don't count.
    """
    known = df.where(F.col(label).isin(0, 1))
    edges = _bin_edges(known, columns, bins)
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    places = [reduce(Column.__add__, [(value(c) > e).cast("int") for e in found], F.lit(0)).alias(f"x{j}") for j, (c, found) in enumerate(zip(columns, edges))]
    rows = materialised(known.select(*places, F.col(label).cast("int").alias("y")).groupBy(*[f"x{j}" for j in range(len(columns))], "y").agg(F.count("*").alias("rows")))
    grown: list[tuple[dict, dict]] = []
    gains = dict.fromkeys(columns, 0.0)
    width = max((len(e) for e in edges), default=0) + 1

    def sums(tree: dict[int, tuple[int, int]]) -> dict[int, np.ndarray]:
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                if not len(part):
                    continue
                x, rows = part.iloc[:, : len(columns)].to_numpy(np.int64), part["rows"].to_numpy()
                margin = np.zeros(len(x))
                for t, leaves in grown:
                    margin += np.array([leaves.get(n, 0.0) for n in range(2 ** (depth + 1))])[_leaf(t, x)]
                p = 1 / (1 + np.exp(-margin))
                g, h = (rows * np.round(c * PARTS).astype(np.int64) for c in (p - part["y"].to_numpy(), p * (1 - p)))
                node = _leaf(tree, x)
                for n in np.unique(node):
                    here = node == n
                    for j in range(x.shape[1]):
                        a, b = np.zeros(width, np.int64), np.zeros(width, np.int64)
                        np.add.at(a, x[here, j], g[here])
                        np.add.at(b, x[here, j], h[here])
                        yield pd.DataFrame({"node": n, "feature": j, "bin": np.arange(width), "g": a, "h": b})

        total = rows.mapInPandas(run, "node long, feature int, bin int, g long, h long").groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        out: dict[int, np.ndarray] = {}
        for r in total.collect():  # nodes times columns times bins
            out.setdefault(r.node, np.zeros((2, len(columns), width)))[:, r.feature, r.bin] = r.g / PARTS, r.h / PARTS
        return out

    for _ in range(trees):
        tree: dict[int, tuple[int, int]] = {}
        ends: dict[int, tuple[float, float]] = {}  # sums of the nodes that may be leaves
        for level in range(depth):
            for n, (g, h) in sorted(sums(tree).items()):
                if n < 2**level - 1:  # a leaf of a level before
                    continue
                left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
                all_g, all_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
                ends[n] = (float(all_g[0, 0]), float(all_h[0, 0]))
                gain = left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g**2 / (all_h + RIDGE)
                if not gain.size or (best := float(np.max(gain))) <= 1e-9:
                    continue
                feature, bin_ = np.unravel_index(int(np.argmax(gain)), gain.shape)
                tree[n] = (int(feature), int(bin_))
                a, b = float(left_g[feature, bin_]), float(left_h[feature, bin_])
                ends[2 * n + 1], ends[2 * n + 2] = (a, b), (ends[n][0] - a, ends[n][1] - b)
                gains[columns[feature]] += best
        grown.append((tree, {n: -rate * g / (h + RIDGE) for n, (g, h) in ends.items()}))
    return df.sparkSession.createDataFrame(list(gains.items()), "feature_name string, gain double")


def screened(df: DataFrame, columns: list[str], label: str = "label", method: str = "trees", most: float = 0.95, k: int | None = 20, **kw) -> DataFrame:
    """feature_name, rank and score of the k best columns that vary, by one of three methods.

    ``trees``: those that don't correlate above ``most`` with one named before, by gain. ``information``: by mutual
    information, less those that correlate with one of more. ``information_then_trees``: what the second keeps, by gain.
    Equal scores go by name.
    """
    if method not in ("trees", "information", "information_then_trees"):
        raise ValueError(f"unknown method {method!r}")
    if k is not None and k < 1:
        raise ValueError("k must be positive")
    varied = {r.feature_name for r in column_std(df, columns).where("std > 0").collect()}  # a row a column
    kept = [c for c in columns if c in varied]
    scores: dict[str, float] = {}
    if method != "trees" and kept:
        scores = {r.feature_name: r.information for r in mutual_information(df, kept, label).collect()}
        kept = sorted(kept, key=lambda c: (-scores[c], c))
    kept = prune_correlated(df, kept, most) if len(kept) > 1 else kept
    if method != "information" and kept:
        scores = {r.feature_name: r.gain for r in tree_gains(df, kept, label, **kw).collect()}
        kept = sorted(kept, key=lambda c: (-scores[c], c))
    return df.sparkSession.createDataFrame([(c, i, float(scores[c])) for i, c in enumerate(kept[:k], 1)], "feature_name string, rank int, score double")
