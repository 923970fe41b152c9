"""Ranking metrics: curves, thresholds, precision at recall, by day and by segment.

A curve has a point for each distinct score. Counts are aggregated by score first, so that what is put in a global
order is one row a score and not one a bet; and the order's running sums come by ``prefix_sums``, without one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakeflow.sources.materialise import materialised

#: Recalls at which precision is reported, and F-beta's beta.
RECALLS, BETA = (0.001, 0.01, 0.1, 0.5), 0.5


def prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds running sums over all rows in a global order, by name.

    Rows are range-partitioned, into as many parts as the session shuffles into or fewer, and written down with their
    part, as ranges come from a sample; the totals of parts, one row each, are summed up and joined back.
    """
    ranged = materialised(df.withColumns({f"_v_{k}": c for k, c in sums.items()}).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    totals = ranged.groupBy("_part").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(offsets), "_part")
    out = out.withColumns({k: F.sum(f"_v_{k}").over(inside) + F.col(f"_o_{k}") for k in sums})
    return out.drop("_part", *[f"_{p}_{k}" for p in "vo" for k in sums])


def value_quantiles(df: DataFrame, column: str, quantiles: dict[str, float], *by: str) -> DataFrame:
    """Exact interpolated quantiles of each group, by name; nulls and NaN don't count, and groups of nothing else go.

    Values are counted first, and put in one order with their group, so that no task holds a group's values."""
    v = F.col(column).cast("double")
    counts = df.where(F.col(column).isNotNull() & ~F.isnan(v)).groupBy(*by, v.alias("_v")).agg(F.count("*").alias("_n"))
    run = prefix_sums(counts, [*[F.col(c).asc_nulls_first() for c in by], F.col("_v").asc()], {"_upto": F.col("_n")})
    whole = run.groupBy(*by).agg(F.min(F.col("_upto") - F.col("_n")).alias("_before"), F.sum("_n").alias("_all"))
    if by:
        same = [run[c].eqNullSafe(whole[f"_g_{c}"]) for c in by] if (whole := whole.withColumnsRenamed({c: f"_g_{c}" for c in by})) else []
        at = run.join(whole, same).drop(*[f"_g_{c}" for c in by])
    else:
        at = run.join(F.broadcast(whole))  # one row
    first, last = F.col("_upto") - F.col("_n") - F.col("_before"), F.col("_upto") - F.col("_before")
    out = []
    for name, p in quantiles.items():
        place = F.lit(p) * (F.col("_all") - 1)
        lo, hi = F.floor(place), F.ceil(place)
        value = lambda i: F.max(F.when((first <= i) & (i < last), F.col("_v")))
        out += [value(lo).alias(f"_lo_{name}"), value(hi).alias(f"_hi_{name}"), F.max(place - lo).alias(f"_part_{name}")]
    got = at.groupBy(*by).agg(*out)
    return got.select(*by, *[(F.col(f"_lo_{n}") + F.col(f"_part_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n) for n in quantiles])


def global_index(df: DataFrame, *order: Column, name: str = "row_index") -> DataFrame:
    """Adds the row's number from 0 in a global order that has no ties."""
    return prefix_sums(df, list(order), {name: F.lit(1).cast("long")}).withColumn(name, F.col(name) - 1)


def pr_curve(scored: DataFrame, *by: str) -> DataFrame:
    """threshold, alerts, tp, precision, recall and its gain at each distinct score (score >= threshold), for each group ``by``.

    Rows with a null or NaN score, or a label that isn't 0 or 1, and groups of one class only, give nothing.
    """
    ok = scored.where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("label").isin(0, 1))
    points = ok.groupBy(*by, F.col("score").alias("threshold")).agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("pos"))
    if by:  # one order of all groups, so that no task holds a group's scores; less what stood before the group
        run = prefix_sums(points, [*[F.col(c).asc_nulls_first() for c in by], F.desc("threshold")], {"_n": F.col("n"), "_p": F.col("pos")})
        whole = run.groupBy(*[F.col(c).alias(f"_g_{c}") for c in by]).agg(F.min(F.col("_n") - F.col("n")).alias("_n0"), F.min(F.col("_p") - F.col("pos")).alias("_p0"), F.sum("pos").alias("_pos"), F.sum("n").alias("_all"))
        run = run.join(whole, [run[c].eqNullSafe(whole[f"_g_{c}"]) for c in by])
        run = run.withColumns({"alerts": F.col("_n") - F.col("_n0"), "tp": F.col("_p") - F.col("_p0")})
    else:
        run = prefix_sums(points, [F.desc("threshold")], {"alerts": F.col("n"), "tp": F.col("pos")})
        run = run.join(F.broadcast(run.agg(F.sum("pos").alias("_pos"), F.sum("n").alias("_all"))))  # of what is written down, so that rows are scored once
    run = run.where("_pos > 0 and _pos < _all")
    return run.select(*by, "threshold", "alerts", "tp", (F.col("tp") / F.col("alerts")).alias("precision"), (F.col("tp") / F.col("_pos")).alias("recall"), (F.col("pos") / F.col("_pos")).alias("gain"))


def f_beta(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    return F.coalesce((1 + beta**2) * precision * recall / F.nullif(beta**2 * precision + recall, F.lit(0.0)), F.lit(0.0))


def pick_threshold(curve: DataFrame, recall_floor: float = 0.01, min_alerts: int = 5, per_hour: float | None = None, hours: float | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """The point of most precision among those within the floors, the lowest threshold of equals. One row a group that
    has such a point."""
    ok = curve.where((F.col("alerts") >= max(1, min_alerts)) & (F.col("recall") >= recall_floor))
    if per_hour is not None and hours:
        ok = ok.where(F.col("alerts") / hours >= per_hour)
    best = F.max_by(F.struct("threshold", "precision", "recall", "alerts"), F.struct("precision", -F.col("threshold")))
    rows = ok.groupBy(*by).agg(best.alias("b")).where("b is not null").select(*by, "b.*")
    return rows.withColumns({"f_half": f_beta(F.col("precision"), F.col("recall"), BETA), "f_one": f_beta(F.col("precision"), F.col("recall"))})


def average_precision(curve: DataFrame, *by: str) -> DataFrame:
    """Steps of recall times precision."""
    return curve.groupBy(*by).agg(F.sum(F.col("gain") * F.col("precision")).alias("average_precision"))


def micro_metrics(scored: DataFrame, threshold: float, hours: float) -> DataFrame:
    """One row of counts, precision, recall, F and alerts an hour at a threshold."""
    hit = F.col("score") >= threshold
    one = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    df = scored.agg(F.count("*").alias("rows"), one(hit).alias("alerts"), one(hit & (F.col("label") == 1)).alias("tp"), one(F.col("label") == 1).alias("positives"))
    df = df.withColumns({"precision": F.coalesce(F.col("tp") / F.nullif("alerts", F.lit(0)), F.lit(0.0)), "recall": F.coalesce(F.col("tp") / F.nullif("positives", F.lit(0)), F.lit(0.0)), "alerts_per_hour": F.col("alerts") / hours})
    return df.withColumns({"f_half": f_beta(F.col("precision"), F.col("recall"), BETA), "f_one": f_beta(F.col("precision"), F.col("recall"))})


def prod_adjusted_precision(precision: Column, prod_ratio: float, test_ratio: float) -> Column:
    """Precision where negatives are ``prod_ratio`` to a positive, measured where they are ``test_ratio``."""
    return F.when((precision > 0) & (precision <= 1), 1 / (1 + (1 / precision - 1) * prod_ratio / test_ratio))


def macro_by_day(scored: DataFrame, threshold: float) -> DataFrame:
    """Means over (canonical_id, gaming_day) with an alert, and with a positive: whether an alert there is right."""
    hit, pos = F.col("score") >= threshold, F.col("label") == 1
    by = scored.groupBy("canonical_id", "gaming_day").agg(F.count_if(hit).alias("alerts"), F.bool_or(hit & pos).alias("right"), F.bool_or(pos).alias("positive"))
    right = F.col("right").cast("double")
    return by.agg(F.avg(F.when(F.col("alerts") > 0, right / F.col("alerts"))).alias("macro_precision"), F.avg(F.when(F.col("positive"), right)).alias("macro_recall"), F.count_if(F.col("alerts") > 0).alias("alert_days"))


def segment_errors(scored: DataFrame, threshold: float, *dims: str) -> DataFrame:
    """Counts and rates for each value of each dimension, by GROUPING SETS in one pass; worst error rate first."""
    hit, pos = F.col("score") >= threshold, F.col("label") == 1
    sets = scored.groupingSets([[d] for d in dims], *dims)
    df = sets.agg(F.grouping_id().alias("_g"), F.count("*").alias("n"), F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"), F.count_if(~hit & pos).alias("fn"))
    k = len(dims)
    full = (1 << k) - 1
    name = F.coalesce(*[F.when(F.col("_g") == full - (1 << (k - 1 - i)), F.lit(d)) for i, d in enumerate(dims)])
    value = F.coalesce(*[F.when(F.col("_g") == full - (1 << (k - 1 - i)), F.col(d).cast("string")) for i, d in enumerate(dims)])
    df = df.select(name.alias("dimension"), value.alias("value"), "n", "tp", "fp", "fn", (F.col("fp") + F.col("fn")).alias("errors"), (F.col("tp") + F.col("fp")).alias("alerts"))
    return df.withColumns({"error_rate": F.col("errors") / F.col("n"), "precision": F.col("tp") / F.nullif("alerts", F.lit(0))})


def worst(segments: DataFrame, k: int = 10, least: int = 1) -> DataFrame:
    return segments.where(F.col("n") >= least).orderBy(F.desc("error_rate"), "dimension", "value").limit(k)


def quantile_weights(df: DataFrame, proxy: Column, negative: tuple[float, float] = (0.90, 1.6), positive: tuple[float, float] = (0.75, 1.15)) -> DataFrame:
    """Adds weight: rows at or above their label's quantile of the proxy weigh more."""
    df = df.withColumn("_proxy", proxy)
    q = value_quantiles(df, "_proxy", {"_neg": negative[0], "_pos": positive[0]}, "label").where(F.col("label").isin(0, 1))
    j = df.join(F.broadcast(q), "label", "left")  # two rows
    w = F.when((F.col("label") == 0) & (F.col("_proxy") >= F.col("_neg")), negative[1]).when((F.col("label") == 1) & (F.col("_proxy") >= F.col("_pos")), positive[1]).otherwise(1.0)
    return j.withColumn("weight", w).drop("_proxy", "_neg", "_pos")


def fused(first: Column, second: Column, threshold: float, share: float) -> dict[str, Column]:
    """Two stages: candidates are at or above the threshold's share, their score is the product of both."""
    cut = min(1.0, max(0.0, threshold * share))
    return {"candidate": first >= cut, "fused": F.when(first >= cut, F.greatest(F.lit(0.0), F.least(F.lit(1.0), first * second))).otherwise(0.0)}


def decile_labels(df: DataFrame, column: str, name: str = "decile") -> DataFrame:
    """Adds 1 to 10 by mid-rank, equal values sharing one; null for null and NaN. Counts are summed by value first."""
    ok = F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
    counts = df.where(ok).groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("_n"))
    run = prefix_sums(counts, [F.col("_value").asc()], {"_upto": F.col("_n")})
    total = counts.agg(F.sum("_n").alias("_all"))
    mid = (F.col("_upto") - F.col("_n") + (F.col("_n") + 1) / 2 - 0.5) / F.col("_all")
    bucket = run.join(F.broadcast(total)).select("_value", F.least(F.lit(10), F.floor(mid * 10) + 1).cast("int").alias(name))
    return df.join(bucket, df[column].eqNullSafe(bucket["_value"]), "left").drop("_value")


def decile_bounds(labelled: DataFrame, column: str, name: str = "decile") -> DataFrame:
    return labelled.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))


def precision_at_recall(scored: DataFrame, recall: float, tie: str = "bet_id") -> DataFrame:
    """precision, threshold and achieved recall of the best point row by row, ties told apart by ``tie``, the first of
    equals: one row. Zero precision at the last row's score where no point has the recall."""
    ok = scored.where(F.col("score").isNotNull() & F.col("label").isin(0, 1)).select(tie, "score", "label")
    run = materialised(prefix_sums(ok, [F.desc("score"), F.asc(tie)], {"_n": F.lit(1), "_tp": F.col("label")}))
    total = run.agg(F.sum("label").alias("_pos"), F.min("score").alias("_low"), F.max("score").alias("_high"))
    points = run.join(F.broadcast(total.select("_pos"))).where(F.col("_tp") / F.nullif("_pos", F.lit(0)) >= recall)  # one row
    best = points.agg(F.max_by(F.struct((F.col("_tp") / F.col("_n")).alias("p"), "score", (F.col("_tp") / F.col("_pos")).alias("r")), F.struct(F.col("_tp") / F.col("_n"), -F.col("_n"))).alias("b"))
    out = best.join(F.broadcast(total))
    none = F.col("b").isNull()
    return out.select(
        F.coalesce("b.p", F.lit(0.0)).alias("precision"), F.when(none, F.when(F.col("_pos") > 0, F.col("_low")).otherwise(F.coalesce("_high", F.lit(0.0)))).otherwise(F.col("b.score")).alias("threshold"),
        F.when(none, F.when(F.col("_pos") > 0, 1.0).otherwise(0.0)).otherwise(F.col("b.r")).alias("recall"),
    )


def operating_points(scored: DataFrame, threshold: float, hours: float, recalls: tuple[float, ...] = RECALLS, min_alerts: int = 1) -> DataFrame:
    """``micro_metrics`` with the average precision, and the threshold, precision and alerts an hour at each recall floor."""
    curve = materialised(pr_curve(scored))
    out = micro_metrics(scored, threshold, hours).join(F.broadcast(average_precision(curve)), how="left")  # one row each
    for r in recalls:
        name = f"{r:g}".replace(".", "_")
        pick = pick_threshold(curve, r, min_alerts)
        pick = pick.select(F.col("threshold").alias(f"threshold_r{name}"), F.col("precision").alias(f"precision_r{name}"), (F.col("alerts") / hours).alias(f"alerts_per_hour_r{name}"))
        out = out.join(F.broadcast(pick), how="left")
    return out


def rank_deciles(df: DataFrame, column: str, tie: str, name: str = "decile") -> DataFrame:
    """Adds 1 to 10 by plain rank, ``int(rank * 10 / n) + 1``, ties told apart by ``tie``; nulls and NaN aren't ranked."""
    ok = F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
    keys = global_index(df.where(ok).select(F.col(tie).alias("_tie"), F.col(column).alias("_v")), F.col("_v").asc(), F.col("_tie").asc(), name="_rank")
    n = df.where(ok).count()
    bucket = keys.select("_tie", F.least(F.lit(10), F.floor(F.col("_rank") * 10 / max(1, n)) + 1).cast("int").alias(name))
    return df.join(bucket, df[tie] == bucket["_tie"], "left").drop("_tie")


def slice_report(scored: DataFrame, threshold: float, *dims: str, least: int = 30) -> DataFrame:
    """``segment_errors`` with each segment's precision less that of all rows, and whether it has few rows."""
    hit, pos = F.col("score") >= threshold, F.col("label") == 1
    whole = scored.agg((F.count_if(hit & pos) / F.nullif(F.count_if(hit), F.lit(0))).alias("_precision"))
    df = segment_errors(scored, threshold, *dims).join(F.broadcast(whole))  # one row
    return df.withColumns({"precision_delta": F.col("precision") - F.col("_precision"), "low_n": F.col("n") < least}).drop("_precision")
