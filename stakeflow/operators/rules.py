"""Rule baselines and row-wise assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeflow.operators import ranking


def pace_rule(signal: Column) -> Column:
    """Slower is riskier."""
    return -F.coalesce(signal.cast("double"), F.lit(0.0))


def loss_rule(net: Column, wager: Column | None = None) -> Column:
    """Losing more is riskier, by wager where given."""
    loss = -F.coalesce(net.cast("double"), F.lit(0.0))
    return loss if wager is None else F.coalesce(loss / F.nullif(wager.cast("double"), F.lit(0.0)), F.lit(0.0))


def adt_rule(current: Column, adt: Column, tau: float = 1.0, eps: float = 1e-6) -> Column:
    """The current theoretical loss by the usual one."""
    return F.coalesce(current.cast("double"), F.lit(0.0)) / F.greatest(F.coalesce(adt.cast("double"), F.lit(0.0)) * tau, F.lit(eps))


def single_feature(column: Column, high_is_risk: bool = True) -> Column:
    return column.cast("double") if high_is_risk else -column.cast("double")


def baseline_report(df: DataFrame, rules: dict[str, Column], recall_floor: float = 0.1) -> DataFrame:
    """A row for each rule: average precision, and the best point above the recall floor. All rules go in one pass."""
    scored = df.withColumns({f"_s_{k}": c for k, c in rules.items()})
    long = scored.select("label", F.expr(f"stack({len(rules)}, {', '.join(f'{k!r}, CAST(`_s_{k}` AS DOUBLE)' for k in rules)}) AS (rule, score)"))
    curve = ranking.pr_curve(long, "rule")
    return ranking.average_precision(curve, "rule").join(ranking.pick_threshold(curve, recall_floor, by=("rule",)), "rule", "left")


def profile_violations(profile: DataFrame) -> DataFrame:
    """Adds violations: codes of what a profile row breaks, as an array."""
    code = lambda c, name: F.when(c, F.lit(name))
    return profile.withColumn("violations", F.array_compact(F.array(
        code(F.col("days_since_last_session") < 0, "NEGATIVE_RECENCY"),
        code(F.col("days_since_first_session") < F.col("days_since_last_session"), "FIRST_AFTER_LAST"),
        code(F.col("sessions_30d") < F.col("sessions_7d"), "WINDOW_NOT_NESTED"),
        code(F.col("turnover_sum_30d") < 0, "NEGATIVE_TURNOVER"),
        code(F.col("active_days_30d") > 31, "TOO_MANY_DAYS"),
    )))


def time_window(df: DataFrame, column: str, lo: int, hi: int, required: bool = False) -> DataFrame:
    """Rows in ``[lo, hi)``; a null time is an error when it is met, and with ``required`` so is a window without a row, at
    once."""
    c = F.when(F.col(column).isNull(), F.raise_error(F.lit(f"{column} is null"))).otherwise(F.col(column))
    out = df.where((c >= lo) & (c < hi))
    if required and out.isEmpty():
        raise ValueError(f"no row with {column} in [{lo}, {hi})")
    return out


def feature_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles; a null, NaN or text that is no number is an error when it is met."""
    good = lambda c: F.col(c).try_cast("double")
    return df.select(*[F.when(good(c).isNull() | F.isnan(good(c)), F.raise_error(F.lit(f"{c} isn't a number"))).otherwise(good(c)).alias(c) for c in columns])


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    if lost := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(lost)}")
    return df


def bad_labels(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col(label).isNull() | ~F.col(label).isin(0, 1)).alias("bad"))


def binary_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """``df``, if every label is 0 or 1; an error that names how many aren't, and one where there is no row."""
    rows, bad = bad_labels(df, label).first()
    if bad or not rows:
        raise ValueError(f"{bad} of {rows} labels are neither 0 nor 1" if rows else "no labels")
    return df


def filled(df: DataFrame, columns: list[str], profile: list[str] = ()) -> DataFrame:
    """Zero for missing values, except of profile columns."""
    return df.fillna(0, [c for c in columns if c not in profile])
