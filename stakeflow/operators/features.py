"""Declared window features: a list of records becomes columns, one window a frame.

A record has an id, a kind, and an expression over columns and earlier features:

* ``window``: an aggregate over ``minutes`` before the row, up to the row itself even among ties; or over ``rows``
  before it; or over all before it where neither is given;
* ``lag``: the value ``rows`` before;
* ``row``: an expression of the row;
* ``function``: a function of ``FUNCTIONS`` by its name, which takes the frame and the key and gives the column.

``fill`` replaces nulls (``ffill`` carries the last value on), ``clip`` bounds the result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakeflow.operators.sequence import in_order, so_far, tie_key

MINUTE = 60_000_000

#: Functions that expressions may call.
ALLOWED = frozenset("count sum avg min max stddev_samp stddev_pop abs round coalesce nullif greatest least sin cos pi hour minute floor ceil sqrt ln exp power if".split())
KEYWORDS = frozenset("case when then else end and or not is null in between as true false like distinct".split())


@dataclass(frozen=True)
class Feature:
    id: str
    expression: str
    kind: str = "row"
    minutes: float | None = None
    rows: int | None = None
    fill: float | str | None = 0.0
    clip: tuple[float, float] | None = None
    depends_on: tuple[str, ...] = field(default=())


#: Named functions: from the key to a column over its rows in order.
FUNCTIONS: dict[str, Callable[[str], Column]] = {
    "bets_so_far": lambda key: F.row_number().over(in_order(key)).cast("double"),
    "minutes_since_last": lambda key: (F.col("us") - F.lag("us").over(in_order(key))) / MINUTE,
}


def validate_features(features: Iterable[Feature], columns: Iterable[str]) -> list[Feature]:
    """The records in an order in which each comes after what it depends on.

    Ids are unique; expressions hold no ``;``, comment, sub-select or frame of following rows, and call allowed functions
    only; dependencies are known and have no cycle.
    """
    todo = {}
    for f in features:
        if f.id in todo:
            raise ValueError(f"{f.id}: declared twice")
        todo[f.id] = f
    known, out = set(columns), []
    for f in todo.values():
        text = f.expression
        if re.search(r";|--|/\*|\b(select|following|from|over|join)\b", text, re.I):
            raise ValueError(f"{f.id}: {text!r} isn't allowed")
        if f.kind == "function":
            if text not in FUNCTIONS:
                raise ValueError(f"{f.id}: unknown function {text!r}")
            continue
        if calls := {c.lower() for c in re.findall(r"\b(\w+)\s*\(", text)} - ALLOWED - KEYWORDS:
            raise ValueError(f"{f.id}: calls {', '.join(sorted(calls))}")
        if f.kind not in ("window", "lag", "row"):
            raise ValueError(f"{f.id}: unknown kind {f.kind!r}")
        if lost := [d for d in f.depends_on if d not in todo and d not in known]:
            raise ValueError(f"{f.id}: depends on unknown {', '.join(lost)}")
    while todo:
        ready = [f for f in todo.values() if not any(d in todo for d in f.depends_on)]
        if not ready:
            raise ValueError(f"a cycle among {', '.join(sorted(todo))}")
        for f in ready:
            out.append(todo.pop(f.id))
    return out


def finished(c: Column, f: Feature, key: str) -> Column:
    """Filled and clipped; what stays null isn't clipped."""
    if f.fill == "ffill":
        c = F.last(c, ignorenulls=True).over(so_far(key))
    elif f.fill is not None:
        c = F.coalesce(c, F.lit(f.fill))
    if f.clip is not None:
        c = F.when(c.isNotNull(), F.greatest(F.lit(f.clip[0]), F.least(F.lit(f.clip[1]), c)))
    return c


def add_features(bets: DataFrame, features: Iterable[Feature], key: str = "canonical_id", unit: float = MINUTE, cutoff_us: int | None = None) -> DataFrame:
    """Adds the features to ``bets`` (key, us, bet_id). Features that depend on no other of a step are added together, so
    that Spark evaluates all frames of one order in one pass. Rows after the cutoff go. Null key or time rows go."""
    steps = validate_features(features, bets.columns)
    df = bets.where(F.col(key).isNotNull() & F.col("us").isNotNull())
    df = df if cutoff_us is None else df.where(F.col("us") <= cutoff_us)
    df, up_to_row = tie_key(df, key)
    done: set[str] = set(df.columns)
    while steps:
        now = [f for f in steps if all(d in done for d in f.depends_on)]
        cols = {}
        for f in now:
            e = FUNCTIONS[f.expression](key) if f.kind == "function" else F.expr(f.expression)
            if f.kind == "lag":
                e = F.lag(e, f.rows or 1).over(in_order(key))
            elif f.kind == "window" and f.minutes is not None:
                e = e.over(up_to_row(int(f.minutes * unit)))
            elif f.kind == "window" and f.rows is not None:
                e = e.over(in_order(key).rowsBetween(-f.rows, 0))
            elif f.kind == "window":
                e = e.over(so_far(key))
            cols[f.id] = finished(e, f, key) if f.fill != "ffill" else e
        df = df.withColumns(cols)
        carried = {f.id: finished(F.col(f.id), f, key) for f in now if f.fill == "ffill"}
        df = df.withColumns(carried) if carried else df
        done |= set(cols)
        steps = [f for f in steps if f.id not in done]
    return df.drop("_tie_us")


def _w(id: str, e: str, minutes: float | None = None, rows: int | None = None, **kw) -> Feature:
    return Feature(id, e, "window", minutes, rows, **kw)


def _r(id: str, e: str, *on: str, **kw) -> Feature:
    return Feature(id, e, depends_on=on, **kw)


def _count(s: str) -> str:
    return f"sum(case when status = '{s}' then 1 else 0 end)"


MANY = (0.0, 1e6)
#: The declared features, with their clips.
BET_FEATURES = [
    *[_w(f"bets_cnt_w{m}m", "count(bet_id)", m, clip=MANY) for m in (5, 15, 30)],
    _r("pace_drop_ratio", "bets_cnt_w5m / nullif(bets_cnt_w30m, 0)", "bets_cnt_w5m", "bets_cnt_w30m", clip=(0.0, 1.0)),
    _r("pace_drop_ratio_w15m_w30m", "bets_cnt_w15m / nullif(bets_cnt_w30m, 0)", "bets_cnt_w15m", "bets_cnt_w30m", clip=(0.0, 2.0)),
    Feature("prev_us", "us", "lag", rows=1, fill=None),
    _r("prev_bet_gap_min", "(us - prev_us) / 60000000", "prev_us", clip=(0.0, 10080.0)),
    _w("wager_sum_w30m", "sum(wager)", 30),
    _w("wager_avg_w15m", "avg(wager)", 15),
    _w("wager_avg_w5m", "avg(wager)", 5),
    _w("wager_max_w15m", "max(wager)", 15),
    _w("wager_std_w15m", "stddev_samp(wager)", 15),
    _r("wager_w5m_over_w15m", "wager_avg_w5m / nullif(wager_avg_w15m, 0)", "wager_avg_w5m", "wager_avg_w15m", clip=(0.0, 10.0)),
    _w("cum_bets", "count(bet_id)"),
    _w("cum_wager", "sum(wager)"),
    _r("avg_wager_sofar", "cum_wager / nullif(cum_bets, 0)", "cum_wager", "cum_bets"),
    _r("wager_recent_vs_session_avg", "wager_avg_w5m / nullif(avg_wager_sofar, 0)", "wager_avg_w5m", "avg_wager_sofar", clip=(0.0, 10.0)),
    Feature("wager_10_before", "wager", "lag", rows=10, fill=None),
    _r("wager_slope_w10bets", "(wager - wager_10_before) / 10", "wager_10_before"),
    Feature("prev_wager", "wager", "lag", rows=1),
    Feature("prev_status", "status", "lag", rows=1, fill=None),
    _r("prev_bet_was_loss", "case when prev_status = 'LOSE' then 1 else 0 end", "prev_status"),
    *[_w(f"{s.lower()}_cnt_w15m", _count(s), 15) for s in ("LOSE", "WIN", "PUSH")],
    _r("win_rate_w15m", "win_cnt_w15m / nullif(bets_cnt_w15m, 0)", "win_cnt_w15m", "bets_cnt_w15m", clip=(0.0, 1.0)),
    _r("non_win_rate_w15m", "(lose_cnt_w15m + push_cnt_w15m) / nullif(bets_cnt_w15m, 0)", "lose_cnt_w15m", "push_cnt_w15m", "bets_cnt_w15m", clip=(0.0, 1.0)),
    _w("avg_payout_odds_w15m", "avg(payout_odds)", 15),
    _w("back_bet_cnt_w20", "sum(is_back_bet)", rows=20),
    _w("bets_cnt_w20", "count(bet_id)", rows=20),
    _r("back_bet_pct_w20", "back_bet_cnt_w20 / nullif(bets_cnt_w20, 0)", "back_bet_cnt_w20", "bets_cnt_w20", clip=(0.0, 1.0)),
    _w("position_min_w30m", "min(position_idx)", 30),
    _w("position_max_w30m", "max(position_idx)", 30),
    _r("position_moved_w30m", "case when position_min_w30m <> position_max_w30m then 1 else 0 end", "position_min_w30m", "position_max_w30m"),
]


def personal_baselines(df: DataFrame) -> DataFrame:
    """Adds a run's length, bets and pace by the player's own averages before it; 0 without a positive average."""
    per = lambda a, b: F.when(F.col(b) > 0, F.coalesce(F.col(a) / F.col(b), F.lit(0.0))).otherwise(0.0)
    return df.withColumns({"run_duration_vs_personal_avg": per("minutes_since_run_start", "avg_run_minutes"), "bets_in_run_vs_personal_avg": per("bets_in_run", "avg_bets_in_run"), "pace_vs_personal_baseline": per("bets_per_minute", "avg_bets_per_minute")})


def run_history(runs: DataFrame) -> DataFrame:
    """Adds avg_run_minutes, avg_bets_in_run and avg_bets_per_minute of the player's runs (player_id, run_seq, run_start_us,
    run_end_us, bet_count) before each; null for the first. Runs of no length have no pace."""
    before = Window.partitionBy("player_id").orderBy("run_seq").rowsBetween(Window.unboundedPreceding, -1)
    minutes = (F.col("run_end_us") - F.col("run_start_us")) / MINUTE
    return runs.withColumns({"avg_run_minutes": F.avg(minutes).over(before), "avg_bets_in_run": F.avg("bet_count").over(before), "avg_bets_per_minute": F.avg(F.when(minutes > 0, F.col("bet_count") / minutes)).over(before)})


def game_timeline(games: DataFrame, unit: float = MINUTE) -> DataFrame:
    """For each resolved round what was known at its table before it: the streak of equal outcomes up to the round before
    (void or blank ones reset it to 0), shares of outcomes in the 20 before, players of the one before, its turnover of
    5 minutes by that of 15, and what the house won in 15 minutes, of the rounds before."""
    o = Window.partitionBy("table_id").orderBy("us", "game_id")
    real = F.col("outcome").isin("BANKER", "PLAYER", "TIE")
    changed = (~F.coalesce(real, F.lit(False))) | F.coalesce(F.lag("outcome").over(o) != F.col("outcome"), F.lit(True))
    df = games.withColumn("_group", F.sum(changed.cast("int")).over(o.rowsBetween(Window.unboundedPreceding, 0)))
    here = F.when(real, F.count("*").over(Window.partitionBy("table_id", "_group").orderBy("us", "game_id").rowsBetween(Window.unboundedPreceding, 0))).otherwise(0)
    df = df.withColumns({"_streak": here, "_turnover": F.lag("total_turnover").over(o), "_win": F.lag("casino_win").over(o)})
    last20 = o.rowsBetween(-20, -1)
    share = lambda s: F.coalesce(F.avg((F.col("outcome") == s).cast("double")).over(last20), F.lit(0.0))
    players = F.coalesce(F.lag("num_players").over(o), F.lit(0))
    clip = lambda c, lo, hi: F.greatest(F.lit(lo), F.least(F.lit(hi), F.coalesce(c, F.lit(0.0))))
    df = df.select(
        "table_id", "game_id", "us", "_turnover", "_win",
        F.coalesce(F.lag("_streak").over(o), F.lit(0)).cast("long").alias("current_outcome_streak_len"),
        *[share(s).alias(f"{s.lower()}_rate_w20games") for s in ("BANKER", "PLAYER", "TIE")],
        players.alias("table_num_players"), (players == 1).cast("int").alias("patron_is_sole_player"),
    )
    df = _since(_since(df, int(15 * unit), {"_turnover15": "_turnover", "_win15": "_win"}), int(5 * unit), {"_turnover5": "_turnover"})
    return df.withColumns({
        "table_turnover_w5m_over_w15m": clip(F.col("_turnover5") / F.nullif(F.col("_turnover15"), F.lit(0.0)), 0.0, 10.0),
        "table_net_outcome_w15m": clip(F.col("_win15"), -1e9, 1e9),
    }).drop("_turnover", "_win", "_turnover15", "_win15", "_turnover5")


def _since(df: DataFrame, width: int, sums: dict[str, str]) -> DataFrame:
    """Adds sums of columns over a table's rows of less than ``width`` before each row, up to the row itself by time and id.

    Time is cut into spans of ``width``. A row's sum is that of its own span up to the row, and of the span before from
    its end back to ``width`` before the row: both run on from row to row, where a RANGE frame adds its rows up again for
    each row."""
    names = list(df.columns)
    df = df.withColumn("_span", F.col("us") - F.pmod("us", F.lit(width)))
    running = lambda *by: Window.partitionBy("table_id", "_span").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0.0))
    own = df.withColumns({k: total(c, running("us", "game_id")) for k, c in sums.items()})
    rows = df.where("us is not null").select("table_id", "_span", F.col("us").alias("_at"), F.lit(1).alias("_side"), *[F.col(c).alias(f"_of{k}") for k, c in sums.items()])
    asks = own.select("table_id", (F.col("_span") - width).alias("_span"), (F.col("us") - width).alias("_at"), F.lit(0).alias("_side"), F.struct(*names, *sums).alias("_row"))
    back = running(F.desc("_at"), "_side")  # what is asked at a row's time comes before it
    both = asks.unionByName(rows, allowMissingColumns=True).withColumns({f"_sum{k}": total(f"_of{k}", back) for k in sums}).where("_row is not null")
    return both.select(*[F.col(f"_row.{c}").alias(c) for c in names], *[(F.col(f"_row.{k}") + F.col(f"_sum{k}")).alias(k) for k in sums])
