"""Plans: bounds that reach the scan, and curves by group without a task a group."""

import random

import pytest

from stakeflow.operators import ranking
from stakeflow.plans import registry
from tests.conftest import SF


@pytest.mark.parametrize(("name", "column"), [("s1_scan_bets", "ts"), ("s2_scan_sessions", "o_orderdate"), ("s9_scan_bets_live", "ts"), ("s10_open_sessions", "o_orderdate"), ("p5_bet_dq", "ts"), ("p11_time_window", "ts")])
def test_time_bounds_are_pushed_down(spark, name, column):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert f"GreaterThanOrEqual({column}" in pushed and ("LessThan(" in pushed or "LessThanOrEqual(" in pushed), pushed


def test_curves_of_groups_are_those_of_each_group(spark):
    r = random.Random(1)
    rows = [(r.choice(["a", "a", "a", "b", None, "one"]), round(r.random(), 2), r.randint(0, 1)) for _ in range(3000)]
    rows = [(g, s, 1 if g == "one" else y) for g, s, y in rows] + [("a", None, 1), ("a", float("nan"), 0)]
    df = spark.createDataFrame(rows, "g string, score double, label int")
    got = {(x.g, x.threshold): (x.alerts, x.tp, round(x.recall, 9), round(x.gain, 9)) for x in ranking.pr_curve(df, "g").collect()}
    want = {}
    for g in ("a", "b", None):
        mine = [(s, y) for k, s, y in rows if k == g and s is not None and s == s]
        pos = sum(y for _, y in mine)
        for t in {s for s, _ in mine}:
            tp = sum(y for s, y in mine if s >= t)
            want[g, t] = (sum(s >= t for s, _ in mine), tp, round(tp / pos, 9), round(sum(y for s, y in mine if s == t) / pos, 9))
    assert got == want
