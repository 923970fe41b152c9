"""Boosted trees over features that are evaluated once, and ties that cost no shuffle of their own."""

from pyspark.sql import functions as F

from stakeflow.operators import facts, features, ranking, sequence
from stakeflow.plans import adapters, model_queries
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_models_read_what_is_written_down(spark):
    df = model_queries.labelled(spark, SF)
    assert "Window" not in plan(df)
    plain = facts.sample_weights(features.add_features(adapters.bets(spark, SF), features.BET_FEATURES, key="player_id", unit=60 * adapters.MINUTE), "player_id")
    columns = ["bet_id", "player_id", "us", "weight", *model_queries.FEATURES]
    assert df.select(columns).count() == adapters.bets(spark, SF).count() and df.select(columns).exceptAll(plain.select(columns)).count() == 0
    assert {r.split: r["count"] for r in df.groupBy("split").count().collect()} == {"train": 700, "valid": 150, "test": 150}


def test_curve_scores_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def told(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.range(1000).select((F.col("id") % 97 / 97).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    curve = ranking.pr_curve(rows.mapInPandas(told, rows.schema))
    assert curve.count() == 97 and seen.value == 1000


def test_ties_are_ranked_without_a_shuffle_of_their_own(spark):
    rows = [("a", 5, 3), ("a", 5, 1), ("a", 7, 2), ("b", 5, 9), ("b", 5, 4), ("b", 5, 6)]
    df, up_to_row = sequence.tie_key(spark.createDataFrame(rows, "k string, us long, bet_id long"), "k")
    assert sorted((r.k, r.bet_id, r._tie_us) for r in df.collect()) == [("a", 1, 1), ("a", 2, 13), ("a", 3, 2), ("b", 4, 1), ("b", 6, 2), ("b", 9, 3)]
    near = df.withColumn("n", F.count("*").over(up_to_row(2)))
    assert near._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {r.bet_id: r.n for r in near.collect()} == {1: 1, 3: 2, 2: 3, 4: 1, 6: 2, 9: 3}
