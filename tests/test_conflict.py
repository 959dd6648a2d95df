import pytest
from helpers import values
from pyspark.sql import functions as F

from tidegate.operators import conflict


def inputs(spark):
    return spark.createDataFrame(
        [("new", None, "h", None), ("same", 1, "h", "h"), ("other", 2, "h", "x"),
         ("never", 3, "h", None), ("blank", 4, "h", "")],
        "entity_id string, existing_id bigint, content_hash string, last_hash string",
    )


@pytest.mark.parametrize("strategy, action", [
    ("SOURCE_WINS", "UPDATE"), ("TARGET_WINS", "SKIP"), ("FLAG", "FLAG")
])
def test_action_per_strategy(spark, strategy, action):
    got = conflict.decide(inputs(spark), strategy)
    assert values(got, "entity_id", "action", "strategy") == [
        ("blank", action, strategy), ("never", action, strategy), ("new", "NONE", None),
        ("other", action, strategy), ("same", "SKIP", strategy),
    ]
    assert got.where(F.col("reason").isNull()).isEmpty()


def test_strategy_column(spark):
    rows = inputs(spark).where("entity_id in ('other', 'never')")
    chosen = F.when(F.col("entity_id") == "other", "FLAG").otherwise("SOURCE_WINS")
    assert values(conflict.decide(rows, chosen), "entity_id", "action") == [
        ("never", "UPDATE"), ("other", "FLAG")
    ]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="BOTH_WIN"):
        conflict.decide(inputs(spark), "BOTH_WIN")


def test_apply(spark):
    decided = conflict.decide(inputs(spark), "SOURCE_WINS").withColumn("name", F.col("entity_id"))
    target = spark.createDataFrame(
        [(1, "same", "old"), (2, "other", "old"), (20, "other", "copy"), (9, "gone", "old"),
         (8, None, "loose")],
        "id bigint, ref string, name string",
    )
    decided = decided.where("entity_id not in ('never', 'blank')")
    got = conflict.apply_decisions(decided, target, ["name"], "ref")
    assert values(got, "id", "ref", "name") == sorted([
        (1, "same", "old"), (2, "other", "other"), (20, "other", "copy"), (9, "gone", "old"),
        (8, None, "loose"), (None, "new", "new"),
    ], key=repr)
