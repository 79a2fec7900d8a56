import random
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from shelfcast.functions.ranking import rank_in_group


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_a_window_rank_with_ties_bands_and_nulls(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(800):
        group = "hot" if rng.random() < 0.6 else rng.choice(["b", "c"])
        cents = rng.choice([0, 7, 10**9, rng.randrange(-(10**8), 10**9), rng.randrange(0, 50)])
        rows.append((i, group, None if rng.random() < 0.03 else Decimal(cents) / 100))
    df = spark.createDataFrame(rows, "id int, g string, v decimal(18,4)")
    got = {r["id"]: r["r"] for r in rank_in_group(df, ["g"], "v", "r").collect()}
    window = Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    for r in df.withColumn("r", F.rank().over(window)).collect():
        assert got[r["id"]] == (None if r["v"] is None else r["r"])
    assert len(got) == len(rows)


def test_null_groups_are_ranked(spark):
    df = spark.createDataFrame([(None, Decimal(1)), (None, Decimal(2)), ("a", Decimal(3))], "g string, v decimal(18,4)")
    got = {(r["g"], int(r["v"])): r["r"] for r in rank_in_group(df, ["g"], "v", "r").collect()}
    assert got == {(None, 2): 1, (None, 1): 2, ("a", 3): 1}
