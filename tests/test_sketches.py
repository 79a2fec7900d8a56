"""Distinct counts of days add up to months within the stated error."""

from pyspark.sql import functions as F

from shelfcast.operators.sketches import against_exact, distinct_sketches, rolled_up, stated_error, within_error


def days(spark, n, per_day=31):
    """n visits; a visitor comes on several days, and a third of all visits is one day of one source."""
    hot = F.col("id") % 3 == 0
    return spark.range(n, numPartitions=6).select(
        F.when(hot, 0).otherwise(F.col("id") % per_day).cast("int").alias("day"),
        F.when(hot, "hot").when(F.col("id") % 7 == 0, None).otherwise("web").alias("source"),
        (F.col("id") * 7919 % (n // 3)).alias("visitor"),
    )


def test_months_from_days_keep_the_stated_error(spark):
    df = days(spark, 300_000)
    got = against_exact(df, distinct_sketches(df, ["day", "source"], "visitor"), ["source"], "visitor", "visitors")
    rows = {r["source"]: (r["visitors"], r["within_error"]) for r in got.collect()}
    exact = {r["source"]: r["n"] for r in df.groupBy("source").agg(F.countDistinct("visitor").alias("n")).collect()}
    assert rows == {source: (n, True) for source, n in exact.items()} and None in rows


def test_adding_up_days_would_count_twice(spark):
    df = days(spark, 60_000)
    per_day = distinct_sketches(df, ["day"], "visitor")
    total = rolled_up(per_day, [F.lit(1).alias("all")], "visitors").first()["visitors"]
    exact = df.select("visitor").distinct().count()
    summed = rolled_up(per_day, ["day"], "visitors").agg(F.sum("visitors")).first()[0]
    assert abs(total - exact) <= stated_error() * exact + 1 and summed > 1.5 * exact


def test_a_wrong_estimate_is_told(spark):
    df = spark.createDataFrame([(1000, 1000), (1000, 1100), (0, 0), (3, 3), (3, 5)], "exact long, guess long")
    got = [r[0] for r in df.select(within_error("guess", "exact")).collect()]
    assert got == [True, False, True, True, False]
    visits = days(spark, 3000)
    part = distinct_sketches(visits.where("day < 3"), ["day", "source"], "visitor")
    wrong = against_exact(visits, part, ["source"], "visitor", "n").where("source = 'web'").first()
    assert not wrong["within_error"]


def test_missing_values_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("a", 1), (None, None)], "k string, v long")
    got = {r["k"]: (r["n"], r["within_error"]) for r in
           against_exact(df, distinct_sketches(df, ["k"], "v"), ["k"], "v", "n").collect()}
    assert got == {"a": (1, True), None: (0, True)}
    empty = df.limit(0)
    assert against_exact(empty, distinct_sketches(empty, ["k"], "v"), ["k"], "v", "n").count() == 0
