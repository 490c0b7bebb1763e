"""Rounding and summing."""

import random

from pyspark.sql import functions as F

from paywarden.functions.money import exact_sum, percentage, round_half_even


def test_rounding_equals_correct_rounding_of_the_binary_value(spark):
    rng = random.Random(7)
    values = [k / 200 for k in range(-400, 4001)]
    values += [k / 1000 + 1e9 for k in range(0, 2000, 5)]
    values += [rng.uniform(0, 5000) for _ in range(3000)]
    values += [round(rng.uniform(0, 1e6), 3) for _ in range(5000)]
    values += [n * 5 / m for m in range(1, 60) for n in range(0, 200, 7)]
    values += [1e15 + 0.125, 1e22, 1e300, 0.0, 5e-324]
    values += [1000000000000.025, 1000000000000.005, 2.0**40 + 0.125, 2.0**46, 2.0**46 - 2.0**-7]
    for power in range(36, 58):
        low = 2.0**power
        values += [rng.uniform(low, 2 * low) for _ in range(300)]
        values += [low + rng.randrange(1000) + k / 8 for k in range(8)]
    values += [-v for v in values]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    rows = frame.select("v", round_half_even(F.col("v")).alias("r")).collect()
    wrong = [(r.v, r.r, round(r.v, 2)) for r in rows if r.r != round(r.v, 2)]
    assert wrong == []


def test_sums_do_not_depend_on_order(spark):
    values = [0.1] * 1000 + [1e14, 0.01, -1e14]
    sums = set()
    for seed in range(3):
        random.Random(seed).shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        sums.add(frame.agg(exact_sum(F.col("v")).alias("s")).first().s)
    assert sums == {100.01}


def test_sums_of_large_amounts_do_not_depend_on_order(spark):
    values = [1e15, 3e20, -3e20, 0.01, 2.5e15, -1e15] + [0.1] * 90
    sums = set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
        sums.add(frame.agg(exact_sum(F.col("v")).alias("s")).first().s)
    assert sums == {2500000000000009.01}


def test_huge_amounts_are_neither_lost_nor_fatal(spark):
    frame = spark.createDataFrame([(1e300,), (2.5,), (None,)], "v double")
    assert frame.agg(exact_sum(F.col("v")).alias("s")).first().s == 1e300
    nothing = spark.createDataFrame([(None,)], "v double")
    assert nothing.agg(exact_sum(F.col("v")).alias("s")).first().s is None


def test_percentages(spark):
    frame = spark.createDataFrame([(1, 8), (1, 3), (1, 0)], "a long, b long")
    rows = frame.select(percentage(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r.p for r in rows] == [12.5, 33.33, None]
