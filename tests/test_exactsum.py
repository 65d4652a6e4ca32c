"""Order-free sums: the same bits for every partitioning, and near the true sum."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from plantlake.functions import exact_avg, exact_sum
from plantlake.functions.measures import Measure
from plantlake.operators.rollup import Rollup
from plantlake.plans.plant import plant_specs


def bits(x):
    return None if x is None else struct.pack(">d", x)


def values(seed, n):
    pick = random.Random(seed)
    return [pick.choice([1, -1]) * pick.random() * 10.0 ** pick.randint(-6, 9) for _ in range(n)]


def test_same_bits_for_twenty_partitionings(spark):
    rows = [(i % 7, x) for i, x in enumerate(values(1, 4000))]
    df = spark.createDataFrame(rows, "k int, x double")
    seen, plain = set(), set()
    for seed in range(20):
        shuffled = df.orderBy(F.rand(seed)).repartition(1 + seed % 9)
        got = shuffled.groupBy("k").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a"), F.sum("x").alias("p")).collect()
        seen.add(tuple(sorted((r.k, bits(r.s), bits(r.a)) for r in got)))
        plain.add(tuple(sorted((r.k, bits(r.p)) for r in got)))
    assert len(seen) == 1
    assert len(plain) > 1  # what the exact sums are for
    for k, s, a in seen.pop():
        own = [x for j, x in rows if j == k]
        true = float(sum(map(Fraction, own)))
        assert abs(struct.unpack(">d", s)[0] - true) <= 2 * math.ulp(true)
        assert abs(struct.unpack(">d", a)[0] - true / len(own)) <= 4 * math.ulp(true / len(own))


INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize(
    ("own", "want"),
    [
        ([], None), ([None, None], None), ([None, 2.5], 2.5), ([INF, 1.0], INF), ([-INF, 1.0], -INF), ([INF, -INF], NAN), ([NAN, 1.0], NAN),
        ([1e300, 1.0], 1e300), ([2.0**54, 3.0], 2.0**54 + 4), ([-(2.0**53), 1.0], -(2.0**53) + 1), ([0.1] * 10, 1.0), ([-0.0], 0.0),
        ([1e15, 2.0**-60, -1e15], 2.0**-60), ([5e-324, 1.0], 1.0), ([-0.75, -0.5], -1.25),
    ],
)
def test_edges(spark, own, want):
    got = spark.createDataFrame([(x,) for x in own], "x double").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    if want is None or want != want:
        assert (got.s is None) == (want is None) and (want is None or math.isnan(got.s))
        assert (got.a is None) == (want is None)
    else:
        n = sum(x is not None for x in own)
        assert got.s == want and got.a == want / n


def test_sums_beyond_a_long_fall_back_to_the_double_sum(spark):
    big = 2.0**53
    df = spark.range(8).select(F.lit(big).alias("x"))
    assert df.agg(exact_sum("x").alias("s")).first().s == 8 * big


def test_measures_take_exact_sums(spark):
    with pytest.raises(ValueError, match="unknown sums"):
        Measure("mean", "x", "x", sums="some")
    df = spark.createDataFrame([("2024-01-01 00:01:00", 1.0), ("2024-01-01 00:02:00", 2.0)], "fecha string, x double")
    df = df.withColumn("fecha", F.to_timestamp_ntz("fecha"))
    spec = Rollup("r", tuple(Measure(k, "x", k, sums="exact") for k in ("mean", "total", "avg")))
    assert spec.build(df).select("mean", "total", "avg").first() == (1.5, 3.0, 1.5)


def test_daily_facts_add_exactly_and_silver_on_request():
    def sums(step):
        steps = getattr(step.spec, "steps", (step.spec,))
        return {m.sums for s in steps for m in s.measures if m.kind in ("mean", "avg", "total")}

    plain, exact = plant_specs(), plant_specs(silver_sums="exact")
    assert all(sums(s) == {"exact"} for s in plain.gold)
    assert all(sums(s) == {"plain"} for s in plain.silver) and all(sums(s) == {"exact"} for s in exact.silver)
