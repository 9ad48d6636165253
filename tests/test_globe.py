"""Radius joins and nearest places across the poles and the date line, against brute force."""

from __future__ import annotations

import random
from math import asin, cos, radians, sin, sqrt

import pytest
from pyspark.sql import functions as F

from venuelake.functions.geo import SPHERE_RADIUS_M
from venuelake.operators import globe, skew

NOWHERE = [(None, 3.0), (3.0, None), (float("nan"), 3.0), (3.0, float("inf")), (90.5, 3.0)]


def _metres(p, q):
    a = sin(radians(q[0] - p[0]) / 2) ** 2 + cos(radians(p[0])) * cos(radians(q[0])) * sin(radians(q[1] - p[1]) / 2) ** 2
    return 2 * SPHERE_RADIUS_M * asin(min(1.0, sqrt(a)))


def _points(seed, n):
    """Points near both poles, the date line and the zero point, some anywhere, and copies of one spot."""
    picks = random.Random(seed)
    near = lambda x: x + picks.uniform(-0.2, 0.2)
    kinds = [
        lambda: (min(90.0, near(89.9)), picks.uniform(-180, 180)), lambda: (max(-90.0, near(-89.9)), picks.uniform(-180, 180)),
        lambda: (near(10), near(picks.choice([-180, 180]))), lambda: (near(0), near(0)),
        lambda: (picks.uniform(-90, 90), picks.uniform(-180, 180)), lambda: (10.0, 180.0),
    ]
    return [kinds[i % len(kinds)]() for i in range(n)]


def _frame(spark, points, key, prefix):
    data = [(i, *map(float, p)) if None not in p else (i, *p) for i, p in enumerate([*points, *NOWHERE])]
    return spark.createDataFrame(data, f"{key} int, {prefix}latitude double, {prefix}longitude double")


@pytest.mark.parametrize("radius", [500.0, 20_000.0, 3_000_000.0, 20_100_000.0])
def test_pairs_equal_brute_force(spark, radius):
    a, b = _points(1, 120), _points(2, 90)
    joined = globe.within_distance(_frame(spark, a, "a", ""), _frame(spark, b, "b", "ta_"), radius)
    found = {(r.a, r.b): r.distance_m for r in joined.collect()}
    expected = {(i, j): _metres(p, q) for i, p in enumerate(a) for j, q in enumerate(b) if _metres(p, q) < radius}
    assert found.keys() == expected.keys() and len(expected) > 3
    assert all(found[pair] == pytest.approx(expected[pair], abs=1e-4) for pair in found)
    assert joined.count() == len(found)


@pytest.mark.parametrize("k", [1, 4, 200])
def test_nearest_equal_brute_force(spark, k):
    a, b = _points(3, 60), _points(4, 50)
    rows = globe.nearest_places(
        _frame(spark, a, "a", ""), _frame(spark, b, "b", "ta_"), k, "a", "b", start=1000.0, growth=10.0
    ).collect()
    found = {(r.a, r["rank"]): r.b for r in rows}
    expected = {}
    for i, p in enumerate(a):
        # Copies of one spot are a set of equal distances; the others differ by more than rounding.
        order = sorted((round(_metres(p, q), 5), j) for j, q in enumerate(b))[:k]
        expected |= {(i, n + 1): j for n, (_, j) in enumerate(order)}
    assert found == expected and len(rows) == len(found)


def test_empty_sides(spark):
    a, b = _frame(spark, _points(5, 6), "a", ""), _frame(spark, [], "b", "ta_")
    assert globe.within_distance(a, b, 1000.0).count() == 0
    assert globe.nearest_places(a, b, 3, "a", "b", start=1_000_000.0).count() == 0
    assert globe.nearest_places(a.limit(0), b, 3, "a", "b", start=1_000_000.0).count() == 0


def test_plan_has_no_nested_loop(spark):
    a, b = _frame(spark, _points(6, 30), "a", ""), _frame(spark, _points(7, 20), "b", "ta_")
    plan = globe.within_distance(a, b.withColumn("n", F.lit(1)), 1000.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def _even(spark, n, key, prefix):
    picks = random.Random(n)
    return _frame(spark, [(picks.uniform(10, 12), picks.uniform(10, 12)) for _ in range(n)], key, prefix)


def test_few_candidates_and_tasks_by_pairs(spark, monkeypatch):
    """A join of few rows and many pairs is not left to one task, and meets few rows that are no partners."""
    met = []
    join = skew.skew_join_both
    monkeypatch.setattr(globe, "skew_join_both", lambda *args, **options: met.append(join(*args, **options)) or met[0])
    monkeypatch.setattr(skew, "PART_PAIRS", 5_000, raising=False)
    pairs = globe.within_distance(_even(spark, 3000, "a", ""), _even(spark, 2900, "b", "ta_"), 10_000.0)
    tasks = pairs.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) > 40_000 and len(tasks) > 8
    assert met[0].count() < 4 * pairs.count()


def test_first_ring_narrows_where_places_are_dense(spark, monkeypatch):
    radii = []
    join = globe.within_distance
    monkeypatch.setattr(globe, "within_distance", lambda a, b, radius, *rest: radii.append(radius) or join(a, b, radius, *rest))
    a, b = _even(spark, 200, "a", ""), _even(spark, 3001, "b", "ta_")
    near = globe.nearest_places(a, b, 2, "a", "b", start=300_000.0)
    assert near.count() == 2 * 200 and radii[0] < 30_000
    firsts = {r.a: r.distance_m for r in near.where("rank = 1").collect()}
    brute = join(a, b, 300_000.0).groupBy("a").agg(F.min("distance_m").alias("d")).collect()
    assert firsts == {r.a: r.d for r in brute}
