from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from venuelake.functions.geo import with_utm
from venuelake.operators import mutate, skew, spatial
from venuelake.operators.neighbors import nearest
from venuelake.operators.normalize import normalize
from venuelake.operators.propagate import embed
from venuelake.operators.ranking import dense_keys, rank_rows, top_n


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows has one key, some have none."""
    picks = random.Random(1)
    keys = [7 if picks.random() < 0.33 else picks.choice([None, *range(50)]) for _ in range(3000)]
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, hot, many_hot_keys, how):
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 60, 2)] + [(7, "a"), (7, "b")], "k int, v string")
    spread, plain = skew.skew_join(hot, right, ["k"], how), hot.join(right, ["k"], how)
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(key, spread.collect())) == sorted(map(key, plain.collect()))


def test_skew_join_both_equals_join(spark, hot, many_hot_keys):
    right = hot.where("id % 5 = 0").select("k", F.col("id").alias("other"))
    assert rows(skew.skew_join_both(hot, right, ["k"])) == rows(hot.join(right, ["k"]))


def test_hot_keys_are_few_and_large(spark, hot, monkeypatch):
    assert skew.hot_keys(hot, ["k"]) == []
    monkeypatch.setattr(skew, "HOT_ROWS", 500)
    assert [r["k"] for r in skew.hot_keys(hot, ["k"])] == [7]
    assert "_salt" in skew.skew_join(hot, hot.select("k").distinct(), ["k"])._jdf.queryExecution().toString()


def test_parts_follow_the_rows_of_a_key(spark, monkeypatch):
    """A third of the rows in one key, all of them equal, and thousands of hot keys."""
    monkeypatch.setattr(skew, "HOT_ROWS", 4)
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    left = spark.range(60_000).selectExpr("case when id % 3 = 0 then -1 else id % 5000 end as k", "1 as v")
    hot = skew.hot_keys(left, ["k"])
    assert len(hot) == 5001 and max(r["_parts"] for r in hot) == 200
    right = left.select("k").distinct().withColumn("name", F.concat(F.lit("n"), "k"))
    joined = skew.skew_join(left, right, ["k"])
    assert joined.count() == 60_000
    salts = skew._spread(left.where("k = -1")).select(skew._part(F.lit(200)).alias("p")).groupBy("p").count()
    assert salts.count() == 200 and salts.agg(F.max("count")).first()[0] <= 200


def test_pairs_of_a_dense_cell_are_cut(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_PAIRS", 250_000)
    left = spark.range(5000).selectExpr("1 as k", "id as a")
    right = spark.range(5000).selectExpr("1 as k", "id as b")
    row = skew.pair_parts(left, right, ["k"]).first()
    assert row["_rows"] * row["_columns"] >= 100
    assert skew.skew_join_both(left, right, ["k"]).agg(F.count(F.lit(1)), F.sum("a")).first()[0] == 25_000_000


@pytest.mark.parametrize("group", [["g"], []])
def test_ranks_across_slices(spark, group):
    picks = random.Random(2)
    data = [(picks.choice([None, 1, 1, 1, 2]), picks.choice([None, *range(9)]), i) for i in range(2000)]
    df = spark.createDataFrame(data, "g int, v int, id int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank_rows(df, group, ["-v"], ["id"], "rn", "dr").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    window = Window.partitionBy(*group)
    expected = df.withColumn("rn", F.row_number().over(window.orderBy(F.desc("v"), "id"))).withColumn(
        "dr", F.dense_rank().over(window.orderBy(F.desc("v")))
    )
    assert {r["id"]: (r["rn"], r["dr"]) for r in got} == {r["id"]: (r["rn"], r["dr"]) for r in expected.collect()}


def test_dense_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    assert rows(dense_keys(df, "v", "key")) == [("a", 0), ("b", 1)]


def test_top_n_is_cut_before_the_shuffle(spark, hot):
    plan = top_n(hot, ["k"], ["-id"], 3)._jdf.queryExecution().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 3)], "k int, v string, w int")
    source = spark.createDataFrame([(2, "B", 20), (3, "C", 30), (None, "N", 40)], "k int, v string, w int")
    key = lambda r: (r[0] is None, r)
    whole = mutate.upsert(target, source, ["k"])
    assert sorted(map(tuple, whole.collect()), key=key) == sorted(
        [(1, "a", 1), (2, "B", 20), (3, "C", 30), (None, "n", 3), (None, "N", 40)], key=key
    )
    again = mutate.upsert(whole, source.where("k is not null"), ["k"])
    assert again.exceptAll(whole).count() == 0 and whole.exceptAll(again).count() == 0
    part = mutate.upsert(target, source, ["k"], ["v"])
    assert (2, "B", 2) in map(tuple, part.collect()) and part.count() == 5


def test_upsert_with_repeated_key_raises(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(5, "x"), (5, "y")], "k int, v string")
    changed = mutate.upsert(target, source, ["k"])
    for run in (changed.collect, changed.select("k").collect, changed.count):
        with pytest.raises(Exception, match="repeats a key"):
            run()


def test_upsert_with_different_constants_in_the_key_joins_by_the_rest(spark):
    """Two load days that Spark knows to differ must not make every row meet every other."""
    rows = lambda n, day: spark.range(n).select("id", (F.col("id") * 2).alias("v"), F.lit(day).cast("date").alias("day"))
    changed = mutate.upsert(rows(5, "2024-03-05"), rows(3, "2024-03-06"), ["id", "day"])
    assert "NestedLoop" not in changed._jdf.queryExecution().executedPlan().toString()
    assert changed.count() == 8 and changed.distinct().count() == 8
    again = mutate.upsert(changed, rows(3, "2024-03-06").withColumn("v", F.lit(-1).cast("long")), ["id", "day"])
    assert again.count() == 8 and again.where("v = -1").count() == 3


def test_upsert_reads_its_target_once(spark, tmp_path):
    spark.range(10).selectExpr("id as k", "id as v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(5, 15).selectExpr("id as k", "-id as v")
    plan = mutate.upsert(target.where("k is not null"), source, ["k"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FullOuter") == 1


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "v int")
    assert {r["v"] for r in mutate.delete_where(df, F.col("v") > 5).collect()} == {1, None}


def test_cascade_delete(spark, many_hot_keys):
    parent = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "key int, closed int")
    child = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (None, "n")], "ra_key int, v string")
    kept, children = mutate.cascade_delete(parent, "key", F.col("closed") == 1, {"child": (child, "ra_key")})
    assert {r["key"] for r in kept.collect()} == {2, 3}
    assert {r["v"] for r in children["child"].collect()} == {"y", "z", "n"}
    none, children = mutate.cascade_delete(parent, "key", F.lit(False), {"child": (child, "ra_key")})
    assert none.count() == 3 and children["child"].count() == 4


def test_assign_keys(spark):
    rows_ = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    existing = spark.createDataFrame([("b", 7)], "name string, key long")
    got = mutate.assign_keys(rows_, existing, ["name"], ["name"])
    assert {r["name"]: r["key"] for r in got.collect()} == {"a": 8, "b": 7, "c": 9}
    fresh = mutate.assign_keys(rows_, existing.limit(0), ["name"], ["name"])
    assert {r["name"]: r["key"] for r in fresh.collect()} == {"a": 0, "b": 1, "c": 2}


def test_normalize_and_join_back(spark, many_hot_keys):
    data = [(1, ["x", "y", "x"]), (2, []), (3, None), (4, ["y"])]
    df = spark.createDataFrame(data, "id int, tags array<string>")
    parent, values, bridge = normalize(df, "tags", "tag", "image")
    assert parent.columns == ["id"] and parent.count() == 4
    assert rows(values) == [("x", 1), ("y", 2)]
    back = bridge.join(values.withColumnRenamed("id", "tagId"), "tagId").select("imageId", "tag")
    assert rows(back) == [(1, "x"), (1, "y"), (4, "y")]


def _points(spark, seed, n, id_name, lat, lon):
    picks = random.Random(seed)
    # A third of the points stands in one spot.
    data = [
        (i, 41.39, 2.17) if picks.random() < 0.33 else (i, 41.39 + picks.uniform(0, 1e-3), 2.17 + picks.uniform(0, 1e-3))
        for i in range(n)
    ]
    return spark.createDataFrame(data, f"{id_name} int, {lat} double, {lon} double")


@pytest.mark.parametrize("zone", [31, 33])
def test_radius_join_equals_brute_force(spark, many_hot_keys, zone):
    a = _points(spark, 3, 300, "a", "latitude", "longitude")
    b = _points(spark, 4, 200, "b", "ta_latitude", "ta_longitude")
    xy = lambda df, lat, lon: {
        r[0]: (r["x"], r["y"]) for r in with_utm(df, F.col(lat), F.col(lon), "x", "y", zone).collect()
    }
    left, right = xy(a, "latitude", "longitude"), xy(b, "ta_latitude", "ta_longitude")
    expected = sorted(
        (i, j) for i, p in left.items() for j, q in right.items() if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 < 49
    )
    joined = spatial.within_radius(a, b, zone=zone)
    assert rows(joined.select("a", "b")) == expected
    outer = spatial.within_radius_left(a, b, "a", zone=zone)
    assert outer.where("b is not null").count() == len(expected)
    assert outer.select("a").distinct().count() == 300


def test_radius_join_plan_has_no_nested_loop(spark):
    a = _points(spark, 3, 30, "a", "latitude", "longitude")
    b = _points(spark, 4, 20, "b", "ta_latitude", "ta_longitude")
    plan = spatial.within_radius(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_radius_excludes_its_edge_and_null_points(spark):
    a = spark.createDataFrame([(1, 41.39, 2.17), (2, None, 2.17), (3, float("nan"), 2.17)], "a int, latitude double, longitude double")
    b = spark.createDataFrame([(1, 41.39, 2.17)], "b int, ta_latitude double, ta_longitude double")
    shifted = b.withColumn("ta_latitude", F.col("ta_latitude") + 0.00005)
    away = spatial.within_radius(a, shifted).first()["distance_m"]
    assert spatial.within_radius(a, shifted, radius=away).count() == 0
    assert spatial.within_radius(a, shifted, radius=away + 1e-6).count() == 1
    assert spatial.within_radius_left(a, shifted, "a").count() == 3


def _brute_neighbors(ids, vectors, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = np.round(unit @ unit.T, 6)
    out = set()
    for i, name in enumerate(ids):
        others = sorted((-cosine[i, j], ids[j]) for j in range(len(ids)) if j != i)
        out |= {(name, other, round(-score, 6)) for score, other in others[:k]}
    return out


@pytest.mark.parametrize("tiles", [{}, {"tile_rows": 25, "max_pivots": 6}, {"tile_rows": 12, "max_pivots": 3}])
def test_neighbors_equal_brute_force(spark, tiles, many_hot_keys):
    picks = np.random.default_rng(5)
    centers = picks.normal(size=(5, 8))
    vectors = np.concatenate([centers[picks.integers(0, 5, 150)] + picks.normal(scale=0.05, size=(150, 8)), np.tile(centers[0], (60, 1))])
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([*data, (999, [0.0] * 8)], "id int, embedding array<double>")
    got = {tuple(r) for r in nearest(df, 4, **tiles).collect()}
    assert got == _brute_neighbors([i for i, _ in data], vectors, 4)


@pytest.mark.parametrize("spread", [0.0005, 0.02, 1.0])
@pytest.mark.parametrize("pivots", [1, 6, 20])
def test_neighbors_of_tight_clusters(spark, spread, pivots):
    """Near copies whose similarities tie once rounded, in several cells."""
    picks = np.random.default_rng(11)
    vectors = picks.normal(size=6) + picks.normal(scale=spread, size=(300, 6))
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(data, "id int, embedding array<double>")
    got = {tuple(r) for r in nearest(df, 5, tile_rows=100 if pivots == 1 else 20, max_pivots=pivots).collect()}
    assert got == _brute_neighbors([i for i, _ in data], vectors, 5)


def test_neighbor_tree_has_levels_and_small_leaves(spark):
    from venuelake.operators import neighbors

    picks = np.random.default_rng(2).normal(size=(300, 6))
    units = picks / np.linalg.norm(picks, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(units)], "rep int, vec array<double>")
    rows, levels = neighbors._tree(df, 4, 15, 4)
    sizes = rows.groupBy("cell").count().collect()
    assert len(levels) >= 3 and sum(r["count"] for r in sizes) == 300 and max(r["count"] for r in sizes) <= 15


def test_neighbors_of_vectors_no_pivot_tells_apart(spark):
    """Vectors whose distances round to nothing are parted by a hash, so leaves stay small."""
    base = np.ones(4)
    data = [(i, [float(x) for x in base * (1 + i * 1e-16) + np.eye(4)[i % 4] * i * 1e-15]) for i in range(60)]
    df = spark.createDataFrame([*data, (99, [1.0, 0.0, 0.0, 0.0])], "id int, embedding array<double>")
    got = nearest(df, 3, tile_rows=20, max_pivots=4).collect()
    assert len(got) == 61 * 3 and all(r["cosine"] == 1.0 for r in got if r["id"] != 99)


def test_neighbors_of_few_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], "id int, embedding array<double>")
    assert {(r["id"], r["neighbor"]) for r in nearest(df, 5).collect()} == {(1, 2), (2, 1)}
    assert nearest(df.limit(0), 5).count() == 0


def test_embedding(spark, many_hot_keys):
    nodes = spark.createDataFrame([(n,) for n in "abcdz"], "node string")
    pairs = [("a", "b", 1.0), ("b", "c", 2.0), ("c", "d", 1.0), ("b", "c", 1.0)]
    edges = spark.createDataFrame(pairs + [(d, s, w) for s, d, w in pairs], "src string, dst string, weight double")
    run = lambda seed: {r["node"]: np.array(r["embedding"]) for r in embed(nodes, edges, 64, seed=seed).collect()}
    first, again, other = run(42), run(42), run(43)
    assert set(first) == set("abcdz") and not first["z"].any()
    assert all(np.allclose(first[n], again[n], atol=1e-6) for n in first)
    assert any(not np.allclose(first[n], other[n]) for n in first)
    # a and c see the same neighbour b in the first round.
    assert np.linalg.norm(first["a"]) > 0


def test_embedding_in_many_blocks_equals_one_and_keeps_one_round(spark, monkeypatch):
    """Blocks cut into parts give the same vectors; of the rounds' tables only the last one stays."""
    from venuelake.operators import propagate

    ends = F.concat(F.lit("n"), F.col("id") % 7), F.concat(F.lit("n"), F.col("id") * 13 % 60)
    edges = spark.range(400).select(ends[0].alias("src"), ends[1].alias("dst"), (F.col("id") % 3 + 1.0).alias("weight"))
    edges = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    nodes = edges.select(F.col("src").alias("node")).distinct()
    vectors = lambda df: {r["node"]: np.array(r["embedding"]) for r in df.collect()}
    whole = vectors(embed(nodes, edges, 32))
    monkeypatch.setattr(propagate, "BLOCK_EDGES", 40)
    monkeypatch.setattr(propagate, "PART_EDGES", 25)
    cut = embed(nodes, edges, 32)
    folder = Path(cut.inputFiles()[0].removeprefix("file:")).parent.parent
    rounds = len(list(folder.glob("embedding-*")))
    again = vectors(embed(nodes, edges, 32))
    assert len(list(folder.glob("embedding-*"))) == rounds + 1
    assert whole.keys() == again.keys() and all(np.allclose(whole[n], again[n], atol=1e-6) for n in whole)
    assert any(whole[n].any() for n in whole)


def test_neighbors_send_a_row_once_to_a_bundle_of_leaves(spark, monkeypatch):
    """Small leaves must not make a row travel to each of them."""
    from venuelake.operators import neighbors

    vectors = np.random.default_rng(5).normal(size=(400, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id int, embedding array<double>")
    sent, compared = [], neighbors._compared
    monkeypatch.setattr(neighbors, "_compared", lambda queries, routes, *rest: (sent.append(routes.count()), compared(queries, routes, *rest))[1])
    got = {(r["id"], r["neighbor"]) for r in nearest(df, 3, tile_rows=20, max_pivots=4).collect()}
    assert 400 <= sent[0] <= 4 * 400
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = np.round(units @ units.T, neighbors.DIGITS)
    np.fill_diagonal(cosine, -np.inf)
    best = np.argsort(-cosine, axis=1, kind="stable")[:, :3]
    assert got == {(i, int(j)) for i in range(400) for j in best[i]}


def test_rows_of_a_table_are_numbered_with_one_shuffle(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.lit("wide").alias("y"))
    numbered = rank_rows(df, [], ["-x"], [], row_number="n")
    assert numbered.where("n <> 5000 - x").count() == 0 and numbered.count() == 5000
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    scan = numbered.inputFiles()
    assert scan and "SortMergeJoin" not in plan and plan.count("Window") <= 2


def test_what_is_known_of_a_neighbor_trees_rows_does_not_grow_with_its_levels(spark):
    from venuelake.operators import neighbors

    picks = np.random.default_rng(3).normal(size=(200, 4))
    units = picks / np.linalg.norm(picks, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(units)], "rep int, vec array<double>")
    rows, levels = neighbors._tree(df, k=2, tile_rows=10, fanout=3, frame_rows=20)
    assert len(levels) > 2
    assert [x._jdf.queryExecution().optimizedPlan().constraints().size() for x in (rows, *levels)] == [0] * (len(levels) + 1)


@pytest.mark.parametrize("loose", [None, 1.0, 1.3])
def test_comparison_makes_few_double_products(loose, monkeypatch):
    """Of 400 others only those that may be among a row's five are compared in double precision."""
    import pyarrow as pa

    from venuelake.operators import neighbors

    vectors = np.random.default_rng(4).normal(size=(400, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = np.round(vectors @ vectors.T, 6)
    np.fill_diagonal(cosine, -np.inf)
    rows = pa.table({"rep": np.arange(400), "vec": pa.array(list(vectors), pa.list_(pa.float64())), "cell": np.arange(400) % 30})
    limits = None if loose is None else loose * np.sqrt(2 - 2 * np.sort(cosine, axis=1)[:, -5])
    compared, einsum = [], np.einsum
    monkeypatch.setattr(neighbors.np, "einsum", lambda how, a, b: compared.append(len(a)) or einsum(how, a, b))
    got = neighbors._best(rows, rows, 5, limits).to_pylist()
    order = np.argsort(-cosine, axis=1, kind="stable")[:, :5]
    assert [(r["rep"], r["other"], r["cosine"]) for r in got] == [(i, j, cosine[i, j]) for i in range(400) for j in order[i]]
    assert 2000 <= sum(compared) < 20 * 400 + 400


def test_a_neighbor_tree_has_no_more_cells_than_its_rows_ask_for(spark):
    from venuelake.operators import neighbors

    picks = np.random.default_rng(6).normal(size=(300, 4))
    units = picks / np.linalg.norm(picks, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(units)], "rep int, vec array<double>")
    rows, levels = neighbors._tree(df, k=2, tile_rows=100, fanout=64, frame_rows=100)
    assert levels[0].count() == 6 and rows.select("bundle").distinct().count() < 12


def test_only_nodes_with_edges_take_part_in_a_round(spark):
    """Nodes without edges are not in the rounds' tables, and a round's sums go with it."""
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "src string, dst string, weight double")
    nodes = spark.range(50).select(F.concat(F.lit("z"), "id").alias("node")).union(edges.select("src"))
    got = embed(nodes, edges, 16)
    files = [Path(f.removeprefix("file:")) for f in got.inputFiles()]
    tables = {f.parent for f in files if f.parent.name.startswith("embedding-")}
    assert len(tables) == 1 and spark.read.parquet(str(*tables)).count() == 2
    assert not list(next(iter(tables)).parent.glob("sums-*"))
    rows = {r["node"]: r["embedding"] for r in got.collect()}
    assert len(rows) == 52 and any(rows["a"]) and not any(any(rows[f"z{i}"]) for i in range(50))
