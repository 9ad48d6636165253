from __future__ import annotations

import struct
import zlib
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from venuelake import schemas
from venuelake.operators import mutate
from venuelake.plans import app_data, graph, marts, recommend, serving, warehouse
from venuelake.sources import images as image_files
from venuelake.sources import tables as sources

SWIPE = "id long, userId long, imageId long, timestamp timestamp_ntz, swipeLeft int"


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def swipes_for(spark, shown):
    """Swipes that show image i as often as given."""
    data = [(n, n % 4, image, datetime(2024, 1, 1 + n % 9), n % 2) for image, times in shown.items() for n in range(times)]
    return spark.createDataFrame(data, SWIPE)


def expected_labels(shown):
    top = sorted(shown, key=lambda i: (-shown[i], i))
    bottom = sorted(shown, key=lambda i: (shown[i], i))
    out = {}
    for image in shown:
        high, low = top.index(image) + 1, bottom.index(image) + 1
        if high < 4 or low < 4:
            out[image] = f"top-{high}" if high < low else f"bot-{low}"
    return out


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 6, 7, 12])
def test_top_and_bottom_images(spark, count):
    shown = {i: 2 + i // 2 for i in range(1, count + 1)}
    images = spark.createDataFrame([(i, f"f{i}", i, 1) for i in shown], "id long, file string, dishId long, restaurantId long")
    dishes = spark.createDataFrame([(i, f"dish{i}") for i in shown], "id long, name string")
    got = marts.monthly_images(swipes_for(spark, shown), images, dishes).collect()
    assert {int(r["file"][1:]): r["rank"] for r in got} == expected_labels(shown)


def test_daily_ignores_null_swipes_and_unknown_images(spark):
    day = datetime(2024, 1, 1, 23, 59)
    swipes = spark.createDataFrame([(1, 1, 1, day, 1), (2, 1, 1, day, None), (3, 2, 1, day, 0), (4, 2, 9, day, 0)], SWIPE)
    images = spark.createDataFrame([(1, 5)], "id long, restaurantId long")
    assert tuples(marts.daily_stats(swipes, images)) == [(5, date(2024, 1, 1), 2, 2, 1)]


def test_bottom_not_top(spark):
    rows = [(1, "2024-01", "a", "top-1"), (1, "2024-01", "a", "bot-2"), (1, "2024-01", "b", "bot-1"), (2, "2024-01", "a", "bot-1")]
    df = spark.createDataFrame(rows, "restaurantId int, month string, file string, rank string")
    assert tuples(serving.bottom_not_top(df)) == [(1, "2024-01", "b", "bot-1"), (2, "2024-01", "a", "bot-1")]


def test_peers_without_numbers_form_a_group(spark):
    monthly = spark.createDataFrame(
        [("2024-01", 1, 1.0, 2.0, 3.0, 4, "n", 1)],
        "month string, restaurantId long, dly_avg_users double, dly_avg_impressions double, "
        "dly_avg_left_swipes double, days_active long, restaurant_name string, rank long",
    )
    cuisines = spark.createDataFrame([(1, "x", 0), (2, "x", 0), (3, "y", 1)], "restaurant_key long, cuisine string, cuisine_key int")
    rows = serving.peers(monthly, cuisines, 1)
    assert tuples(serving.peer_ranks(rows).select("restaurantId", "month", "crank")) == [(1, "2024-01", 1), (2, None, 1)]
    assert tuples(serving.peer_averages(rows).select("cuisine", "month", "restos")) == [("x", "2024-01", 1), ("x", None, 1)]


def test_details_from_files(spark, tmp_path):
    folder = str(tmp_path / "details")
    good = "[{'rating': 5, 'text': 'fine', 'time': 12}]"
    hours = "[{'close': {'day': 1, 'time': '2300'}, 'open': {'day': 0, 'time': '1300'}}]"
    write = lambda name, ddl, *rows: spark.createDataFrame(list(rows), ddl).write.parquet(f"{folder}/{name}")
    write("g_one", "reviews string, `opening_hours.periods` string", (good, hours))
    write("g_two", "`opening_hours.periods` string, other int", (hours, 1))
    write("g_three", "reviews string", ("broken [",))
    write("g_four", "other int", (1,))
    details = sources.read_venue_details(spark, folder)
    assert {r["google_key"] for r in details.collect()} == {"g_one", "g_two", "g_three"}
    reviews, periods, rejects = warehouse.parse_details(details)
    assert tuples(reviews) == [(5, "fine", 12, "one")]
    assert tuples(periods) == [(1, 1300, 2300, 0, "one"), (1, 1300, 2300, 0, "two")]
    assert tuples(rejects) == [("three", "reviews", "broken [")]
    restaurants = spark.createDataFrame([(4, " one "), (5, "two")], "key long, go_key string")
    built = warehouse.build_reviews(reviews, restaurants)
    assert built.columns == schemas.REVIEW_COLUMNS and built.first()["review_key"].startswith("g_")
    assert tuples(warehouse.build_opening_hours(periods, restaurants).select("ra_key", "day_key")) == [(5, 1)]


def test_venue_files(spark, tmp_path):
    folder = str(tmp_path / "venues")
    spark.createDataFrame([("A", "p1", 2.0, 41.0)], "name string, place_id string, price_level double, `geometry.location.lat` double").write.parquet(f"{folder}/x1")
    spark.createDataFrame([(41.0, "p1", "A"), (42.0, "p2", "B")], "`geometry.location.lat` double, place_id string, name string").write.parquet(f"{folder}/x2")
    got = sources.read_venue_a(spark, folder)
    assert tuples(got.select("place_id", "price_level", "latitude", "longitude")) == [("p1", 2.0, 41.0, None), ("p2", None, 42.0, None)]


def _png(width, height):
    chunk = lambda tag, data: struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))
    lines = b"".join(b"\x00" + bytes(range(3 * width)) for _ in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def test_images(spark, tmp_path):
    for name in ("g_abc_1.jpg", "g_abc_2.jpg", "plain.jpg"):
        (tmp_path / name).write_bytes(_png(3, 2))
    paths = image_files.image_paths(spark, str(tmp_path))
    catalog = image_files.image_catalog(paths)
    assert {r["google_key"] for r in catalog.collect()} == {"abc"} and catalog.count() == 2
    assert image_files.unreadable_image_names(paths).count() == 1
    restaurants = spark.createDataFrame([(4, "abc")], "key long, go_key string")
    assert warehouse.build_external_images(catalog, restaurants).select("image_id").distinct().count() == 2
    assert {tuple(r)[1:] for r in image_files.image_headers(spark, str(tmp_path)).collect()} == {(3, 2, 3)}
    vector = image_files.image_vectors(spark, str(tmp_path)).first()
    # Pixels come as blue, green, red.
    assert list(vector["pixels"][:6]) == [2, 1, 0, 5, 4, 3] and len(vector["pixels"]) == 18


def _app(spark):
    users = spark.createDataFrame(
        [(1, "u", "n", "Street 1\nBarcelona, 08001", "m", "2000-1-1", "p", 41.0, 2.0, "f", "d", ["x", "y"], "es", "o"),
         (2, "u", "n", "Street", "m", "bad", "p", 41.0, 2.0, "f", "d", None, "es", "o")],
        "id long, username string, name string, address string, mail string, birthdate string, phone string, homeLat double, "
        "homeLng double, sex string, createDate string, interestedCuisines array<string>, nationality string, occupation string",
    )
    dishes = spark.createDataFrame([(1, "d", "t", 5, ["salt", "salt"])], "id long, name string, description string, restaurantId long, ingredients array<string>")
    images = spark.createDataFrame([(1, "f", 1, 1, None, ["hot"]), (2, "g", 9, 1, None, [])], "id long, file string, dishId long, uploaderId long, uploadDt timestamp, tags array<string>")
    return users, dishes, images


def test_app_data(spark, tmp_path):
    users, dishes, images = _app(spark)
    landing, target = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    swipes = spark.createDataFrame([(1, 1, 1, datetime(2024, 1, 1), 0)], SWIPE)
    for name, df in {"users": users, "dishes": dishes, "images": images, "swipes": swipes}.items():
        sources.write_table(df, landing, name)
    assert app_data.load_app_data(spark, landing, target, date(2024, 1, 2)) == ["swipes"]
    read = lambda name: sources.read_table(spark, target, name)
    assert tuples(read("users").select("id", "city", "zipcode", "age")) == [(1, "Barcelona", "08001", 24), (2, None, None, None)]
    assert read("users_pii").columns == schemas.PERSONAL_COLUMNS and "mail" not in read("users").columns
    assert tuples(read("ingredients_in_dish")) == [(1, 1)] and tuples(read("user_cuisines")) == [(1, 1), (1, 2)]
    assert tuples(read("images").select("id", "restaurantId")) == [(1, 5)]
    assert app_data.load_app_data(spark, landing, target, date(2024, 1, 2)) == []
    sources.write_table(spark.createDataFrame([(5, "name")], "key long, restaurant_name string"), target, "restaurants")
    marts.build_marts(spark, target, str(tmp_path / "marts"))
    assert tuples(sources.read_table(spark, str(tmp_path / "marts"), "monthly_resto").select("restaurantId", "rank")) == [(5, 1)]


def test_graph_rules(spark):
    tables = {
        "restaurants": spark.createDataFrame([(1, "one")], "key long, restaurant_name string").select(
            "*", *[F.lit(None).cast("string").alias(c) for c in graph.NODES["Restaurant"][0][2][1:]]
        ),
        "images": spark.createDataFrame([(1, "a", 1, 7, None, 1), (2, "b", 1, 7, None, 2)], "id long, file string, dishId long, uploaderId long, uploadDt timestamp, restaurantId long"),
        "weekday": warehouse.weekdays(spark),
        "opening_hours": spark.createDataFrame([(1, 0, 1200, 1500), (1, 0, 1900, 2300), (9, 0, 1200, 1500), (1, None, 1, 2)], "ra_key long, day_key int, open_time int, close_time int"),
        "swipes": spark.createDataFrame([(1, 3, 1, datetime(2024, 1, 1), 0), (2, 3, 1, datetime(2024, 1, 1), 0), (3, 3, 8, datetime(2024, 1, 1), 1)], SWIPE),
    }
    nodes, edges = graph.build_graph(tables)
    # The image of an unknown restaurant has no edge; lunch and dinner of a day are one edge; swipes stay apart.
    assert tuples(edges["HAS_IMAGE"]) == [("1", "1")]
    assert tuples(edges["OPENING_HOURS"]) == [("1", "0", 1900, 2300)]
    assert edges["SWIPED"].count() == 3
    found = set(map(tuple, nodes.collect()))
    assert {("User", "7"), ("User", "3"), ("Images", "8"), ("Restaurant", "1")} <= found and ("Restaurant", "9") not in found
    projected = graph.projection(graph.edge_view(edges))
    assert projected.count() == 8 and {r["weight"] for r in projected.collect()} == {1.0}
    assert graph.likes_only(projected).count() == 6 and graph.likes_only(projected, True).count() == 4


def test_node_property_winner_is_one_row(spark):
    df = spark.createDataFrame([(1, "a", 9), (1, "b", None), (None, "c", 1)], "id int, name string, n int")
    assert tuples(graph.node_rows(df, ["id"], ["name", "n"])) == [(1, "b", None)]


def test_recommendation_choice(spark):
    swipes = spark.createDataFrame([(i, 1, i, datetime(2024, 1, i), 0) for i in range(1, 8)] + [(9, 1, 9, datetime(2024, 1, 9), 1)], SWIPE)
    images = spark.createDataFrame([(i, 100 + i) for i in range(1, 10)], "id long, restaurantId long")
    recent = recommend.recent_restaurants(swipes, images)
    assert {r["restaurantId"] for r in recent.collect()} == {103, 104, 105, 106, 107}
    similar = spark.createDataFrame([(103, 1, 0.2), (104, 2, 0.9), (105, 3, 0.5), (106, 4, 0.99), (107, 103, 1.0), (101, 5, 1.0)], "src long, dst long, score double")
    places = spark.createDataFrame([(n, 41.0 + n * 0.01, 2.0) for n in (1, 2, 3, 4, 5)] + [(103, 41.0, 2.0)], "restaurantId long, latitude double, longitude double")
    near = recommend.recommend_for(1, 41.0, 2.0, recent, similar, places).first()
    # 4 scores best but is not among the three nearest; 103 is a recent one; 5 starts elsewhere.
    assert (near["restaurantId"], near["score"]) == (2, 0.9)
    widely = places.where("restaurantId in (1, 2, 5)")
    assert recommend.recommend_for(1, 41.0, 2.0, recent, similar, widely, from_any=True).first()["restaurantId"] == 5


def test_image_choice(spark):
    swipes = spark.createDataFrame([(n, n, i, datetime(2024, 1, 1), int(n >= i)) for i in range(0, 8) for n in range(8)], SWIPE)
    images = spark.createDataFrame([(i, 1) for i in range(8)], "id long, restaurantId long")
    liked = recommend.liked_images(swipes, images)
    assert tuples(liked.select("imageId", "place")) == [(3, 5), (4, 4), (5, 3), (6, 2), (7, 1)]
    picks = {recommend.pick_image(swipes, images, seed).first()["imageId"] for seed in range(12)}
    assert picks <= {3, 4, 5, 6, 7} and len(picks) > 1


def test_new_value_keys(spark):
    target = spark.createDataFrame([(1, "x", 0), (1, "y", 1), (2, "x", 0)], "restaurant_key long, cuisine string, cuisine_key int")
    fresh = spark.createDataFrame([(1, "z"), (1, "x")], "restaurant_key long, cuisine string")
    kept = warehouse.update_values(target, fresh, "cuisine", "cuisine_key")
    assert tuples(kept) == [(1, "x", 0), (1, "z", -1), (2, "x", 0)]
    added = warehouse.update_values(target, fresh, "cuisine", "cuisine_key", new_value_keys=True)
    assert tuples(added) == [(1, "x", 0), (1, "z", 2), (2, "x", 0)]


def test_load_of_a_day_twice(spark):
    first = spark.createDataFrame([(1, 4.0, "google", 86400)], "ra_key long, rating double, source string, timestamp long")
    again = first.withColumn("rating", F.lit(4.5))
    next_day = again.withColumn("timestamp", F.lit(172800).cast("long"))
    once = warehouse.update_ratings(first, again)
    assert tuples(once) == [(1, 4.5, "google", 86400)]
    assert warehouse.update_ratings(once, next_day).count() == 2


def test_closed_restaurants_go_with_their_rows(spark):
    restaurants = spark.createDataFrame([(1, "a", 0, None), (2, "b", 0, None)], "key long, go_key string, closed int, closed_time timestamp")
    closed = spark.createDataFrame([("b",), ("b",)], "place_id string")
    flagged = mutate.mark_closed(restaurants, closed, datetime(2024, 1, 1))
    assert tuples(flagged.select("key", "closed")) == [(1, 0), (2, 1)]
    ratings = spark.createDataFrame([(1, 4.0), (2, 5.0)], "ra_key long, rating double")
    kept = warehouse.delete_closed({"restaurants": flagged, "rating": ratings})
    assert tuples(kept["restaurants"].select("key")) == [(1,)] and tuples(kept["rating"]) == [(1, 4.0)]


def test_restaurant_filter_reaches_the_scan(spark, tmp_path):
    rows = [(5, date(2024, 1, 1), 2, 2, 1)]
    daily = spark.createDataFrame(rows, "restaurantId long, date date, users long, impressions long, left_swipes long")
    sources.write_table(daily, str(tmp_path), "daily_resto")
    read = sources.read_table(spark, str(tmp_path), "daily_resto")
    plan = serving.of_restaurant(read, 5).select("users")._jdf.queryExecution().toString()
    assert "EqualTo(restaurantId,5)" in plan and "impressions" not in plan.split("ReadSchema:")[-1]


def test_daily_distinct_users_are_spread_over_users(spark):
    images = spark.createDataFrame([(1, 5)], "id long, restaurantId long")
    swipes = swipes_for(spark, {1: 4})
    plan = marts.daily_stats(swipes, images)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(restaurantId" in line]
    assert any("userId" in line for line in exchanges)


def test_table_listing_of_an_absent_folder(spark, tmp_path):
    from venuelake.sources import tables

    source, target = str(tmp_path / "source"), str(tmp_path / "none")
    spark.range(3).write.parquet(f"{source}/t")
    assert tables.table_names(spark, target) == [] and tables.copy_missing(spark, source, target) == ["t"]
    assert tables.copy_missing(spark, source, target) == [] and tables.table_names(spark, target) == ["t"]


def test_publish_reads_its_own_old_rows(spark, tmp_path):
    from venuelake.sources import lake

    folder = str(tmp_path)
    assert lake.current_path(spark, folder, "t") is None
    lake.publish(spark.range(3), folder, "t")
    for _ in range(2):
        lake.publish(lake.read_current(spark, folder, "t").selectExpr("id + 1 as id"), folder, "t")
    assert sorted(r.id for r in lake.read_current(spark, folder, "t").collect()) == [2, 3, 4]


def test_workers_find_the_package_from_another_folder(tmp_path):
    """Functions that run in Python workers need the package there: ``ship`` sends it along."""
    import subprocess
    import sys
    from pathlib import Path

    code = (
        f"import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})\n"
        "from venuelake.session import build_session, ship\n"
        "spark = build_session('away', 'local[2]', **{'spark.ui.enabled': 'false'}); ship(spark)\n"
        "from venuelake.operators.neighbors import nearest\n"
        "df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], 'id int, embedding array<double>')\n"
        "print('found', nearest(df, 1).count())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "found 2" in done.stdout, done.stderr[-2000:]


def test_jobs_leave_only_their_lake(spark):
    """Scratch tables of a job go with it; those of its caller stay."""
    from checks import queries
    from venuelake.session import scratch_path, written

    mine = written(spark.range(3), "mine")
    folder = Path(scratch_path(spark, "x")).parent
    before = {p.name for p in folder.iterdir()}
    lake = Path(queries._details_twice(spark, "/root/testdata/sf0.001"))
    assert {p.name for p in folder.iterdir()} - before == {lake.name} and mine.count() == 3
    assert any(lake.iterdir())
