from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from venuelake.functions import dates, geo, numbers, text


def values(spark, column, inputs, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {ddl}")
    return [row[0] for row in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_reviews(spark):
    records = [
        "[{'rating': 5, 'text': 'fine', 'time': 12}\n {'rating': 4, 'text': \"it's None and True\", 'x': None, "
        "'y': True, 'time': 13}]",
        r"""[{'rating': 5, 'text': 'it\'s "ok": None, True', 'time': 12}]""",
        "[{'rating': 5, 'text': 'it's bare, 'yes'', 'time': 12}\n {'rating': 3, 'text': 'say \"hi\"', 'time': 9}]",
        "[{'rating': 5, 'text': 'a}\\n{b', 'time': 1}]",
        "[{'rating': 5, 'te",
        None,
        "no records",
    ]
    got = values(spark, text.parse_reviews, records)
    plain = [None if rows is None else [tuple(r) for r in rows] for rows in got]
    assert plain == [
        [(5, "fine", 12), (4, "it's None and True", 13)],
        [(5, 'it\'s "ok": None, True', 12)],
        [(5, "it's bare, 'yes'", 12), (3, 'say "hi"', 9)],
        [(5, "a}\n{b", 1)],
        None,
        None,
        None,
    ]


def test_long_reviews_do_not_exhaust_the_stack(spark):
    for word in ("abc None ", "ab'c None "):
        record = "[{'rating': 5, 'text': '" + word * 100_000 + "', 'x': None, 'time': 12}]"
        assert values(spark, text.parse_reviews, [record])[0][0]["text"] == word * 100_000


def test_hours(spark):
    both = "[{'close': {'day': 0, 'time': '2300'}, 'open': {'day': 0, 'time': '1300'}}\n {'open': {'day': 1, 'time': '0000'}}]"
    got = values(spark, text.parse_hours, [both, "[{'close'", None])
    assert got[1:] == [None, None]
    first, second = got[0]
    assert (first["close"]["day"], first["open"]["time"], first["close"]["time"]) == (0, "1300", "2300")
    assert second["close"] is None and second["open"]["day"] == 1


def test_levels_and_keys(spark):
    assert values(spark, text.price_level, ["$", "$$ - $$$", "$$$$", "", None]) == [2, 3, 4, None, None]
    assert values(spark, text.award_stars, ["Bib Gourmand", "1 MICHELIN Star", "Green", None]) == [-1, 1, None, None]
    urls = ["http://x/Restaurant_Review-g123-d456-Reviews", "http://x/none"]
    assert values(spark, text.key_from_url, urls) == ["g123-d456", ""]
    names = ["/a/g_xyz_1.jpg", "/a/g_x_y_12.jpg", "/a/plain.jpg", "/a/g_x_1.png"]
    assert values(spark, text.key_from_image_name, names) == ["xyz", "x_y", None, None]
    assert values(spark, text.split_values, ["Italian, Pizza , Italian", None]) == [["Italian", "Pizza", "Italian"], None]


def test_address(spark):
    addresses = ["Street 1\nBarcelona, 08001", "Street 1", "Street 1\nBarcelona", None]
    assert values(spark, lambda a: text.address_part(a, 0), addresses) == ["Barcelona", None, "Barcelona", None]
    assert values(spark, lambda a: text.address_part(a, 1), addresses) == ["08001", None, None, None]


def test_compact_number(spark):
    inputs = [0.0, 999.6, 1000.0, 12499.0, 12500.0, 2500.0, 3500.0, -1500.0, -0.4, 5e6, 7e12, float("nan"), None]
    shown = ["0", "1000", "1 K", "12 K", "12 K", "2 K", "4 K", "-2 K", "-0", "5 M", "7 T", "", None]
    assert values(spark, text.compact_number, inputs, "double") == shown


def test_dates(spark):
    assert values(spark, dates.review_time, ["January 5, 2020", "yesterday", None]) == [1578182400, None, None]
    age = lambda b: dates.age(b, F.lit(date(2024, 3, 5)))
    assert values(spark, age, ["2000-3-5", "2000-3-06", "unknown", None]) == [24, 23, None, None]
    buckets = values(spark, dates.age_bucket, [0, 4, 5, 94, 95, 99, 120, -3, None], "int")
    assert buckets == [0, 0, 1, 18, 19, 19, 19, None, None]
    assert values(spark, dates.age_bucket, [float("nan"), 7.0], "double") == [20, 1]


@pytest.mark.parametrize("overnight,expected", [(False, [True, False, True, False]), (True, [True, True, True, False])])
def test_open_now(spark, overnight, expected):
    rows = [(900, 1400), (2000, 1300), (1215, 1300), (1300, 1400)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, o int, c int").orderBy("i")
    found = df.select(dates.open_now(F.col("o"), F.col("c"), F.lit(1215), overnight)).collect()
    assert [r[0] for r in found] == expected


def test_numbers(spark):
    assert values(spark, numbers.is_number, [1.0, float("nan"), None], "double") == [True, False, False]
    first = lambda v: numbers.first_number(v, F.lit(2))
    assert values(spark, first, [1.0, float("nan"), None], "double") == [1.0, 2.0, 2.0]


def test_projection_and_distance(spark):
    point = spark.createDataFrame([(41.3851, 2.1734)], "lat double, lon double")
    row = geo.with_utm(point, F.col("lat"), F.col("lon"), "x", "y", 31).first()
    assert row["x"] == pytest.approx(430887.56, abs=0.01)
    assert row["y"] == pytest.approx(4581837.85, abs=1.0)
    # In zone 33 the same ground distance is longer by the scale factor of the map.
    pair = spark.createDataFrame([(41.3851, 2.1734), (41.3852, 2.1734)], "lat double, lon double")
    near, far = (
        [r["y"] for r in geo.with_utm(pair, F.col("lat"), F.col("lon"), "x", "y", z).orderBy("lat").collect()]
        for z in (31, 33)
    )
    assert (far[1] - far[0]) / (near[1] - near[0]) > 1.0
    metres = point.select(geo.distance_m(F.col("lat"), F.col("lon"), F.lit(41.3951), F.lit(2.1734))).first()[0]
    assert metres == pytest.approx(1113.2, abs=1.0)
