"""Warehouse tables from matched venues, reviews, opening hours, awards and images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuelake import schemas
from venuelake.functions import dates, numbers, text
from venuelake.functions.dates import Moment
from venuelake.operators import mutate, spatial
from venuelake.operators.normalize import explode_values, keyed_values
from venuelake.operators.ranking import rank_rows
from venuelake.operators.skew import skew_join
from venuelake.session import drop_scratch, durable, own_scratch, written

#: Columns of matched venues, beside their keys, that restaurants, their values and ratings are made of.
MATCHED = [
    "name", "vicinity", "latitude", "longitude", "price_level", "rating", "ta_website", "ta_email", "ta_telephone",
    "ta_price", "ta_rating", "ta_cuisine", "ta_meals",
]


def prepare_venue_b(df: DataFrame, prefix: str = schemas.SOURCE_B_PREFIX) -> DataFrame:
    """Prefix every column and take the venue's key from its URL."""
    prefixed = df.toDF(*[prefix + c for c in df.columns])
    return prefixed.withColumn(f"{prefix}id", text.key_from_url(F.col(f"{prefix}url")))


def match_venues(
    venues_a: DataFrame, venues_b: DataFrame, zone: int = 31, columns: list[str] | None = None
) -> DataFrame:
    """Venues of both sources that stand in the same place, with a dense ``key``.

    The key follows the sort order of the two source keys, so it is the same in every run. ``columns`` are those
    to carry beside the source keys, their distance and the URL, by default all.
    """
    matched = spatial.within_radius(venues_a, venues_b, zone=zone).drop("business_status")
    if columns is not None:
        matched = matched.select("place_id", "ta_id", "distance_m", "ta_url", *columns)
    pairs = rank_rows(matched, [], ["place_id", "ta_id", "distance_m"], ["ta_url"], row_number="key")
    return pairs.withColumn("key", F.col("key") - 1)


def build_restaurants(matched: DataFrame) -> DataFrame:
    return matched.select(
        "key",
        F.col("place_id").alias("go_key"),
        F.col("ta_id").alias("ta_key"),
        F.col("name").alias("restaurant_name"),
        F.col("vicinity").alias("address"),
        "latitude",
        "longitude",
        F.col("ta_website").alias("website"),
        F.col("ta_email").alias("email"),
        F.col("ta_telephone").alias("telephone"),
        numbers.first_number(F.col("price_level"), text.price_level(F.col("ta_price"))).alias("price"),
        F.lit(0).alias("closed"),
        F.lit(None).cast("timestamp").alias("closed_time"),
    )


def _multi_values(matched: DataFrame, column: str, name: str) -> DataFrame:
    rows = matched.select(F.col("key").alias("restaurant_key"), column)
    return explode_values(rows, text.split_values(F.col(column)), ["restaurant_key"], name)


def build_cuisines(matched: DataFrame) -> DataFrame:
    rows = _multi_values(matched, "ta_cuisine", "cuisine")
    return keyed_values(rows, "cuisine", "cuisine_key").select("restaurant_key", "cuisine", "cuisine_key")


def build_meals(matched: DataFrame) -> DataFrame:
    rows = _multi_values(matched, "ta_meals", "meals")
    return keyed_values(rows, "meals", "meal_key").select("restaurant_key", "meals", "meal_key")


def build_long_reviews(matched: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews of the external table, joined to venues by URL."""
    venues = matched.select(F.col("key").alias("ra_key"), F.col("ta_url").alias("url_restaurant"))
    return skew_join(reviews, venues, ["url_restaurant"]).select(
        "ra_key",
        F.concat(F.lit("t_"), F.col("_c0")).alias("review_key"),
        dates.review_time(F.col("date")).alias("time"),
        F.col("rating_review").alias("rating"),
        "sample",
        F.col("review_full").alias("text"),
        F.lit(schemas.SOURCE_B).alias("source"),
    )


def build_michelin(matched: DataFrame, awards: DataFrame, location: str) -> DataFrame:
    """Stars of the awarded venues of one location, joined by venue name."""
    local = awards.where(F.col("Location") == location).select(
        F.col("Name").alias("name"), text.award_stars(F.col("Award")).alias("number_of_stars")
    )
    venues = matched.select(F.col("key").alias("ra_key"), "name")
    return skew_join(venues, local, ["name"]).select(
        "ra_key", "number_of_stars", F.lit(None).cast("int").alias("year")
    )


def build_ratings(matched: DataFrame, as_of: Moment = None) -> DataFrame:
    """Both sources' ratings of the load day, one row per venue and source."""
    sides = [("rating", schemas.SOURCE_A), ("ta_rating", schemas.SOURCE_B)]
    rated = F.array(*[F.struct(F.col(c).alias("rating"), F.lit(s).alias("source")) for c, s in sides])
    return (
        matched.select(F.col("key").alias("ra_key"), F.inline(rated))
        .where(numbers.is_number(F.col("rating")))
        .withColumn("timestamp", dates.load_day(as_of))
    )


def parse_details(details: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(reviews, opening periods, rejects)`` from the record-list text of venue details.

    The text is parsed once and written. Text that cannot be read goes to the rejects, with the
    column it stood in.
    """
    parsed = durable(
        details.select(
            text.strip_prefix(F.col("google_key")).alias("google_key"),
            "reviews",
            "opening_periods",
            text.parse_reviews(F.col("reviews")).alias("_reviews"),
            text.parse_hours(F.col("opening_periods")).alias("_periods"),
        )
    )
    reviews = parsed.select("google_key", F.inline("_reviews")).select(
        F.col("rating").alias("google_rating"), "text", "time", "google_key"
    )
    periods = parsed.select("google_key", F.explode("_periods").alias("p")).select(
        F.col("p.close.day").alias("day"),
        F.col("p.open.time").try_cast("int").alias("open_time"),
        F.col("p.close.time").try_cast("int").alias("close_time"),
        F.col("p.open.day").alias("open_day"),
        "google_key",
    )
    unread = lambda column, result: F.when(
        F.col(column).isNotNull() & F.col(result).isNull(),
        F.struct(F.lit(column).alias("column"), F.col(column).alias("text")),
    )
    failed = F.array_compact(F.array(unread("reviews", "_reviews"), unread("opening_periods", "_periods")))
    return reviews, periods, parsed.select("google_key", F.inline(failed))


def build_reviews(reviews: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Parsed reviews in the layout of the long reviews; keys from the venue's trimmed key.

    The review key is a hash of venue key, time and text: unlike a row number it stays
    the same when more reviews are appended.
    """
    venues = restaurants.select(F.col("key").alias("ra_key"), F.trim("go_key").alias("google_key"))
    trimmed = reviews.withColumn("google_key", F.trim("google_key"))
    identity = F.sha2(F.concat_ws("\x1f", "ra_key", "time", "google_rating", "text"), 256)
    return skew_join(trimmed, venues, ["google_key"], counted=trimmed.select("google_key")).select(
        "ra_key",
        F.concat(F.lit("g_"), identity).alias("review_key"),
        "time",
        F.col("google_rating").cast("string").alias("rating"),
        F.lit(None).cast("string").alias("sample"),
        "text",
        F.lit(schemas.SOURCE_A).alias("source"),
    )


def build_opening_hours(periods: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Opening periods by restaurant; the weekday is that of the closing time."""
    venues = restaurants.select(F.col("key").alias("ra_key"), F.col("go_key").alias("google_key"))
    return periods.join(venues, "google_key").select(
        "ra_key", F.col("day").alias("day_key"), "open_time", "close_time", "open_day"
    )


def weekdays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(schemas.WEEKDAYS)), "day_key int, weekday string")


def build_external_images(catalog: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Image paths by restaurant; the id is a hash of the path, so appending is repeatable."""
    venues = restaurants.select(F.col("key").alias("ra_key"), F.col("go_key").alias("google_key"))
    return skew_join(catalog, venues, ["google_key"]).select(
        F.sha2(F.concat_ws("\x1f", "image_file", "ra_key"), 256).alias("image_id"), "ra_key", "image_file", "source"
    )


def match_for_update(venues_a: DataFrame, venues_b: DataFrame, restaurants: DataFrame, zone: int = 31) -> DataFrame:
    """Open venues with their partners in the second source, each pair with the key it stands for.

    A pair that had a key keeps it. Of a venue's other pairs, in order of distance, each takes
    one of the venue's keys whose pair is gone, in order of the key, and the rest get new keys.
    So an update leads to the same pairs as a new build. Venues without a partner stay as one
    row each; a key for which there is no pair left is not in the result.
    """
    still_open = venues_a.where(F.col("business_status") != schemas.CLOSED_STATUS)
    # The pairs are written once, in any order; their order is found from the columns it needs.
    near = spatial.within_radius_left(still_open, venues_b, "place_id", zone=zone)
    rows = written(near.withColumn("_row", F.monotonically_increasing_id()), "near")
    order = ["place_id", "no_distance", "distance_m", "ta_id", "ta_url", "_row"]
    narrow = rows.select("place_id", F.col("distance_m").isNull().alias("no_distance"), *order[2:])
    ends = rank_rows(narrow, [], order, [], row_number="_pair").select("place_id", "ta_id", "_row", "_pair")
    known = restaurants.select(F.col("go_key").alias("place_id"), F.col("ta_key").alias("ta_id"), "key").dropDuplicates(["key"])
    # Equal pairs and equal keys of a pair meet one to one, in their order.
    same = ["place_id", "ta_id"]
    nth = lambda df, by, order: df.withColumn("_nth", F.row_number().over(Window.partitionBy(*by).orderBy(order)))
    old = nth(known, same, "key").toDF("_place_id", "_ta_id", "_key", "_old_nth")
    equal = [
        F.col("place_id") == F.col("_place_id"), F.col("ta_id").eqNullSafe(F.col("_ta_id")), F.col("_nth") == F.col("_old_nth")
    ]
    stayed = written(nth(ends.drop("_row"), same, "_pair").join(old, equal).select(F.col("_pair").alias("_kept"), "_key"), "stayed")
    free = nth(known.join(stayed, F.col("key") == F.col("_key"), "left_anti"), ["place_id"], "key")
    open_rows = nth(ends.drop("_row").join(stayed, F.col("_pair") == F.col("_kept"), "left_anti"), ["place_id"], "_pair")
    moved = open_rows.join(free.select("place_id", "_nth", "key"), ["place_id", "_nth"], "left").select("_pair", "key")
    taken = written(moved, "taken")
    new = rank_rows(taken.where("key is null").select("_pair"), [], ["_pair"], [], row_number="_place")
    largest = F.coalesce(restaurants.agg(F.max("key")).scalar(), F.lit(-1))
    keys = stayed.toDF("_pair", "key").unionByName(taken.where("key is not null")).unionByName(
        new.select("_pair", (F.col("_place") + largest).alias("key"))
    )
    of_row = ends.select("_row", "_pair").join(keys, "_pair").select("_row", "key")
    return rows.join(of_row, "_row").drop("_row")


def update_warehouse(
    tables: dict[str, DataFrame], venues_a: DataFrame, venues_b: DataFrame,
    as_of: Moment = None, zone: int = 31, new_value_keys: bool = False,
) -> dict[str, DataFrame]:
    """New content of restaurants, cuisines, meals and rating after a load of both sources.

    Venues reported closed are flagged; open ones are matched again, keep their keys and
    are upserted. A key of an open venue whose pair is gone is deleted. Cuisines and meals of
    open venues are replaced, so those of a lost partner go; ratings are kept per day. "Now"
    is read once.
    """
    as_of = dates.resolved(as_of)
    closed = venues_a.where(F.col("business_status") == schemas.CLOSED_STATUS).select("place_id")
    # Only what the tables are made of is matched.
    own_a = venues_a.select("place_id", "business_status", *[c for c in MATCHED if not c.startswith(schemas.SOURCE_B_PREFIX)])
    own_b = venues_b.select("ta_id", "ta_url", "ta_latitude", "ta_longitude", *[c for c in MATCHED if c.startswith(schemas.SOURCE_B_PREFIX)])
    spark = venues_a.sparkSession
    with own_scratch(spark) as folder:
        pairs = match_for_update(own_a, own_b, tables["restaurants"], zone)
    matched = written(pairs, "matched")
    drop_scratch(spark, folder)
    live = matched.select(F.col("place_id").alias("go_key")).distinct()
    of_open = tables["restaurants"].join(live, "go_key", "left_semi").select("key")
    gone = of_open.join(matched.select("key"), "key", "left_anti")
    updated = written(of_open.union(matched.select("key")).distinct(), "updated")
    flagged = mutate.mark_closed(mutate.delete_keys(tables["restaurants"], "key", written(gone, "gone")), closed, as_of)
    return {
        "restaurants": mutate.upsert(flagged, build_restaurants(matched), ["key"]),
        "cuisines": update_values(
            tables["cuisines"], _multi_values(matched, "ta_cuisine", "cuisine"), "cuisine", "cuisine_key",
            new_value_keys, updated,
        ),
        "meals": update_values(
            tables["meals"], _multi_values(matched, "ta_meals", "meals"), "meals", "meal_key", new_value_keys, updated
        ),
        "rating": update_ratings(tables["rating"], build_ratings(matched, as_of)),
    }


def update_values(
    target: DataFrame, rows: DataFrame, column: str, key: str, new_value_keys: bool = False,
    updated: DataFrame | None = None,
) -> DataFrame:
    """Replace the values of venues; a value no venue had gets the unknown key.

    ``updated`` has the keys of the venues, by default those in ``rows``: a venue of it without
    a row loses its values. With ``new_value_keys`` an unknown value gets the next free key instead.
    """
    known = target.select(column, key)
    dictionary = mutate.append_new_keys(known, rows, column, key) if new_value_keys else known
    keyed = mutate.lookup_key(rows, dictionary, column, key)
    if updated is None:
        return mutate.replace_groups(target, keyed, ["restaurant_key"])
    kept = mutate.delete_keys(target, "restaurant_key", updated)
    return kept.unionByName(keyed.select(*target.columns))


def update_ratings(target: DataFrame, ratings: DataFrame) -> DataFrame:
    """Ratings by venue, source and day: a second load of a day replaces the first."""
    return mutate.upsert(target, ratings, ["ra_key", "source", "timestamp"])


def update_opening_hours(target: DataFrame, hours: DataFrame) -> DataFrame:
    """All periods of a venue that is loaded again are replaced.

    So venues that never close (no closing day) and periods that close on one day need no key
    of their own, and a second load changes nothing.
    """
    return mutate.replace_groups(target, hours.distinct(), ["ra_key"])


def append_rows(target: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """``target`` and the rows of ``more`` whose key it lacks, each once: a repeat adds none."""
    fresh = more.join(target.select(key), key, "left_anti").dropDuplicates([key])
    return target.unionByName(fresh.select(*target.columns))


def delete_closed(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """New content of all tables without the closed restaurants and what hangs on them."""
    children = {
        name: (tables[name], column)
        for name, column in schemas.RESTAURANT_CHILDREN.items()
        if name in tables
    }
    kept, rest = mutate.cascade_delete(tables["restaurants"], "key", F.col("closed") == 1, children)
    return {"restaurants": kept, **rest}
