"""Similar restaurants, the next restaurant for a user, and the image to show for it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelake import schemas
from venuelake.functions.dates import Moment, hour_minute, open_now, weekday_name
from venuelake.functions.geo import distance_m
from venuelake.functions.numbers import ratio
from venuelake.operators.neighbors import nearest
from venuelake.operators.propagate import embed
from venuelake.operators.ranking import top_n
from venuelake.operators.skew import skew_join
from venuelake.plans.graph import likes_only, projection, projection_nodes
from venuelake.session import durable

RECENT_LIKES = 5
NEAREST_PLACES = 3
BEST_IMAGES = 5
SIMILAR_VENUES = 10


def similar_restaurants(nodes: DataFrame, edges: DataFrame, k: int = SIMILAR_VENUES, **options: object) -> DataFrame:
    """``USERS_ALSO_LIKED`` edges ``(src, dst, score)`` between restaurants.

    Embeds the graph of likes and joins each restaurant to its nearest ones; the score
    is the cosine brought to 0…1.
    """
    members = projection_nodes(nodes)
    vectors = embed(members, likes_only(projection(edges)), **options)
    prefix = "Restaurant:"
    of_restaurants = vectors.where(F.col("node").startswith(prefix)).select(
        F.substr("node", F.lit(len(prefix) + 1)).alias("id"), "embedding"
    )
    return nearest(of_restaurants, k).select(
        F.col("id").alias("src"), F.col("neighbor").alias("dst"), ((1 + F.col("cosine")) / 2).alias("score")
    )


def recent_restaurants(
    swipes: DataFrame, images: DataFrame, n: int = RECENT_LIKES, user: int | None = None
) -> DataFrame:
    """``(userId, restaurantId)`` of each user's latest likes; a restaurant may repeat.

    With ``user`` only that one's swipes are read.
    """
    if user is not None:
        swipes = swipes.where(F.col("userId") == user)
    likes = swipes.where(F.col("swipeLeft") == 0).select("id", "userId", "imageId", "timestamp")
    owners = images.select(F.col("id").alias("imageId"), "restaurantId").where("restaurantId is not null")
    placed = skew_join(likes, owners, ["imageId"], counted=swipes)
    return top_n(placed, ["userId"], ["-timestamp", "-id"], n).select("userId", "restaurantId")


def open_places(
    restaurants: DataFrame, hours: DataFrame, weekday: DataFrame, as_of: Moment = None, overnight: bool = False
) -> DataFrame:
    """``(restaurantId, latitude, longitude)`` of the restaurants open at ``as_of``."""
    today = weekday.where(F.col("weekday") == weekday_name(as_of)).select("day_key")
    running = hours.where(open_now(F.col("open_time"), F.col("close_time"), hour_minute(as_of), overnight))
    ids = running.join(today, "day_key").select(F.col("ra_key").alias("restaurantId")).distinct()
    places = restaurants.select(F.col("key").alias("restaurantId"), "latitude", "longitude")
    return places.join(ids, "restaurantId")


def _choose(candidates: DataFrame, places: DataFrame, locations: DataFrame) -> DataFrame:
    """From ``(userId, restaurantId, score)``: of the three nearest places the best one."""
    at = locations.select("userId", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    metres = distance_m(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon"))
    ranked = (
        skew_join(durable(candidates), places, ["restaurantId"]).join(at, "userId").withColumn("distance", metres)
    )
    close = top_n(ranked, ["userId"], ["distance", "-score", "restaurantId"], NEAREST_PLACES, "_near").drop("_near")
    best = top_n(close, ["userId"], ["-score", "distance", "restaurantId"], 1, "_best")
    return best.select("userId", "restaurantId", "score", "distance")


def recommend(
    recent: DataFrame, similar: DataFrame, places: DataFrame, locations: DataFrame
) -> DataFrame:
    """One restaurant per user: similar to recent ones but not one of them, open and near.

    ``similar`` is ``(src, dst, score)``. A restaurant that several recent ones lead to
    counts once for each, as different paths do.
    """
    # A user has a handful of recent places, and each of them a handful of similar ones.
    mine = durable(recent.distinct())
    links = similar.select(F.col("src").alias("restaurantId"), "dst", "score")
    reached = skew_join(mine, links, ["restaurantId"]).select(
        "userId", F.col("dst").alias("restaurantId"), "score"
    )
    fresh = reached.join(mine, ["userId", "restaurantId"], "left_anti")
    return _choose(fresh, places, locations)


def recommend_for(
    user: int, latitude: float, longitude: float, recent: DataFrame, similar: DataFrame, places: DataFrame,
    from_any: bool = False,
) -> DataFrame:
    """The recommendation for one user at a point.

    ``from_any`` lets similar pairs start from every restaurant, not the recent ones.
    """
    mine = recent.where(F.col("userId") == user)
    location = mine.sparkSession.createDataFrame(
        [(user, latitude, longitude)], "userId bigint, latitude double, longitude double"
    )
    if not from_any:
        return recommend(mine, similar, places, location)
    reached = similar.select(F.lit(user).alias("userId"), F.col("dst").alias("restaurantId"), "score")
    fresh = reached.join(mine.distinct(), ["userId", "restaurantId"], "left_anti")
    return _choose(fresh, places, location)


def liked_images(swipes: DataFrame, images: DataFrame, n: int = BEST_IMAGES) -> DataFrame:
    """The images of each restaurant with the largest share of likes among their swipes."""
    counts = (
        swipes.groupBy("imageId")
        .agg(F.count(F.lit(1)).alias("swipes"), F.count_if(F.col("swipeLeft") == 0).alias("likes"))
        .where(F.col("likes") > 0)
    )
    owners = images.select(F.col("id").alias("imageId"), "restaurantId")
    shares = counts.join(owners, "imageId").withColumn("ratio", ratio(F.col("likes"), F.col("swipes")))
    return top_n(shares, ["restaurantId"], ["-ratio", "imageId"], n, "place")


def pick_image(swipes: DataFrame, images: DataFrame, seed: int = schemas.EMBEDDING_SEED) -> DataFrame:
    """One of each restaurant's best images, drawn evenly by a seeded digest of its id."""
    draw = F.md5(F.concat_ws(":", F.col("imageId").cast("string"), F.lit(str(seed))))
    best = liked_images(swipes, images).withColumn("_draw", draw)
    return best.groupBy("restaurantId").agg(F.min_by("imageId", F.struct("_draw", "imageId")).alias("imageId"))
