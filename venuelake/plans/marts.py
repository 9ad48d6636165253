"""Daily and monthly marts of swipes by restaurant, image and visitor group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelake.functions.dates import age_bucket, month
from venuelake.operators.ranking import rank_rows, top_n
from venuelake.operators.skew import skew_join
from venuelake.sources.tables import read_table, write_table

SHOWN = 3


def image_owners(images: DataFrame) -> DataFrame:
    return images.select(F.col("id").alias("imageId"), "restaurantId")


def restaurant_swipes(swipes: DataFrame, images: DataFrame) -> DataFrame:
    """Swipes with their day and the restaurant of the image."""
    facts = swipes.select("userId", "imageId", "swipeLeft", F.to_date("timestamp").alias("date"))
    return skew_join(facts, image_owners(images), ["imageId"], counted=swipes)


def daily_stats(swipes: DataFrame, images: DataFrame) -> DataFrame:
    """Visitors, impressions and left swipes by restaurant and day."""
    return (
        restaurant_swipes(swipes, images)
        .groupBy("restaurantId", "date")
        .agg(
            F.count_distinct("userId").alias("users"),
            F.count("swipeLeft").alias("impressions"),
            F.sum("swipeLeft").alias("left_swipes"),
        )
    )


def monthly_stats(daily: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Averages of the daily numbers by restaurant and month, ranked by impressions."""
    averages = (
        daily.groupBy(month(F.col("date")).alias("month"), "restaurantId")
        .agg(
            F.avg("users").alias("dly_avg_users"),
            F.avg("impressions").alias("dly_avg_impressions"),
            F.avg("left_swipes").alias("dly_avg_left_swipes"),
            F.count_distinct("date").alias("days_active"),
        )
    )
    names = restaurants.select(F.col("key").alias("restaurantId"), "restaurant_name")
    named = averages.join(names, "restaurantId")
    return rank_rows(
        named, ["month"], ["-dly_avg_impressions"], ["restaurantId", "restaurant_name"], dense_rank="rank"
    )


def image_stats(swipes: DataFrame, images: DataFrame) -> DataFrame:
    """Impressions and left swipes by image and month.

    The swipes are summed per image before they meet the images, so a much-shown image
    is one row per month by then.
    """
    per_image = swipes.groupBy("imageId", month(F.col("timestamp")).alias("month")).agg(
        F.count("swipeLeft").alias("impressions"), F.sum("swipeLeft").alias("left_swipes")
    )
    about = images.select(F.col("id").alias("imageId"), "restaurantId", "dishId", "file")
    return per_image.join(about, "imageId")


def monthly_images(swipes: DataFrame, images: DataFrame, dishes: DataFrame) -> DataFrame:
    """The most and least shown images by restaurant and month, labelled top-k or bot-k.

    Both ends are cut to three rows on their own and then put together: an image in both
    takes the smaller place, the bottom one if they are equal.
    """
    stats = image_stats(swipes, images)
    group = ["restaurantId", "month"]
    top = top_n(stats, group, ["-impressions", "imageId"], SHOWN, "_top")
    bottom = top_n(stats, group, ["impressions", "imageId"], SHOWN, "_bot")
    # At most six rows per group arrive here.
    both = (
        top.unionByName(bottom, allowMissingColumns=True)
        .groupBy(*group, "imageId", "dishId", "file", "impressions", "left_swipes")
        .agg(F.max("_top").alias("_top"), F.max("_bot").alias("_bot"))
    )
    is_top = F.col("_top").isNotNull() & (F.col("_bot").isNull() | (F.col("_top") < F.col("_bot")))
    label = F.when(is_top, F.concat(F.lit("top-"), "_top")).otherwise(F.concat(F.lit("bot-"), "_bot"))
    names = dishes.select(F.col("id").alias("dishId"), "name")
    return both.join(names, "dishId").select(
        *group, "impressions", "left_swipes", "name", label.alias("rank"), "file"
    )


def monthly_visitors(swipes: DataFrame, images: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct visitors by restaurant, month, city and age bucket."""
    visits = (
        skew_join(
            swipes.select("userId", "imageId", month(F.col("timestamp")).alias("month")).distinct(),
            image_owners(images), ["imageId"], counted=swipes,
        )
        .select("userId", "restaurantId", "month")
        .distinct()
    )
    profile = users.select(
        F.col("id").alias("userId"), "city", age_bucket(F.col("age")).alias("age_bucket")
    )
    return (
        visits.join(profile, "userId")
        .groupBy("restaurantId", "month", "city", "age_bucket")
        .agg(F.count("userId").alias("users"))
    )


def build_marts(spark: SparkSession, warehouse: str, marts: str) -> None:
    """Write all four marts; the monthly one is built from the written daily one."""
    swipes, images, users, restaurants, dishes = (
        read_table(spark, warehouse, name)
        for name in ("swipes", "images", "users", "restaurants", "dishes")
    )
    write_table(daily_stats(swipes, images), marts, "daily_resto")
    daily = read_table(spark, marts, "daily_resto")
    write_table(monthly_stats(daily, restaurants), marts, "monthly_resto", partition_by=["month"])
    write_table(monthly_images(swipes, images, dishes), marts, "monthly_resto_images", partition_by=["month"])
    write_table(monthly_visitors(swipes, images, users), marts, "monthly_resto_users", partition_by=["month"])
