"""Queries on the marts: one restaurant against its peers, month slices, reference means."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake import schemas
from venuelake.functions.dates import month
from venuelake.functions.numbers import relative_position
from venuelake.functions.text import compact_number
from venuelake.operators.ranking import rank_rows
from venuelake.session import durable

AVERAGES = ["dly_avg_users", "dly_avg_impressions", "dly_avg_left_swipes"]


def peers(monthly: DataFrame, cuisines: DataFrame, restaurant: Column | int | None = None) -> DataFrame:
    """Monthly numbers of every venue per cuisine; venues without numbers have a null month.

    With ``restaurant`` only the cuisines of that one are kept.
    """
    served = cuisines.withColumnRenamed("restaurant_key", "restaurantId")
    if restaurant is not None:
        own = served.where(F.col("restaurantId") == restaurant).select("cuisine").distinct()
        served = served.join(own, "cuisine", "left_semi")
    return monthly.drop("restaurant_name").join(served, "restaurantId", "right")


def peer_ranks(peer_rows: DataFrame) -> DataFrame:
    """Peers with their place ``crank`` by impressions per cuisine and month."""
    return rank_rows(
        peer_rows, ["cuisine", "month"], ["-dly_avg_impressions"], ["restaurantId", "cuisine_key"],
        row_number="crank",
    )


def peer_averages(peer_rows: DataFrame) -> DataFrame:
    """Averages over the venues of a cuisine and month, and how many there are."""
    return peer_rows.groupBy("cuisine", "month").agg(
        *[F.avg(c).alias(c) for c in [*AVERAGES, "days_active"]],
        F.count_distinct("restaurantId").alias("restos"),
    )


def of_restaurant(df: DataFrame, restaurant: int) -> DataFrame:
    return df.where(F.col("restaurantId") == restaurant)


def available_months(monthly: DataFrame) -> DataFrame:
    """Months with data by restaurant."""
    return monthly.select("restaurantId", "month").distinct()


@dataclass
class RestaurantView:
    """Everything shown for one restaurant."""

    months: DataFrame
    visitors: DataFrame
    images: DataFrame
    daily: DataFrame
    per_cuisine: DataFrame
    cuisine_ranking: DataFrame
    monthly: DataFrame

    def of_month(self, value: str) -> dict[str, DataFrame]:
        """The frames of one month, without month and restaurant columns."""
        frames = {name: df for name, df in vars(self).items() if name != "months"}
        return {
            name: df.where(F.col("month") == value).drop("month", "restaurantId")
            for name, df in frames.items()
        }


def restaurant_view(
    restaurant: int, monthly: DataFrame, daily: DataFrame, images: DataFrame, visitors: DataFrame,
    cuisines: DataFrame,
) -> RestaurantView:
    """Mart slices and peer comparison of one restaurant, from the four marts."""
    peer_rows = durable(peers(monthly, cuisines, restaurant))
    ranking = of_restaurant(peer_ranks(peer_rows), restaurant).select("month", "cuisine", "rank", "crank")
    own = of_restaurant(monthly, restaurant)
    return RestaurantView(
        months=own.select("month").distinct().orderBy("month"),
        visitors=of_restaurant(visitors, restaurant),
        images=of_restaurant(images, restaurant),
        daily=of_restaurant(daily, restaurant).withColumn("month", month(F.col("date"))),
        per_cuisine=peer_averages(peer_rows),
        cuisine_ranking=ranking,
        monthly=own,
    )


def peer_cards(ranks: DataFrame, averages: DataFrame) -> DataFrame:
    """A venue's place per cuisine and month beside the number and averages of its peers."""
    place = ranks.where(F.col("month").isNotNull()).select("restaurantId", "cuisine", "month", "crank")
    shown = [compact_number(F.col(c)).alias(c) for c in AVERAGES]
    return place.join(averages, ["cuisine", "month"]).select(
        "restaurantId", "cuisine", "month", "crank", "restos", *shown
    )


def between_days(daily: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of a closed range of days."""
    return daily.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def bottom_not_top(images: DataFrame) -> DataFrame:
    """Bottom images whose file is not among the top ones of the same restaurant and month."""
    top = images.where(F.col("rank").startswith("top-")).select("restaurantId", "month", "file")
    bottom = images.where(F.col("rank").startswith("bot-"))
    return bottom.join(top, ["restaurantId", "month", "file"], "left_anti").select(*images.columns)


def visitors_by_city(visitors: DataFrame) -> DataFrame:
    return visitors.groupBy("restaurantId", "month", "city").agg(F.sum("users").alias("users"))


def visitors_by_age(visitors: DataFrame) -> DataFrame:
    """Visitors by age bucket, with the age at which the bucket starts."""
    first_age = F.col("age_bucket") * schemas.AGE_BUCKET_YEARS
    return visitors.groupBy("restaurantId", "month", "age_bucket", first_age.alias("first_age")).agg(
        F.sum("users").alias("users")
    )


def reference_mean(daily: DataFrame, metric: str) -> DataFrame:
    """Mean, range and span of days of a metric by restaurant and month, and where the mean lies."""
    stats = daily.groupBy("restaurantId", month(F.col("date")).alias("month")).agg(
        F.avg(metric).alias("mean"), F.min(metric).alias("low"), F.max(metric).alias("high"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )
    position = relative_position(F.col("mean"), F.col("low"), F.col("high"))
    return stats.withColumns({"position": position, "label": compact_number(F.col("mean"))})
