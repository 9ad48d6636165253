"""Marts kept up to date from states that can be merged: a new or late day costs its own swipes.

The state of a restaurant's day is its exact set of visitors, as words of 64 user keys, with the
sums of impressions and left swipes: never more rows than swipes, and few where visitors are many. States lie in one folder per month; a day that comes again
replaces its own states there. Days and months of a restaurant are put together from states, so the
swipes behind them are not read again, and only the months of new days are built anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelake.functions.dates import month
from venuelake.plans import marts
from venuelake.sources.tables import table_names

STATES, MONTHLY, VISITORS = "day_states", "monthly_resto", "monthly_visitors"
PART = "state_month"


def day_states(swipes: DataFrame, images: DataFrame) -> DataFrame:
    """Rows (restaurantId, date, user_word, users, impressions, left_swipes, state_month).

    ``users`` has a bit for each visitor whose key falls into the word (64 keys each); it is combined in the map
    tasks. A row is as small for a single visitor as for 64, so states do not outgrow the swipes when user keys
    lie far apart. Swipes without a user count as impressions only.
    """
    rows = marts.restaurant_swipes(swipes, images)
    key = F.col("userId").cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(F.lit(63)).cast("int"))
    return (
        rows.groupBy("restaurantId", "date", F.shiftright(key, 6).alias("user_word"))
        .agg(
            F.coalesce(F.bit_or(bit), F.lit(0).cast("bigint")).alias("users"),
            F.count("swipeLeft").alias("impressions"), F.sum("swipeLeft").alias("left_swipes"),
        )
        .withColumn("state_month", F.date_format("date", "yyyyMM").cast("int"))
    )


def _replace(rows: DataFrame, path: str) -> None:
    """Write rows; the months they fall into are replaced, all others stay as they are."""
    writer = rows.hint("rebalance", F.col(PART)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def daily_from_states(states: DataFrame) -> DataFrame:
    """Visitors, impressions and left swipes by restaurant and day, as ``marts.daily_stats``."""
    return states.groupBy("restaurantId", "date").agg(
        F.sum(F.bit_count("users").cast("bigint")).alias("users"), F.sum("impressions").alias("impressions"),
        F.sum("left_swipes").alias("left_swipes"),
    )


def visitors_from_states(states: DataFrame) -> DataFrame:
    """Distinct visitors by restaurant and month: the days' words are merged before they are counted."""
    merged = states.groupBy("restaurantId", month(F.col("date")).alias("month"), "user_word", "state_month").agg(
        F.bit_or("users").alias("users")
    )
    return merged.groupBy("restaurantId", "month", "state_month").agg(F.sum(F.bit_count("users").cast("bigint")).alias("visitors"))


def add_days(spark: SparkSession, folder: str, swipes: DataFrame, images: DataFrame, restaurants: DataFrame) -> list[int]:
    """Take the days of ``swipes``, which are whole, into the states and build their months anew.

    A day that is there already is replaced. Returns the months, as yyyyMM; read are the states of
    these months alone. A repeat after a failure leads to the same tables.
    """
    new = _written(day_states(swipes, images), f"{folder}/_pending/days")
    months = sorted(r[0] for r in new.select(PART).distinct().collect())
    if months and has_states(spark, folder):
        days = new.select("date").distinct()
        others = month_states(spark, folder, months).join(days, "date", "left_anti")
        # Written apart first, as the months it comes from are replaced.
        new = _written(new.unionByName(others), f"{folder}/_pending/months")
    _replace(new, f"{folder}/{STATES}")
    refresh_months(spark, folder, restaurants, months)
    return months


def _written(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def has_states(spark: SparkSession, folder: str) -> bool:
    return STATES in table_names(spark, folder)


def month_states(spark: SparkSession, folder: str, months: list[int] | None = None) -> DataFrame:
    """All states, or those of ``months``; other months' files are not opened."""
    states = spark.read.parquet(f"{folder}/{STATES}")
    return states if months is None else states.where(F.col(PART).isin(months))


def refresh_months(spark: SparkSession, folder: str, restaurants: DataFrame, months: list[int]) -> None:
    """Build the monthly marts of ``months`` from states; ranks are within a month, so others keep theirs."""
    if not months:
        return
    states = month_states(spark, folder, months)
    monthly = marts.monthly_stats(daily_from_states(states), restaurants)
    number = F.replace("month", F.lit("-"), F.lit("")).cast("int")
    _replace(monthly.withColumn(PART, number), f"{folder}/{MONTHLY}")
    _replace(visitors_from_states(states), f"{folder}/{VISITORS}")
