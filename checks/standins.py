"""The domain's tables, derived from the given ones: in Spark here, in SQL in ``oracles``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def brand_number() -> F.Column:
    return F.substr("p_brand", F.lit(7)).cast("bigint")


def swipes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as swipes of a user on an image."""
    return given(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("userId"),
        F.get_json_object("props", "$.k").cast("bigint").alias("imageId"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type").isin("error", "view"), 1).otherwise(0).alias("swipeLeft"),
    )


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Ordered items as swipes of the customer on the part, over several years."""
    orders = given(spark, folder, "orders").select("o_orderkey", "o_custkey")
    items = given(spark, folder, "lineitem")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("id"),
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("imageId"),
        F.col("l_shipdate").alias("timestamp"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("swipeLeft"),
    )


def images(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("img_"), "p_partkey", F.lit(".jpg")).alias("file"),
        F.col("p_partkey").alias("dishId"),
        F.col("p_size").cast("bigint").alias("uploaderId"),
        F.lit(None).cast("timestamp").alias("uploadDt"),
        F.split("p_name", " ").alias("tags"),
        brand_number().alias("restaurantId"),
    )


def dishes(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("description"),
        brand_number().alias("restaurantId"),
        F.split("p_name", " ").alias("ingredients"),
    )


def restaurants(spark: SparkSession, folder: str) -> DataFrame:
    """Brands as restaurants, each at a point that follows from its number."""
    key = F.col("key")
    return (
        given(spark, folder, "part")
        .select(brand_number().alias("key"), F.col("p_brand").alias("restaurant_name"))
        .distinct()
        .select(
            "key",
            F.concat(F.lit("go"), key).alias("go_key"),
            F.concat(F.lit("ta"), key).alias("ta_key"),
            "restaurant_name",
            F.concat(F.lit("Street "), key).alias("address"),
            (41.3 + key * 0.003).alias("latitude"),
            (2.1 + (key * 7 % 25) * 0.004).alias("longitude"),
            F.lit(None).cast("string").alias("website"),
            F.lit(None).cast("string").alias("email"),
            F.lit(None).cast("string").alias("telephone"),
            (key % 4 + 1).cast("double").alias("price"),
            F.when(key % 7 == 0, 1).otherwise(0).alias("closed"),
            F.lit(None).cast("timestamp").alias("closed_time"),
        )
    )


def cuisines(spark: SparkSession, folder: str) -> DataFrame:
    from venuelake.operators.normalize import keyed_values

    rows = given(spark, folder, "part").select(
        brand_number().alias("restaurant_key"), F.col("p_type").alias("cuisine")
    )
    return keyed_values(rows.distinct(), "cuisine", "cuisine_key").select(
        "restaurant_key", "cuisine", "cuisine_key"
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    nation = given(spark, folder, "nation")
    balance = F.col("c_acctbal")
    return given(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"),
        F.col("n_name").alias("city"),
        F.when(balance >= 0, F.floor(balance) % 125).alias("age"),
    )


def opening_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Opening periods: a weekday per part size, times from the part's number."""
    number = F.col("p_partkey")
    return given(spark, folder, "part").select(
        brand_number().alias("ra_key"),
        (F.col("p_size") % 7).cast("int").alias("day_key"),
        ((8 + number % 12) * 100).cast("int").alias("open_time"),
        ((12 + number % 12) * 100 + 30).cast("int").alias("close_time"),
    )


def venues_a(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as venues of the first source."""
    key = F.col("c_custkey")
    nan = F.lit(float("nan"))
    return given(spark, folder, "customer").select(
        F.col("c_name").alias("name"),
        F.concat(F.lit("p"), key).alias("place_id"),
        F.when(key % 10 == 0, "CLOSED_PERMANENTLY").when(key % 17 != 0, "OPERATIONAL").alias("business_status"),
        F.when(key % 3 == 1, nan).when(key % 3 == 2, (key % 4 + 1).cast("double")).alias("price_level"),
        F.when(F.col("c_acctbal") < 0, nan).otherwise(F.col("c_acctbal")).alias("rating"),
        F.col("c_nationkey").alias("user_ratings_total"),
        F.concat(F.lit("Street "), key).alias("vicinity"),
        (41.3 + (key % 401) * 0.0005).alias("latitude"),
        (2.0 + (key % 499) * 0.0005).alias("longitude"),
    )


def venues_b_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as venues of the second source, some metres from the customer of the same number."""
    key = F.col("p_partkey")
    shift = lambda factor: ((key * factor) % 21 - 10) * 0.00001
    price = F.element_at(F.array(*[F.lit(p) for p in ("$", "$$ - $$$", "$$$$", "")]), F.col("p_size") % 4 + 1)
    return given(spark, folder, "part").select(
        F.col("p_name").alias("name"),
        F.concat(F.lit("http://venues.example/Review-g187497-d"), key, F.lit("-Place")).alias("url"),
        F.col("p_retailprice").alias("rating"),
        F.concat_ws(" , ", F.split("p_name", " ")).alias("cuisine"),
        F.when(F.col("p_size") % 5 != 0, F.concat("p_type", F.lit(", "), "p_brand")).alias("meals"),
        price.alias("price"),
        (41.3 + (key % 401) * 0.0005 + shift(37)).alias("latitude"),
        (2.0 + (key % 499) * 0.0005 + shift(53)).alias("longitude"),
        F.concat(F.lit("www."), key).alias("website"),
        F.concat(key, F.lit("@mail.example")).alias("email"),
        F.concat(F.lit("+34 "), key).alias("telephone"),
    )


def venues_b(spark: SparkSession, folder: str) -> DataFrame:
    from venuelake.plans.warehouse import prepare_venue_b

    return prepare_venue_b(venues_b_raw(spark, folder))


def globe_points(spark: SparkSession, folder: str, table: str, key: str, prefix: str) -> DataFrame:
    """Rows of a table at points spread over the whole globe, which follow from their keys; some share one."""
    up = F.pmod(F.col(key) * 7919, F.lit(20011)) / 10005.0 - 1
    return given(spark, folder, table).select(
        key,
        F.degrees(F.asin(F.least(up, F.lit(1.0)))).alias(f"{prefix}latitude"),
        (F.pmod(F.col(key) * 104729, F.lit(36007)) / 100.0 - 180).alias(f"{prefix}longitude"),
    )
