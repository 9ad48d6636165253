"""App tables: personal data apart, array columns normalised, the rest copied."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelake import schemas
from venuelake.functions import dates, text
from venuelake.functions.dates import Moment
from venuelake.operators.normalize import normalize
from venuelake.operators.skew import skew_join
from venuelake.sources.tables import copy_missing, read_table, write_table


def split_users(users: DataFrame, as_of: Moment = None) -> tuple[DataFrame, DataFrame]:
    """``(personal columns, analytic columns)``; the latter with city, postcode and age."""
    derived = users.withColumns(
        {
            "city": text.address_part(F.col("address"), 0),
            "zipcode": text.address_part(F.col("address"), 1),
            "age": dates.age(F.col("birthdate"), as_of),
        }
    )
    return derived.select(*schemas.PERSONAL_COLUMNS), derived.select(*schemas.USER_COLUMNS)


def image_restaurants(images: DataFrame, dishes: DataFrame) -> DataFrame:
    """Images with the restaurant of their dish; images without a dish drop out."""
    owner = dishes.select(F.col("id").alias("dishId"), "restaurantId")
    return skew_join(images, owner, ["dishId"])


def normalized_tables(dishes: DataFrame, images: DataFrame, users: DataFrame) -> dict[str, DataFrame]:
    """Parents without their arrays, value tables and bridge tables, by name."""
    parents = {"dishes": dishes, "images": images, "users": users}
    tables: dict[str, DataFrame] = {}
    for name, (array_column, bridge) in schemas.ARRAY_COLUMNS.items():
        parent, values, pairs = normalize(
            parents[name], array_column, schemas.SINGULAR[array_column], schemas.SINGULAR[name]
        )
        tables |= {name: parent, array_column: values, bridge: pairs}
    tables["images"] = image_restaurants(tables["images"], dishes)
    return tables


def load_app_data(spark: SparkSession, landing: str, warehouse: str, as_of: Moment = None) -> list[str]:
    """Write all app tables to the warehouse; returns the names of those copied as they are."""
    personal, users = split_users(read_table(spark, landing, "users"), as_of)
    write_table(personal, warehouse, "users_pii")
    dishes, images = (read_table(spark, landing, name) for name in ("dishes", "images"))
    for name, df in normalized_tables(dishes, images, users).items():
        write_table(df, warehouse, name)
    return copy_missing(spark, landing, warehouse)
