"""Image files as tables: paths with venue keys, headers, pixel vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelake import schemas
from venuelake.functions.text import key_from_image_name


def image_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    )


def image_catalog(paths: DataFrame, path: str = "path") -> DataFrame:
    """``(google_key, image_file, source)`` for the paths whose name holds a venue key."""
    return paths.select(
        key_from_image_name(F.col(path)).alias("google_key"),
        F.col(path).alias("image_file"),
        F.lit(schemas.SOURCE_A).alias("source"),
    ).where(F.col("google_key").isNotNull())


def unreadable_image_names(paths: DataFrame, path: str = "path") -> DataFrame:
    return paths.select(path).where(key_from_image_name(F.col(path)).isNull())


def image_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Size and channel count of each image."""
    images = spark.read.format("image").option("dropInvalid", "true").load(folder)
    return images.select("image.origin", "image.width", "image.height", "image.nChannels")


def unreadable_images(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the files that are no images, which ``image_headers`` and ``image_vectors`` leave out."""
    images = spark.read.format("image").option("dropInvalid", "false").load(folder)
    return images.where("image.nChannels <= 0").select("image.origin")


def image_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Each image's pixel values as one array, row by row, channels interleaved."""
    images = spark.read.format("image").option("dropInvalid", "true").load(folder)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["pixels"] = [np.frombuffer(b, np.uint8).astype(np.int16) for b in batch["data"]]
            yield batch.drop(columns="data")

    flat = images.select("image.origin", "image.width", "image.height", "image.nChannels", "image.data")
    return flat.mapInPandas(
        unpack, "origin string, width int, height int, nChannels int, pixels array<smallint>"
    )
