"""Tables whose content is replaced without ever losing the old one.

Each write goes to a fresh folder below the table's; a small file then names the current one.
The switch is one rename, so readers see the old rows or the new ones, and a failed job leaves
the old ones in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CURRENT = "CURRENT"


def _configuration(spark: SparkSession) -> object:
    return spark._jsparkSession.sessionState().newHadoopConf()


def current_path(spark: SparkSession, folder: str, name: str) -> str | None:
    """Where the current rows of a table are; none if it was never published."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/{_CURRENT}")
    if not place.getFileSystem(_configuration(spark)).exists(place):
        return None
    version = spark.read.text(place.toString()).first()[0]
    return f"{folder}/{name}/{version}"


def read_current(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = current_path(spark, folder, name)
    if path is None:
        raise FileNotFoundError(f"no table {name} below {folder}")
    return spark.read.parquet(path)


def publish(df: DataFrame, folder: str, name: str) -> None:
    """Write ``df`` and make it the table's content. ``df`` may read the table's old content."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{folder}/{name}/{version}")
    fs, configuration = spark._jvm.org.apache.hadoop.fs, _configuration(spark)
    new, current = fs.Path(f"{folder}/{name}/NEW-{version}"), fs.Path(f"{folder}/{name}/{_CURRENT}")
    system = new.getFileSystem(configuration)
    out = system.create(new)
    out.write(bytearray(version, "ascii"))
    out.close()
    rename = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    fs.FileContext.getFileContext(system.getUri(), configuration).rename(new, current, options)
