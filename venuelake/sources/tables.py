"""Tables by folder and name, and many landing files read as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from venuelake import schemas

#: Where an entity's key stands in the path of its file.
KEY_PATTERN = r"/(g_[^/]+?)(?:\.parquet)?(?:/[^/]*)?$"


def read_table(spark: SparkSession, folder: str, name: str, view: bool = False) -> DataFrame:
    """A table of a folder; with ``view`` also registered for SQL under its name."""
    df = spark.read.parquet(f"{folder}/{name}")
    if view:
        df.createOrReplaceTempView(name)
    return df


def empty_table(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def table_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables below a folder, none if it does not exist. One level is listed, no file is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(path):
        return []
    hidden = ("_", ".")
    entries = [(x.getPath().getName(), x.isDirectory()) for x in system.listStatus(path)]
    return sorted(name for name, inner in entries if inner and not name.startswith(hidden))


def list_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the tables below a folder, as rows."""
    return spark.createDataFrame([(name,) for name in table_names(spark, folder)], "name string")


def write_table(
    df: DataFrame, folder: str, name: str, mode: str = "overwrite", partition_by: list[str] | None = None
) -> None:
    """Overwrite (schema included) or append a table; facts may be partitioned by month.

    Rows are brought together by partition first, so a task does not write a small file to
    each; Spark splits partitions that are too large for one task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder}/{name}")


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    spark.read.parquet(source).write.mode("overwrite").parquet(target)


def copy_missing(spark: SparkSession, source: str, target: str) -> list[str]:
    """Copy the tables of ``source`` that ``target`` lacks; returns their names."""
    there = set(table_names(spark, target))
    names = [name for name in table_names(spark, source) if name not in there]
    for name in names:
        copy_table(spark, f"{source}/{name}", f"{target}/{name}")
    return names


def _raw_schema(ddl: str, nested: dict[str, str], spark: SparkSession) -> StructType:
    """The wanted columns under the names they have in the files."""
    raw_names = {new: raw for raw, new in nested.items()}
    wanted = empty_table(spark, ddl).schema
    return StructType([StructField(raw_names.get(f.name, f.name), f.dataType, True) for f in wanted])


def read_landing(
    spark: SparkSession, folder: str, ddl: str, nested: dict[str, str], key: str | None = None,
    key_pattern: str = KEY_PATTERN,
) -> DataFrame:
    """All files below a folder as one table of the given columns.

    One scan with an explicit schema: column order does not matter, a column a file
    lacks is null, no footers are merged. ``nested`` maps names with dots to plain
    ones. With ``key`` each row also gets the entity key from its file's path.
    """
    raw = _raw_schema(ddl, nested, spark)
    df = spark.read.schema(raw).option("recursiveFileLookup", "true").parquet(folder)
    columns = [F.col(f"`{field.name}`").alias(nested.get(field.name, field.name)) for field in raw]
    if key:
        columns.insert(0, F.regexp_extract(F.col("_metadata.file_path"), key_pattern, 1).alias(key))
    return df.select(*columns)


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the last one in the order of the other columns, nulls first.

    So a known value beats a missing one. An aggregate combines in the map tasks, so
    many copies of one key cost little.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
        .select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])
        .select(*df.columns)
    )


def read_venue_a(spark: SparkSession, folder: str) -> DataFrame:
    """Venues of the first source from many files, one row per place."""
    return one_per_key(
        read_landing(spark, folder, schemas.VENUE_A_DDL, schemas.VENUE_A_NESTED), ["place_id"]
    )


def read_venue_details(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews and opening periods, one file per venue, key from the path.

    A file without either column gives no row. A file that has them but all null gives
    none either: after one merged read the two cases look the same.
    """
    ddl = "reviews string, opening_periods string"
    details = read_landing(spark, folder, ddl, schemas.DETAILS_NESTED, key="google_key")
    return details.where(F.col("reviews").isNotNull() | F.col("opening_periods").isNotNull())
