"""Session settings, and the one way the package cuts lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Spark's setting by which an execution that has ended lets go of its shuffle files.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "venuelake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the package's plans rely on.

    AQE sizes shuffles and splits skewed joins; UTC makes day and month buckets
    independent of the machine; checkpoints go when nothing refers to them. Memory and parallelism stay with the cluster.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers of a cluster on which it is not installed."""
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="venuelake-")) / "venuelake.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for path in sorted(root.rglob("*.py")):
            file.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without it, and gets a temporary folder; on a
    cluster such a folder would be gone with its machine, so that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="venuelake-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the written rows.

    The result survives the loss of executors, and every later use sees the same
    rows in the same partitions.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


_SCRATCH: dict[str, str] = {}
_CURRENT: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A fresh path below the shared folder, for a table a job writes and reads back.

    All of an application's are in one folder, which goes when the driver ends. Those that are not
    ``lasting`` go with the part of it that ``open_scratch`` opened last.
    """
    application = spark.sparkContext.applicationId
    if application not in _SCRATCH:
        _SCRATCH[application] = f"{shared_folder(spark).rstrip('/')}/venuelake-{application}-{uuid.uuid4().hex}"
        atexit.register(_delete, spark, _SCRATCH[application])
    folder = _SCRATCH[application] if lasting else _CURRENT.get(application, _SCRATCH[application])
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def open_scratch(spark: SparkSession) -> str:
    """A fresh folder for the scratch tables asked for from now on."""
    folder = scratch_path(spark, "scope", lasting=True)
    _CURRENT[spark.sparkContext.applicationId] = folder
    return folder


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[str]:
    """Scratch tables asked for within lie in a folder of their own, which ``drop_scratch`` deletes."""
    application = spark.sparkContext.applicationId
    before = _CURRENT.get(application)
    try:
        yield open_scratch(spark)
    finally:
        if before is None:
            _CURRENT.pop(application, None)
        else:
            _CURRENT[application] = before


def drop_scratch(spark: SparkSession, folder: str) -> None:
    """Delete scratch tables before the driver ends.

    The shuffle files of jobs nobody refers to any more are let go as well: Spark drops them
    when the driver's garbage is collected, which on a quiet driver can take half an hour.
    """
    _delete(spark, folder)
    spark._jvm.System.gc()


def _delete(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session has been stopped already
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


@contextmanager
def letting_go(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a table that is written within goes when it is written."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: lineage ends, later uses see the same rows.

    What was shuffled for it goes at once, as the written table takes its place.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with letting_go(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and nothing reads any more."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            drop_scratch(table.sparkSession, folder)
