"""Session helpers: the shared folder, and intermediate results kept in it."""

from __future__ import annotations

import atexit
import contextlib
import threading
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tiersmith.files import open_uri


# Settings the jobs rely on or are faster with.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Long projections of text functions make generated methods too large for
    # the JVM to compile; beyond this size Spark uses smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_to_clear: set[str] = set()
_cleaning = threading.Lock()
_cleaners: dict[int, tuple[int, str]] = {}  # by session: writes at work, the setting before the first


def get_session(app_name: str = "tiersmith") -> SparkSession:
    """The running session, or a new one with these settings."""
    return SparkSession.builder.appName(app_name).config(map=SETTINGS).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, taken from ``spark.checkpoint.dir``.

    Only a local master may run without the setting; it then stages beside its
    tables, in the warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tiersmith/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call has been given."""
    folder = _application_folder(spark)
    if folder not in _to_clear:
        _to_clear.add(folder)
        # What was staged is of no use beyond the session that staged it.
        atexit.register(_delete_if_reached, folder)
    return f"{folder}/{label}-{uuid.uuid4().hex[:12]}"


def _delete(folder: str) -> None:
    filesystem, path = open_uri(folder)
    if filesystem.get_file_info(path).type == fs.FileType.Directory:
        filesystem.delete_dir(path)


def _delete_if_reached(folder: str) -> None:
    with contextlib.suppress(OSError):
        _delete(folder)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application staged; its DataFrames over it end with it.

    It happens by itself when the driver's Python ends.
    """
    _delete(_application_folder(spark))


@contextlib.contextmanager
def _without_shuffle_files(spark: SparkSession):
    """Shuffle files go with the query that wrote them; threads of one session share the setting."""
    key = id(spark)
    with _cleaning:
        working, before = _cleaners.get(key, (0, ""))
        if not working:
            before = spark.conf.get(_CLEANUP)
            spark.conf.set(_CLEANUP, "true")
        _cleaners[key] = (working + 1, before)
    try:
        yield
    finally:
        with _cleaning:
            working, before = _cleaners[key]
            if working == 1:
                spark.conf.set(_CLEANUP, before)
                del _cleaners[key]
            else:
                _cleaners[key] = (working - 1, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage, so values that depend on how rows were
    partitioned stay what they were when an executor is lost. Parquet, unlike
    a checkpointed RDD, lets later steps read only the columns they need. The
    shuffle files of the write go with it: nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _without_shuffle_files(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
