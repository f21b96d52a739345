"""Load each landing file once, and archive what was loaded."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.errors import ColumnError
from tiersmith.operators.columns import clean_column_names, column, require_columns
from tiersmith.sources.landing import read_by_header, read_csv
from tiersmith.sources.tables import AUDIT_COLUMN, audit_stamp, create_database

#: Which stream loaded a row, and in which of its batches.
STREAM_COLUMN, LOAD_COLUMN = "load_stream", "load_id"

# The columns of a file as the format has them.
_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def landing_schema(spark: SparkSession, landing: str, table: str, sep: str = ",") -> T.StructType:
    """All strings, named by the header of the landing files.

    Without any file, as when all are archived, the loaded table has the names.
    """
    try:
        schema = read_csv(spark, landing, sep).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        schema, missing = None, error
    if schema:
        return schema
    if not spark.catalog.tableExists(table):
        raise missing
    return without_load_columns(spark.table(table)).schema


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    location: str,
    database: str,
    table: str,
    checkpoint: str,
    archive: str | None = None,
    schema: T.StructType | None = None,
    sep: str = ",",
    run_ts: datetime | None = None,
    files_per_batch: int | None = None,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    escape: str = "\\",
    line_breaks: bool = False,
) -> None:
    """Append the landing files no earlier call has loaded to ``database.table``.

    ``landing`` is a folder or a glob; its new files must have the columns of
    the table, in any order: the files of a batch are grouped by their first
    line, and each group is read under its own header. ``line_breaks`` allows
    them within quoted fields. The checkpoint remembers
    what was loaded and gives the stream its id. A batch that is repeated after
    a failure replaces its own partition (``load_stream``, ``load_id``) and so
    adds no row twice, and takes none from other streams into the table.
    ``files_per_batch`` cuts a large backlog into several batches. With
    ``archive``, a folder beside the landing folder, loaded files are moved
    there once a later batch has run.
    """
    name = f"`{database}`.`{table}`"
    schema = schema or landing_schema(spark, landing, name, sep)
    # The stream says which files are new; their content is read by batch.
    reader = spark.readStream.format("binaryFile").schema(_FILE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    arrived = reader.load(landing).select("path")
    known_columns = clean_column_names(spark.createDataFrame([], schema))
    require_columns(known_columns, partition_by)
    create_database(spark, database, location)
    # The table is there before the first batch, so all batches are alike.
    texts = ", ".join(f"`{column}` STRING" for column in known_columns.columns)
    keys = ", ".join(f"`{column}`" for column in (STREAM_COLUMN, LOAD_COLUMN, *partition_by))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} "
        f"({texts}, {AUDIT_COLUMN} TIMESTAMP, {STREAM_COLUMN} STRING, {LOAD_COLUMN} BIGINT) "
        f"USING {file_format} PARTITIONED BY ({keys})"
    )
    columns = spark.table(name).columns
    known = set(columns) - {AUDIT_COLUMN, STREAM_COLUMN, LOAD_COLUMN}

    refused: list[ColumnError] = []

    def save_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        try:
            # Once each, also where one file's name is a pattern that fits another's.
            rows = read_by_header(session, batch.distinct(), sep, escape, line_breaks)
        except ColumnError as error:
            refused.append(error)
            raise
        if rows is None:
            return
        rows = clean_column_names(rows)
        if set(rows.columns) != known:
            refused.append(ColumnError(f"{table} has columns {sorted(known)}, its new files {sorted(rows.columns)}"))
            raise refused[0]
        loaded = rows.withColumns(
            {
                AUDIT_COLUMN: audit_stamp(run_ts),
                STREAM_COLUMN: F.lit(stream),
                LOAD_COLUMN: F.lit(batch_id).cast("bigint"),
            }
        )
        # Only the partition of this batch is replaced. The setting stays in
        # the session that the stream has of its own. Inserts go by position.
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        loaded.select(*map(column, columns)).write.mode("overwrite").insertInto(name)

    query = (
        arrived.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save_batch)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException:
        # The stream tells it as text; callers get the error itself.
        if refused:
            raise refused[0] from None
        raise
    # The batches ran in a session of their own; this one may have listed files.
    spark.catalog.refreshTable(name)


def without_load_columns(df: DataFrame) -> DataFrame:
    """The data columns of an incrementally loaded table."""
    return df.drop(AUDIT_COLUMN, STREAM_COLUMN, LOAD_COLUMN)
