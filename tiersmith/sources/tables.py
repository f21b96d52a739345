"""Managed tables: databases, saves with an audit stamp, compaction."""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from urllib.parse import quote

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.files import exists, open_uri, path_of, read_json, write_json
from tiersmith.operators.columns import column

log = logging.getLogger(__name__)

AUDIT_COLUMN = "processing_ts"
#: Bytes a compacted file should have.
FILE_BYTES = 128 << 20
#: After this time a compaction that has not ended is taken for dead.
ABANDONED = timedelta(days=1)

# Rewritten partitions are beside the table's own folder; what a version moves, and that all of it is moved.
_VERSIONS, _PLAN, _DONE = "__versions", "_plan.json", "_done.json"


def database_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.databaseExists(name)


def create_database(spark: SparkSession, name: str, location: str) -> None:
    """Create a database at ``<location>/<name>/_db/`` unless it exists."""
    place = f"{location.rstrip('/')}/{name}/_db/".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{place}'")


def drop_databases(spark: SparkSession, *names: str) -> None:
    """Drop databases with all their tables; absent ones are ignored."""
    for name in names:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def layer_name(name: str | None, run_hash: str | None = None) -> str | None:
    """A database name with the suffix of a run, if there is one."""
    return f"{name}_{run_hash}" if name is not None and run_hash else name


def create_database_name(
    src_database: str | None, dst_database: str | None, run_hash: str | None = None
) -> tuple[str | None, str | None]:
    """Source and destination names of a layer job."""
    return layer_name(src_database, run_hash), layer_name(dst_database, run_hash)


def audit_stamp(run_ts: datetime | None = None) -> Column:
    """One timestamp for a whole save: ``run_ts``, or the start of the query."""
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return stamp.alias(AUDIT_COLUMN)


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")


def save_table(
    spark: SparkSession,
    df: DataFrame,
    location: str,
    database: str,
    table: str,
    file_format: str = "parquet",
    overwrite: bool = False,
    optimize_table: bool = False,
    partition_by: Sequence[str] | str | None = None,
    run_ts: datetime | None = None,
) -> None:
    """Stamp and save as ``database.table``, creating the database if needed.

    Partition columns are rebalanced before the write, so each value goes to
    few files, and to several when it holds much of the data.
    """
    create_database(spark, database, location)
    if overwrite:
        _make_way(spark, database, table)
    partitions = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
    stamped = df.withColumn(AUDIT_COLUMN, audit_stamp(run_ts))
    if partitions:
        stamped = stamped.hint("rebalance", *map(column, partitions))
    writer = stamped.write.format(file_format).mode("overwrite" if overwrite else "append")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(f"`{database}`.`{table}`")
    log.info("saved %s.%s", database, table)
    if optimize_table:
        compact_table(spark, database, table)


def _make_way(spark: SparkSession, database: str, table: str) -> None:
    """Delete what compactions have replaced before a table is created anew in its own folder."""
    remove_replaced(spark, database, table)
    live = f"`{database}`.`{table}`"
    if spark.catalog.tableExists(live):
        facts = _Facts.of(spark, live)
        if facts.location != facts.base:
            _delete(facts.base)


@dataclass(frozen=True)
class _Facts:
    """What the catalog says of a table, whatever its columns are called."""

    provider: str
    location: str
    partitions: list[T.StructField]

    @classmethod
    def of(cls, spark: SparkSession, name: str) -> _Facts:
        described = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])
        fields = {field.name: field for field in spark.table(name).schema}
        partitions = [fields[column] for column in described.get("partition_columns") or []]
        return cls(described["provider"], described["location"].rstrip("/"), partitions)

    @property
    def base(self) -> str:
        """Where the table was created, whichever version is published now."""
        return re.sub(f"{_VERSIONS}/[^/]+$", "", self.location)

    @property
    def versions(self) -> str:
        return self.base + _VERSIONS


def _spec(facts: _Facts, values: Sequence[str | None]) -> str:
    """A partition in SQL; nothing for a table without partitions."""
    if not facts.partitions:
        return ""
    quoted = ["null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values]
    names = [field.name.replace("`", "``") for field in facts.partitions]
    return "PARTITION (" + ", ".join(f"`{n}`={v}" for n, v in zip(names, quoted, strict=True)) + ")"


def _published(spark: SparkSession, name: str, facts: _Facts, values: Sequence[str | None]) -> str | None:
    """The folder that the catalog names for a partition, or for the table; None without it."""
    try:
        row = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {_spec(facts, values)} AS JSON").first()
    except AnalysisException as error:
        if error.getCondition() not in ("PARTITIONS_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            raise
        return None
    return path_of(json.loads(row[0])["location"]).rstrip("/")


def _folders(spark: SparkSession, facts: _Facts, *places: str) -> DataFrame:
    """``(folder, values, n_files, n_bytes)`` of the folders with files, listed on the cluster.

    ``values`` are those of the partition columns, as the folder's name has them.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "[!_.]*")
        .load([place for place in places if exists(place)])
    )

    def value(field: T.StructField) -> Column:
        # Folder names escape like addresses do, but keep a plus sign.
        name = re.escape(quote(field.name, safe=""))
        raw = F.regexp_extract("folder", f"/(?:{re.escape(field.name)}|{name})=([^/]*)(?:/|$)", 1)
        text = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
        return F.when(raw != "__HIVE_DEFAULT_PARTITION__", text)

    folders = files.groupBy(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes")
    )
    values = F.array(*map(value, facts.partitions)) if facts.partitions else F.lit([]).cast("array<string>")
    return folders.withColumn("values", values)


def _rows_by_partition(rows: DataFrame, facts: _Facts) -> DataFrame:
    keys = [column(field.name) for field in facts.partitions]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))


def _delete(uri: str) -> None:
    filesystem, path = open_uri(uri)
    if filesystem.get_file_info(path).type == fs.FileType.Directory:
        filesystem.delete_dir(path)


def _plans(versions: str) -> list[tuple[str, dict, fs.FileInfo, bool]]:
    """The plans of all versions there are: version, plan, its file, and whether all of it is published."""
    if not exists(versions):
        return []
    filesystem, path = open_uri(versions)
    found = []
    for folder in filesystem.get_file_info(fs.FileSelector(path)):
        plan, done = filesystem.get_file_info([f"{folder.path}/{_PLAN}", f"{folder.path}/{_DONE}"])
        if plan.type == fs.FileType.File:
            version = f"{versions}/{folder.base_name}"
            found.append((version, read_json(f"{version}/{_PLAN}"), plan, done.type == fs.FileType.File))
    return found


def remove_replaced(spark: SparkSession, database: str, table: str) -> None:
    """Delete files that no partition of the table uses since a compaction.

    They stay until then, for readers that began before. Those of a compaction
    that died are of no use either; they go a day after it began.
    """
    live = f"`{database}`.`{table}`"
    before = f"`{database}`.`{table}__before`"
    if spark.catalog.tableExists(before) and not spark.catalog.tableExists(live):
        # Left between two renames by an earlier way of compaction.
        spark.sql(f"ALTER TABLE {before} RENAME TO {live}")
        if _Facts.of(spark, live).partitions:
            spark.sql(f"MSCK REPAIR TABLE {live} SYNC PARTITIONS")
    if not spark.catalog.tableExists(live):
        return
    facts = _Facts.of(spark, live)
    for version, plan, file, done in _plans(facts.versions):
        if not done and datetime.now(timezone.utc) - file.mtime < ABANDONED:
            continue
        in_use = False
        for values, *folders in plan["folders"]:
            published = _published(spark, live, facts, values)
            for folder in folders:
                if path_of(folder) != published:
                    _delete(folder)
            in_use |= path_of(folders[-1]) == published
        if in_use:
            filesystem, path = open_uri(f"{version}/{_PLAN}")
            filesystem.delete_file(path)
        else:
            _delete(version)


def compact_table(spark: SparkSession, database: str, table: str, file_bytes: int = FILE_BYTES) -> None:
    """Rewrite partitions of many small files into fewer, evenly sized ones; the rows stay the same.

    Partitions whose files are as few as their bytes call for are neither read
    nor written. The others are written once, to a folder of their own beside
    the table, and published by pointing the catalog to it, one call for each:
    readers find the old files or the new ones, never neither and never both.
    A job that dies leaves each partition with one or the other. Old files stay
    for readers that began before; the next compaction deletes them.

    A table that is written to while it is copied is left as it is. Compactions of one table must not run at the same time; those of several
    tables may, and nothing of the session is changed.
    """
    live = f"`{database}`.`{table}`"
    remove_replaced(spark, database, table)
    facts = _Facts.of(spark, live)
    names = [field.name for field in facts.partitions]
    places = (facts.base, facts.versions) if names else (facts.location,)
    listed = _folders(spark, facts, *places)
    crowded = listed.where(F.col("n_files") > F.greatest(F.ceil(F.col("n_bytes") / file_bytes), F.lit(1)))
    # One row for each partition to rewrite, which the catalog is told of one by one.
    scattered = [row for row in crowded.collect() if path_of(row["folder"]) == _published(spark, live, facts, row["values"])]
    if not scattered:
        return
    rows = spark.table(live)
    if names:
        texts = spark.createDataFrame([(row["values"],) for row in scattered], "values array<string>")
        chosen = texts.select(*[F.get("values", i).cast(f.dataType).alias(f.name) for i, f in enumerate(facts.partitions)])
        # A subquery over partition columns alone: other partitions are pruned.
        held = chosen.agg(F.collect_set(F.struct(*map(column, names)))).scalar()
        rows = rows.where(F.array_contains(held, F.struct(*map(column, names))))
    version = f"{facts.versions}/{uuid.uuid4().hex}"
    writer = rows.hint("rebalance", *map(column, names)).write.format(facts.provider)
    if names:
        writer = writer.partitionBy(*names)
    data = f"{version}/data" if names else version
    writer.save(data)
    now = {row["folder"]: (row["n_files"], row["n_bytes"]) for row in _folders(spark, facts, *places).collect()}
    if any(now.get(row["folder"]) != (row["n_files"], row["n_bytes"]) for row in scattered):
        _delete(version)
        log.warning("%s.%s was written to while it was copied, so it is left as it is", database, table)
        return
    copy = spark.read.format(facts.provider).schema(rows.schema).load(data)
    missed = _rows_by_partition(rows, facts).exceptAll(_rows_by_partition(copy, facts))
    if not missed.isEmpty():
        raise RuntimeError(f"the copy of {live} in {data} does not have all rows; nothing was published")
    written = {tuple(row["values"]): row["folder"] for row in _folders(spark, facts, data).collect()}
    moves = [(list(row["values"]), row["folder"], written[tuple(row["values"])]) for row in scattered]
    write_json(f"{version}/{_PLAN}", {"folders": moves})
    _publish(spark, live, facts, moves)
    write_json(f"{version}/{_DONE}", len(moves))
    spark.catalog.refreshTable(live)
    log.info("compacted %s.%s", database, table)


def _publish(spark: SparkSession, live: str, facts: _Facts, moves: list[tuple]) -> None:
    for values, _, folder in moves:
        place = folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {live} {_spec(facts, values)} SET LOCATION '{place}'")
