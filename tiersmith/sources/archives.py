"""Zip archives: landing files packed into them, and read out of them.

Tasks open files by URI and stream them, so neither the driver nor a task ever
holds a whole archive. The unit of work is one archive member: a compressed
stream cannot be entered in the middle. CSV members are unpacked once and then
read by Spark in parts.
"""

from __future__ import annotations

import fnmatch
import functools
import hashlib
import io
import sys
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith import files as uri_files
from tiersmith.errors import ColumnError, LandingError
from tiersmith.files import beside, exists, open_uri, path_of
from tiersmith.session import scratch_path, stage
from tiersmith.sources.landing import list_files

# Tasks get the code of their functions, not a reference to this package, which
# executors need not have.
for _module in (sys.modules[__name__], uri_files):
    cloudpickle.register_pickle_by_value(_module)

_CHUNK_BYTES = 4 << 20
_LINES_PER_BATCH = 8_192
_CHARS_PER_BATCH = 16 << 20


def _spread(files: DataFrame, *keys: str) -> DataFrame:
    """Each row stands for a file to work through: a few rows for each task."""
    # An explicit number: by their size alone Spark would put the rows together.
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(max(1, tasks), *[F.col(key) for key in keys])


def pack_files(files: DataFrame, target: str) -> DataFrame:
    """Pack each ``(path, name)`` file into ``<target>/<name>.zip``, at once.

    Returns ``(path, archive)``. An archive is written beside its place and
    then moved there, and its name follows from the file's: a repeated task
    replaces it by the same content.
    """
    target = target.rstrip("/")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = []
            for row in batch.itertuples(index=False):
                archive = beside(row.path, f"{target}/{row.name}.zip")
                source, source_path = open_uri(row.path)
                sink, sink_path = open_uri(archive)
                sink.create_dir(sink_path.rsplit("/", 1)[0], recursive=True)
                partial = f"{sink_path}.{uuid.uuid4().hex}.tmp"
                with (
                    source.open_input_stream(source_path) as data,
                    sink.open_output_stream(partial) as out,
                    zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=6) as packed,
                    packed.open(row.name.rsplit("/", 1)[-1], "w", force_zip64=True) as member,
                ):
                    while block := data.read(_CHUNK_BYTES):
                        member.write(block)
                sink.move(partial, sink_path)
                done.append((row.path, archive))
            yield pd.DataFrame(done, columns=["path", "archive"])

    packed = _spread(files.select("path", "name"), "path").mapInPandas(
        pack, "path string, archive string"
    )
    # Staging runs the packing now, and keeps a later read from repeating it.
    return stage(packed, "packed")


def zip_files(
    spark: SparkSession,
    folder: str,
    archive_dir: str,
    run_name: str,
    include: str = "*",
    exclude: tuple[str, ...] = (),
) -> DataFrame:
    """Pack each file of a folder into ``<archive_dir>/<run_name>/<file>.zip``."""
    files = list_files(spark, folder, include, exclude)
    return pack_files(files, f"{archive_dir.rstrip('/')}/{run_name}")


def archive_files(files: DataFrame, target: str) -> DataFrame:
    """``pack_files``, and once all of them are packed delete the originals."""
    packed = pack_files(files, target)

    def delete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                filesystem, path = open_uri(uri)
                # A repeated task finds some of its files gone.
                if filesystem.get_file_info(path).type != fs.FileType.NotFound:
                    filesystem.delete_file(path)
            yield batch

    return stage(_spread(packed, "path").mapInPandas(delete, packed.schema), "archived")


def _inner_path(member: str) -> str:
    """Where a member goes: names from outside are resolved, and do not lead out."""
    parts: list[str] = []
    for part in member.replace("\\", "/").split("/"):
        if part == "..":
            parts[-1:] = []
        elif part not in ("", "."):
            parts.append(part)
    return "/".join(parts)


_MEMBER = "archive string, number int, member string, inner string, length long, crc long"


def _members(spark: SparkSession, folder: str, members: str) -> DataFrame:
    """The members of a folder's zip files whose last name fits the glob, by their number in the archive."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                filesystem, path = open_uri(uri)
                with filesystem.open_input_file(path) as file, zipfile.ZipFile(file) as packed:
                    held = [
                        (uri, number, info.filename, _inner_path(info.filename), info.file_size, info.CRC)
                        for number, info in enumerate(packed.infolist())
                        if not info.is_dir() and fnmatch.fnmatchcase(info.filename.rsplit("/", 1)[-1], members)
                    ]
                if held:
                    yield pd.DataFrame(held, columns=["archive", "number", "member", "inner", "length", "crc"])

    archives = _spread(list_files(spark, folder, "*.[zZ][iI][pP]").select("path"), "path")
    return _spread(archives.mapInPandas(found, _MEMBER), "archive", "number")


def _unpacked(members: DataFrame, label: str) -> DataFrame:
    """Write each member to its ``place``, at once; adds ``header`` (its first line) and ``layout`` (of it).

    ``place`` is a path on the file system of the archive. ``{layout}`` in it
    stands for the layout. A member is written beside its place and moved there,
    so a repeated task replaces it by the same content.
    """

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = []
            for row in batch.itertuples(index=False):
                filesystem, path = open_uri(row.archive)
                with filesystem.open_input_file(path) as file, zipfile.ZipFile(file) as packed:
                    with packed.open(packed.infolist()[row.number]) as raw:
                        first = raw.readline()
                        header = first.decode("utf-8-sig", "replace").rstrip("\r\n")
                        layout = hashlib.md5(header.encode()).hexdigest()[:16]
                        place = beside(row.archive, row.place.replace("{layout}", layout))
                        sink, sink_path = open_uri(place)
                        above, _, name = sink_path.rpartition("/")
                        sink.create_dir(above, recursive=True)
                        partial = f"{above}/.{name[:40]}.{uuid.uuid4().hex}.tmp"
                        with sink.open_output_stream(partial) as out:
                            out.write(first)
                            while block := raw.read(_CHUNK_BYTES):
                                out.write(block)
                        sink.move(partial, sink_path)
                done.append((place, header, layout))
            more = pd.DataFrame(done, columns=["place", "header", "layout"], dtype=str)
            yield pd.concat([batch.drop(columns="place").reset_index(drop=True), more], axis=1)

    rest = members.drop("place")
    schema = T.StructType([*rest.schema.fields, *T.StructType.fromDDL("place string, header string, layout string")])
    return stage(members.select(*rest.columns, "place").mapInPandas(expand, schema), label)


class _Manifest:
    """What was unpacked into a folder: rows in the folder ``_<name>.unpacked`` beside it."""

    SCHEMA = f"{_MEMBER}, path string, header string, layout string, held string, run string"

    def __init__(self, spark: SparkSession, target: str, near: str) -> None:
        above, _, name = beside(near, target.rstrip("/")).rpartition("/")
        self.spark = spark
        self.place = f"{above}/_{name}.unpacked"
        self.entries = f"{self.place}/entries"

    def rows(self) -> DataFrame:
        if not exists(self.entries):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.entries)

    def held(self, run: str) -> str:
        return f"{self.place}/files/{run}"

    def finish(self) -> None:
        """Move what a committed run holds to its place; drop what a run that did not commit left."""
        files = f"{self.place}/files"
        if not exists(files):
            return
        filesystem, path = open_uri(files)
        runs = [info.base_name for info in filesystem.get_file_info(fs.FileSelector(path))]

        def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    filesystem, held = open_uri(row.held)
                    # A repeated task finds some of its files moved.
                    if filesystem.get_file_info(held).type != fs.FileType.NotFound:
                        _, place = open_uri(beside(row.held, row.path))
                        filesystem.create_dir(place.rsplit("/", 1)[0], recursive=True)
                        filesystem.move(held, place)
                yield batch[["held"]]

        if runs:
            committed = self.rows().where(F.col("run").isin(runs)).select("held", "path")
            stage(_spread(committed, "held").mapInPandas(move, "held string"), "moved")
        for run in runs:
            filesystem.delete_dir(f"{path}/{run}")


def expand_archives(
    spark: SparkSession,
    folder: str,
    target: str,
    members: str = "*",
    clash: str = "error",
    consumed: str | None = None,
) -> DataFrame:
    """Unpack the members of a folder's zip files into the folder ``target``, each once.

    Members keep their paths. A manifest beside the target, one row for each
    unpacked member with its checksum, decides what is new: a second call unpacks
    nothing, also when the files have been taken away, and a member that changed
    replaces what it left. Members are written aside, then the manifest is
    committed, then they are moved; a call that died in between is finished, or
    undone, by the next one.

    Two members of one path, or a file at a member's place that comes from
    elsewhere, are an error before anything is written; with ``clash="rename"``
    the later one (by archive and order in it) gets a number behind its name,
    ``x-2.csv``, as incremental loads take it. Archives are moved to the folder
    ``consumed``, if given, when their members are there. Returns ``(archive,
    member, path, header, layout)`` of what was unpacked now; files can then be
    read in parts, packed members cannot.
    """
    if clash not in ("error", "rename"):
        raise ValueError(f"unknown option {clash!r} for clash; known: error, rename")
    target = target.rstrip("/")
    found = stage(_members(spark, folder, members), "members")
    first = found.select("archive").first()
    if first is None:
        return spark.createDataFrame([], "archive string, member string, path string, header string, layout string")
    manifest = _Manifest(spark, target, first["archive"])
    manifest.finish()
    known = manifest.rows()
    own = ["archive", "member", "length", "crc"]
    fresh = found.join(known.select(*own), own, "left_anti")
    run = uuid.uuid4().hex
    placed = stage(_without_clash(spark, fresh, known, beside(first["archive"], target), clash), "places")
    name = F.md5(F.concat_ws("/", "archive", F.col("number").cast("string")))
    held = F.concat(F.lit(f"{path_of(manifest.held(run))}/"), name)
    written = _unpacked(placed.withColumn("place", held), "unpacked")
    entries = written.withColumnRenamed("place", "held").withColumn("run", F.lit(run))
    if not entries.isEmpty():
        entries.select(*known.columns).write.mode("append").parquet(manifest.entries)
    manifest.finish()
    if consumed is not None:
        _move_files(found.select("archive").distinct(), consumed)
    # The path again with the file system that all of it is on.
    system = F.regexp_extract("held", "^[A-Za-z][A-Za-z0-9+.-]*://[^/]+", 0)
    return entries.select("archive", "member", F.concat(system, "path").alias("path"), "header", "layout")


def _without_clash(spark: SparkSession, fresh: DataFrame, known: DataFrame, target: str, clash: str) -> DataFrame:
    """``fresh`` with the ``path`` of each member within its file system, no two alike."""
    folder = path_of(target)
    wanted = fresh.withColumn("path", F.concat(F.lit(f"{folder}/"), F.col("inner")))
    # A changed member goes where its earlier state went.
    before = known.groupBy("archive", "member").agg(F.max("path").alias("before"))
    wanted = wanted.join(before, ["archive", "member"], "left")
    old = wanted.where("before IS NOT NULL").withColumn("path", F.col("before"))
    order = Window.partitionBy("path").orderBy("archive", "number")
    new = wanted.where("before IS NULL").withColumn("turn", F.row_number().over(order))
    there = known.select("path").limit(0)
    if exists(target):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(target)
        there = listed.select(F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "").alias("path"))
    there = there.withColumn("there", F.lit(1))
    if clash == "error":
        some = new.join(there, "path", "left").where("turn > 1 OR there = 1").limit(3).collect()
        if some:
            named = "; ".join(f"{row['member']} of {row['archive']}" for row in some)
            raise LandingError(f"other members or files are at the places of: {named}")
    else:
        # Numbers go on behind those that earlier calls gave out for the same place.
        place = F.concat(F.lit(f"{folder}/"), F.col("inner")).alias("path")
        earlier = known.groupBy(place).agg(F.count(F.lit(1)).alias("earlier"))
        new = new.join(earlier, "path", "left").join(there, "path", "left")
        turn = F.col("turn") + F.coalesce("earlier", "there", F.lit(0))
        parts = r"^(.*/[^/]+?)(\.[^./]*)?$"
        numbered = F.concat(
            F.regexp_extract("path", parts, 1), F.lit("-"), turn.cast("string"), F.regexp_extract("path", parts, 2)
        )
        new = new.withColumn("path", F.when(turn > 1, numbered).otherwise(F.col("path"))).drop("there")
        taken = known.select("path").unionByName(there.select("path")).unionByName(new.select("path")).groupBy("path").count()
        twice = new.join(taken.where("count > 1"), "path", "left_semi").first()
        if twice is not None:
            raise LandingError(f"the numbered name of {twice['member']} of {twice['archive']} is taken too")
    columns = [*fresh.columns, "path"]
    return _spread(new.select(columns).unionByName(old.select(columns)), "archive", "number")


def _move_files(files: DataFrame, target: str) -> None:
    """Move each file of the one column to a folder, on its own file system."""
    target = target.rstrip("/")

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch.iloc[:, 0]:
                filesystem, path = open_uri(uri)
                _, place = open_uri(beside(uri, f"{target}/{path.rsplit('/', 1)[1]}"))
                if filesystem.get_file_info(path).type != fs.FileType.NotFound:
                    filesystem.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    filesystem.move(path, place)
            yield batch

    stage(_spread(files, files.columns[0]).mapInPandas(move, files.schema), "moved")


def read_zip_lines(spark: SparkSession, folder: str, members: str = "*") -> DataFrame:
    """``(archive, member, line_no, line)`` of the members of a folder's zip files."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                filesystem, path = open_uri(row.archive)
                with (
                    filesystem.open_input_file(path) as file,
                    zipfile.ZipFile(file) as packed,
                    packed.open(packed.infolist()[row.number]) as raw,
                ):
                    text = io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace")
                    yield from _line_batches(row.archive, row.member, text)

    return _members(spark, folder, members).mapInPandas(
        lines, "archive string, member string, line_no bigint, line string"
    )


def _line_batches(archive: str, member: str, text) -> Iterator[pd.DataFrame]:
    first, held, size = 0, [], 0

    def batch() -> pd.DataFrame:
        numbers = range(first, first + len(held))
        return pd.DataFrame(
            {"archive": archive, "member": member, "line_no": numbers, "line": held}
        )

    for line in text:
        held.append(line.rstrip("\n"))
        size += len(line)
        if len(held) >= _LINES_PER_BATCH or size >= _CHARS_PER_BATCH:
            yield batch()
            first, held, size = first + len(held), [], 0
    if held:
        yield batch()


def read_zip_csv(
    spark: SparkSession,
    folder: str,
    columns: list[str] | None = None,
    members: str = "*",
    sep: str = ",",
    escape: str = "\\",
) -> DataFrame:
    """The members of a folder's zip files as CSV with a header each, all columns strings.

    Members are unpacked into the shared folder and read from there, each under
    its own header: the same columns may come in any order. ``columns``
    replaces the names by position. Members with other columns are an error.
    """
    target = scratch_path(spark, "unpacked")
    # Members of one path or name are told apart by the archive and their number in it.
    place = F.concat_ws("/", F.lit(path_of(target)), F.lit("{layout}"), F.md5("archive"), F.col("number").cast("string"), F.element_at(F.split("inner", "/"), -1))
    expanded = _unpacked(_members(spark, folder, members).withColumn("place", place), "expanded")
    parts = []
    # As many layouts as there are different header lines.
    for row in expanded.select("layout").distinct().orderBy("layout").collect():
        reader = spark.read.option("header", True).option("sep", sep).option("escape", escape)
        part = reader.option("recursiveFileLookup", True).csv(f"{target}/{row['layout']}")
        if columns is not None and len(columns) != len(part.columns):
            raise ColumnError(f"{len(columns)} names for the columns {part.columns}")
        parts.append(part if columns is None else part.toDF(*columns))
    for part in parts[1:]:
        if set(part.columns) != set(parts[0].columns):
            raise ColumnError(f"members have columns {parts[0].columns} and {part.columns}")
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{name}` string" for name in columns or ()) or "struct<>")
    return functools.reduce(DataFrame.unionByName, parts)
