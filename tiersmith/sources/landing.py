"""CSV files of a landing folder."""

from __future__ import annotations

import functools
import logging
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiersmith import files as uri_files
from tiersmith.errors import ColumnError
from tiersmith.files import open_uri

# Tasks get the code of their functions, not a reference to this package.
for _module in (sys.modules[__name__], uri_files):
    cloudpickle.register_pickle_by_value(_module)

#: Bytes of a file that one task reads.
PART_BYTES = 32 << 20
_CHUNK_BYTES = 1 << 20

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Output:
    """A DataFrame, the ``database.table`` it belongs to, and the landing files it reads."""

    table: str
    df: DataFrame
    files: tuple[str, ...] = ()


def list_files(
    spark: SparkSession, folder: str, include: str = "*", exclude: tuple[str, ...] = ()
) -> DataFrame:
    """``(path, name, length)`` of the files in a folder, content unread.

    ``include`` is a glob on names; ``exclude`` lists exact names.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", include).load(folder)
    ).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")
    return files.where(~F.col("name").isin(list(exclude))) if exclude else files


def read_csv(
    spark: SparkSession, path: str, sep: str = ",", escape: str = "\\", multiline: bool = False
) -> DataFrame:
    """A CSV file, or a folder of them, with a header and all columns strings.

    Lines are records, so large files are read in parts; ``multiline`` allows
    line breaks in quoted fields, and takes each file as a whole. Large files
    with line breaks are for ``read_csv_records``.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("escape", escape)
    return reader.option("multiLine", multiline).csv(path)


def _toggles(data: np.ndarray, escape: int, before: int) -> np.ndarray:
    """Which bytes are quotes that open or close a field; ``before`` escapes stand in front of the data."""
    quotes = data == 34
    if escape == 34:  # doubled quotes close and open again
        return quotes
    # A quote behind an odd number of escapes is part of a value.
    for at in np.flatnonzero(quotes[1:] & (data[:-1] == escape)) + 1:
        run = 0
        while run < at and data[at - 1 - run] == escape:
            run += 1
        run += before if run == at else 0
        quotes[at] = run % 2 == 0
    if len(data) and quotes[0] and before % 2:
        quotes[0] = False
    return quotes


def _texts(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """Pieces of the data, with nothing but line ends between them, without those behind them; empty ones are left out."""
    ends, left = ends.copy(), np.arange(len(ends))
    while len(left):
        left = left[ends[left] > begins[left]]
        last = data[ends[left] - 1]
        left = left[(last == 10) | (last == 13)]
        ends[left] -= 1
    some = ends > begins
    begins, ends = begins[some], ends[some]
    if not len(begins):
        return pa.array([], pa.string())
    try:
        data[begins[0] : ends[-1]].tobytes().decode()
    except UnicodeDecodeError:
        pieces = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(begins, ends, strict=True)]
        return pa.array(pieces, pa.string())
    # The bytes of all pieces, one behind the other.
    edges = np.zeros(len(data) + 1, np.int8)
    edges[begins], edges[ends] = 1, -1
    kept = data[np.cumsum(edges[:-1], dtype=np.int8).view(bool)]
    at = np.append(0, np.cumsum(ends - begins))
    return pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(at), pa.py_buffer(kept)).cast(pa.string())


class _Part:
    """A byte range of a file."""

    def __init__(self, uri: str, start: int, end: int, escape: str) -> None:
        self.start, self.end, self.escape = start, end, ord(escape)
        filesystem, path = open_uri(uri)
        self.file = filesystem.open_input_file(path)
        self.size = self.file.size()
        self.data = self._read(start, end - start)
        self.before = 0  # escapes in front
        while start - self.before > 0 and self._read(start - self.before - 1, 1)[0] == self.escape:
            self.before += 1

    def _read(self, at: int, count: int) -> np.ndarray:
        self.file.seek(at)
        return np.frombuffer(self.file.read(count), np.uint8)

    def inside(self, state: int) -> np.ndarray:
        """Whether a field is open behind each byte; ``state`` says so for the byte before."""
        return np.bitwise_xor.accumulate(np.append(np.uint8(state), self.toggles().view(np.uint8)))[1:]

    def toggles(self) -> np.ndarray:
        return _toggles(self.data, self.escape, self.before)

    def records(self, state: int) -> pa.StringArray:
        """The records that begin in the part, the last one to its end; blank ones are left out."""
        inside = self.inside(state)
        begins = np.flatnonzero((self.data == 10) & (inside == 0)) + 1
        if self.start == 0 or (state == 0 and self._read(self.start - 1, 1)[0] == 10):
            begins = np.append(0, begins)
        data = self.data
        if len(begins) and begins[-1] == len(data):  # the next part begins with a record
            begins = begins[:-1]
        elif len(begins):
            data = np.append(data, np.frombuffer(self._rest(int(inside[-1])), np.uint8))
        if not len(begins):
            return pa.array([], pa.string())
        ends = np.append(begins[1:], len(data))
        if self.start == 0:
            begins, ends = begins[1:], ends[1:]  # the header
        return _texts(data, begins, ends)

    def _rest(self, state: int) -> bytes:
        """From the end of the part to the end of the record that is open there."""
        out, at = b"", self.end
        escapes = 0
        for byte in self.data[::-1]:
            if byte != self.escape:
                break
            escapes += 1
        while at < self.size:
            data = self._read(at, _CHUNK_BYTES)
            inside = np.bitwise_xor.accumulate(np.append(np.uint8(state), _toggles(data, self.escape, escapes).view(np.uint8)))[1:]
            ends = np.flatnonzero((data == 10) & (inside == 0))
            if len(ends):
                return out + data[: ends[0]].tobytes()
            out += data.tobytes()
            state, at = int(inside[-1]), at + len(data)
            other = np.flatnonzero(data != self.escape)
            escapes = len(data) - 1 - int(other[-1]) if len(other) else escapes + len(data)
        return out


def csv_records(spark: SparkSession, paths: Sequence[str], escape: str = "\\", part_bytes: int = PART_BYTES) -> DataFrame:
    """The records of CSV files but for their headers, one string each; fields may hold line breaks.

    Files are read in parts by several tasks. A first pass counts the quotes of
    every part; their running sum over the file says whether a part begins
    within a quoted field, and so which line breaks end a record. A record
    belongs to the part it begins in. Quotes must enclose fields or be escaped.
    """
    files = spark.read.format("binaryFile").load([_literal(path) for path in paths]).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(part_bytes).cast("long")))
    parts = files.where("length > 0").select("path", starts.alias("start"), "length")
    # A few parts for each task, whatever the size of these rows, and as many for one as for another:
    # by hash some would get twice their share. One row is a part of a file, so numbering them is little work.
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    turn = (F.row_number().over(Window.orderBy("path", "start")) % tasks).alias("turn")
    parts = parts.select("path", "start", F.least(F.col("start") + part_bytes, "length").alias("end"), turn)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odd = [int(_Part(r.path, r.start, r.end, escape).toggles().sum()) % 2 for r in batch.itertuples(index=False)]
            yield batch.assign(odd=pd.Series(odd, dtype="int32"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end, state in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                yield pa.RecordBatch.from_arrays([_Part(path, start, end, escape).records(state)], names=["record"])

    counted = parts.repartitionById(tasks, "turn").mapInPandas(count, "path string, start long, end long, turn int, odd int")
    ahead = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    state = (F.coalesce(F.sum("odd").over(ahead), F.lit(0)) % 2).cast("int")
    known = counted.withColumn("state", state).select("path", "start", "end", "state", "turn")
    return known.repartitionById(tasks, "turn").mapInArrow(cut, "record string")


def _literal(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_csv_records(
    spark: SparkSession, paths: Sequence[str], sep: str = ",", escape: str = "\\", part_bytes: int = PART_BYTES
) -> DataFrame:
    """CSV files of one header, all columns strings, with line breaks in quoted fields, read in parts.

    The header is one line. See ``csv_records`` for how records are found.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("escape", escape)
    names = reader.csv(_literal(paths[0])).columns
    schema = ", ".join(f"c{i} STRING" for i in range(len(names)))
    records = csv_records(spark, paths, escape, part_bytes)
    fields = F.from_csv("record", F.lit(schema), {"sep": sep, "escape": escape})
    return records.select(fields.alias("fields")).select("fields.*").toDF(*names)


def headers(files: DataFrame) -> DataFrame:
    """``(path, header)`` of files by ``path``: their first lines, read without the rest."""

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = []
            for uri in batch["path"]:
                filesystem, path = open_uri(uri)
                with filesystem.open_input_stream(path) as file:
                    line = b""
                    while b"\n" not in line and (block := file.read(4096)):
                        line += block
                lines.append(line.split(b"\n", 1)[0].decode("utf-8-sig", "replace").rstrip("\r"))
            yield pd.DataFrame({"path": batch["path"], "header": lines})

    tasks = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.select("path").repartition(tasks, "path").mapInPandas(first, "path string, header string")


def read_by_header(
    spark: SparkSession, files: DataFrame, sep: str = ",", escape: str = "\\", line_breaks: bool = False
) -> DataFrame | None:
    """Files by ``path`` as one table, each read under its own header; None if all are empty.

    The same columns may come in any order; files with others are an error.
    """
    layouts: dict[str, list[str]] = {}
    # The files of a load are listed on the driver, as Spark does itself to plan a scan.
    for row in headers(files).orderBy("path").collect():
        if row["header"]:
            layouts.setdefault(row["header"], []).append(row["path"])
    parts = []
    for paths in layouts.values():
        if line_breaks:
            parts.append(read_csv_records(spark, paths, sep, escape))
        else:
            reader = spark.read.option("header", True).option("sep", sep).option("escape", escape)
            parts.append(reader.option("enforceSchema", False).csv([_literal(path) for path in paths]))
    for part in parts[1:]:
        if sorted(part.columns) != sorted(parts[0].columns):
            raise ColumnError(f"files have the columns {parts[0].columns} and {part.columns}")
    return functools.reduce(DataFrame.unionByName, parts) if parts else None


def read_csv_tables(
    spark: SparkSession,
    landing: str,
    config: dict[str, dict],
    database: str,
    sep: str = ",",
    missing: str = "error",
    line_breaks: bool = False,
    part_bytes: int = PART_BYTES,
    escape: str = "\\",
) -> list[Output]:
    """``<file_name>.csv`` of the landing folder for each configured table.

    A table without its file is an error, or left out with ``missing="skip"``.
    ``line_breaks`` are those within quoted fields.
    """
    if missing not in ("error", "skip"):
        raise ValueError(f"unknown option {missing!r} for missing; known: error, skip")
    outputs = []
    for table, entry in config.items():
        path = f"{landing.rstrip('/')}/{entry['file_name']}.csv"
        try:
            df = read_csv(spark, path, sep, escape)
            # What the scan has listed, and no file that may arrive later.
            files = tuple(unquote(file) for file in df.inputFiles())
            if line_breaks and files:
                df = read_csv_records(spark, files, sep, escape, part_bytes)
            outputs.append(Output(f"{database}.{table}", df, files))
        except AnalysisException as error:
            if missing == "error" or error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("no file %s for table %s", path, table)
    return outputs


def write_csv(df: DataFrame, path: str, escape: str = "\\") -> None:
    """A folder of CSV files with a header each; blanks around values are kept."""
    writer = df.write.option("header", True).option("escape", escape)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
