"""Layer jobs: transform, save each output, release what was cached."""

from __future__ import annotations

import json
import logging
from abc import ABC, abstractmethod
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from urllib.parse import quote

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.errors import TransformError
from tiersmith.files import exists, path_of, read_json, write_json
from tiersmith.operators.columns import apply_prefix, cast_table, clean_column_names
from tiersmith.operators.joins import star_join
from tiersmith.operators.quality import TableSpec, quality_gate
from tiersmith.session import stage
from tiersmith.sources.archives import archive_files
from tiersmith.sources.landing import PART_BYTES, Output, read_csv_tables
from tiersmith.sources.tables import compact_table, read_table, save_table
from tiersmith.streaming.incremental import ingest_new_files, without_load_columns

log = logging.getLogger(__name__)

# Tables of one job do not depend on each other; small ones leave room.
SAVES_AT_A_TIME = 4


class Transforms:
    """Named DataFrame functions that a configuration may refer to."""

    def __init__(self) -> None:
        self._known: dict[str, Callable] = {}

    def register(self, name: str):
        def keep(function):
            self._known[name] = function
            return function

        return keep

    def __getitem__(self, name: str) -> Callable:
        if name not in self._known:
            known = ", ".join(sorted(self._known)) or "none"
            raise TransformError(f"unknown transform {name!r}; known: {known}")
        return self._known[name]


class RunLedger:
    """Which tables of a run are finished, so that a rerun goes on behind them.

    Each finished table has one small file in the shared location, written when
    all its rows are saved. It counts as long as the table is there and its
    configuration is the same.
    """

    def __init__(self, spark: SparkSession, location: str, run: str) -> None:
        self.spark = spark
        self.folder = f"{location.rstrip('/')}/_runs/{run}"

    def _place(self, table: str) -> str:
        return f"{self.folder}/{quote(table, safe='')}.json"

    def finish(self, table: str, entry: object = None) -> None:
        write_json(self._place(table), {"table": table, "entry": entry})

    def finished(self, table: str, entry: object = None) -> bool:
        place = self._place(table)
        if not exists(place) or read_json(place)["entry"] != json.loads(json.dumps(entry)):
            return False
        database, name = table.split(".", 1)
        return self.spark.catalog.tableExists(f"`{database}`.`{name}`")


class LayerJob(ABC):
    """One layer's work. Subclasses say in ``transform`` what to save."""

    def __init__(
        self,
        spark: SparkSession,
        location: str,
        overwrite: bool = False,
        file_format: str = "parquet",
        run_ts: datetime | None = None,
        ledger: RunLedger | None = None,
    ) -> None:
        self.spark = spark
        self.ledger = ledger
        self.location = location
        self.overwrite = overwrite
        self.file_format = file_format
        self.run_ts = run_ts
        self._cached: list[DataFrame] = []
        self._entries: dict[str, dict] = {}

    @abstractmethod
    def transform(self) -> list[Output]:
        """The outputs of this layer."""

    def unfinished(self, config: dict[str, dict], database: str) -> dict[str, dict]:
        """What of a configuration an earlier run with the same ledger has not finished."""
        if self.ledger is None:
            return config
        self._entries = {f"{database}.{table}": entry for table, entry in config.items()}
        left = {t: e for t, e in config.items() if not self.ledger.finished(f"{database}.{t}", e)}
        for table in config.keys() - left.keys():
            log.info("%s.%s is finished already", database, table)
        return left

    def cache(self, df: DataFrame) -> DataFrame:
        """Keep a DataFrame that several actions of this run read."""
        cached = df.persist()
        self._cached.append(cached)
        return cached

    def run(
        self, partition_by: Sequence[str] | str | None = None, optimize_table: bool = False
    ) -> list[Output]:
        """Save all outputs, several at a time, and return them.

        If any cannot be saved the job fails, after the others were tried.
        """

        def save(output: Output) -> None:
            database, table = output.table.split(".", 1)
            save_table(
                self.spark,
                output.df,
                self.location,
                database,
                table,
                self.file_format,
                self.overwrite,
                optimize_table,
                partition_by,
                self.run_ts,
            )
            if self.ledger is not None:
                self.ledger.finish(output.table, self._entries.get(output.table))

        try:
            outputs = self.transform()
            with ThreadPoolExecutor(SAVES_AT_A_TIME) as pool:
                target = inheritable_thread_target(self.spark)(save)
                for done in [pool.submit(target, output) for output in outputs]:
                    done.result()
            return outputs
        except Exception:
            log.exception("%s failed", type(self).__name__)
            raise
        finally:
            while self._cached:
                self._cached.pop().unpersist()


class BronzeJob(LayerJob):
    """Landing CSV files as tables with clean column names.

    With ``archive`` the files that were loaded, and no others that may have
    arrived since, are packed into that folder and removed from landing.
    ``line_breaks`` allows them within quoted fields; files are then read in
    parts of ``part_bytes``.
    """

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        location: str,
        database: str,
        config: dict[str, dict],
        sep: str = ",",
        missing: str = "error",
        archive: str | None = None,
        line_breaks: bool = False,
        part_bytes: int = PART_BYTES,
        escape: str = "\\",
        **options,
    ) -> None:
        super().__init__(spark, location, **options)
        self.line_breaks = line_breaks
        self.part_bytes = part_bytes
        self.escape = escape
        self.archive = archive
        self.landing = landing.rstrip("/")
        self.database = database
        self.config = config
        self.sep = sep
        self.missing = missing

    def transform(self) -> list[Output]:
        loaded = read_csv_tables(
            self.spark, self.landing, self.unfinished(self.config, self.database), self.database, self.sep, self.missing,
            self.line_breaks, self.part_bytes, self.escape,
        )
        return [Output(output.table, clean_column_names(output.df), output.files) for output in loaded]

    def run(self, *args, **options) -> list[Output]:
        outputs = super().run(*args, **options)
        loaded = [(path, path_of(path)[len(path_of(self.landing)) + 1 :]) for output in outputs for path in output.files]
        if self.archive is not None and loaded:
            stamp = (self.run_ts or datetime.now()).strftime("%Y%m%dT%H%M%S")
            files = self.spark.createDataFrame(loaded, "path string, name string").distinct()
            archive_files(stage(files, "loaded"), f"{self.archive.rstrip('/')}/{stamp}")
        return outputs


#: What may stand behind a file's name: a number, date or time with these characters.
_STAMP = "[-_.0-9TZ]"
_STAMP_LENGTH = 40


def _numbered(file_name: str) -> str:
    """A glob for ``<file_name>.csv`` and those with a number behind the name, and for no other table's files."""
    more = ",".join(_STAMP * n for n in range(_STAMP_LENGTH + 1))
    return f"{file_name}{{,[-_.][0-9]{{{more}}}}}.csv"


class IncrementalBronzeJob(BronzeJob):
    """The same tables, from the files that no earlier run has loaded.

    A table's files are ``<file_name>.csv`` and, as more arrive, the same name
    with a point, hyphen or underscore and a number, date or time behind it, of
    40 more digits, points, hyphens, underscores, T and Z at most. Their columns
    may come in any order. With
    ``archive`` they are moved to that folder once a later run has loaded more.
    Earlier loads stay, so ``overwrite`` is an error.
    """

    def __init__(self, *args, checkpoint: str, **options) -> None:
        super().__init__(*args, **options)
        if self.overwrite:
            raise ValueError("an incremental load does not overwrite; use BronzeJob")
        self.checkpoint = checkpoint.rstrip("/")

    def run(
        self, partition_by: Sequence[str] | str | None = None, optimize_table: bool = False
    ) -> list[Output]:
        """Load what is new and return the tables, each with all its loads."""
        keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
        outputs = []
        for table, entry in self.config.items():
            try:
                ingest_new_files(
                    self.spark,
                    f"{self.landing}/{_numbered(entry['file_name'])}",
                    self.location,
                    self.database,
                    table,
                    f"{self.checkpoint}/{table}",
                    self.archive,
                    sep=self.sep,
                    run_ts=self.run_ts,
                    file_format=self.file_format,
                    partition_by=keys,
                    escape=self.escape,
                    line_breaks=self.line_breaks,
                )
            except AnalysisException as error:
                if self.missing == "error" or error.getCondition() != "PATH_NOT_FOUND":
                    raise
                log.warning("no file yet for table %s", table)
                continue
            if optimize_table:
                compact_table(self.spark, self.database, table)
            loaded = without_load_columns(read_table(self.spark, self.database, table))
            outputs.append(Output(f"{self.database}.{table}", loaded))
        return outputs


class SilverJob(LayerJob):
    """Bronze tables transformed, prefixed, cast to their specs, and checked.

    ``validate`` is ``"off"``, ``"report"`` (log what failed) or ``"strict"``
    (fail the run before anything is saved, after all tables were checked).

    Checks read only their own columns, so by default the transforms run again
    for them; ``cache_checked`` keeps the results for the save instead, which
    pays for costly transforms whose results fit the executors.
    """

    def __init__(
        self,
        spark: SparkSession,
        location: str,
        src_database: str,
        dst_database: str,
        config: dict[str, dict],
        specs: dict[str, TableSpec],
        transforms: Transforms,
        validate: str = "report",
        cache_checked: bool = False,
        **options,
    ) -> None:
        if validate not in ("off", "report", "strict"):
            raise ValueError(f"unknown validation {validate!r}; known: off, report, strict")
        super().__init__(spark, location, **options)
        self.src_database = src_database
        self.dst_database = dst_database
        self.config = config
        self.specs = specs
        self.transforms = transforms
        self.validate = validate
        self.cache_checked = cache_checked

    def transform(self) -> list[Output]:
        tables: list[tuple[DataFrame, TableSpec]] = []
        config = self.unfinished(self.config, self.dst_database)
        for table, entry in config.items():
            df = read_table(self.spark, self.src_database, entry["src_name"])
            df = self.transforms[entry["transformation"]](df)
            if "prefix" in entry:
                df = apply_prefix(df, entry["prefix"])
            df = cast_table(df, self.specs[table].schema)
            if self.cache_checked:
                df = self.cache(df)
            tables.append((df, self.specs[table]))
        if self.validate != "off" and tables:
            quality_gate(tables, strict=self.validate == "strict")
        return [
            Output(f"{self.dst_database}.{table}", df) for table, (df, _) in zip(config, tables)
        ]


gold_transforms = Transforms()


@gold_transforms.register("star_join")
def build_star(read: Callable[[str], DataFrame], entry: dict) -> DataFrame:
    """A source table with others joined on, one after another."""
    joins = [(read(step["table"]), tuple(step["column_pairs"])) for step in entry["join_tables"]]
    return star_join(read(entry["src_table"]), joins)


class GoldJob(LayerJob):
    """Wide tables, each built from silver tables by the transform it names.

    Such a transform gets a function that reads a silver table, and the
    table's configuration.
    """

    def __init__(
        self,
        spark: SparkSession,
        location: str,
        src_database: str,
        dst_database: str,
        config: dict[str, dict],
        transforms: Transforms = gold_transforms,
        **options,
    ) -> None:
        super().__init__(spark, location, **options)
        self.src_database = src_database
        self.dst_database = dst_database
        self.config = config
        self.transforms = transforms

    def transform(self) -> list[Output]:
        def read(table: str) -> DataFrame:
            return read_table(self.spark, self.src_database, table)

        return [
            Output(f"{self.dst_database}.{table}", self.transforms[entry["transformation"]](read, entry))
            for table, entry in self.unfinished(self.config, self.dst_database).items()
        ]
