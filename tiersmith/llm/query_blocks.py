"""A table of queries in blocks of bounded size, which tasks read one at a time.

Whatever is held against all documents (test items, search queries) may grow as
well. Its rows are dealt into blocks by a hash of the row's name, each block
becomes one file set in the shared folder, and a task holds one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import dataset
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith import files
from tiersmith.files import open_uri
from tiersmith.llm.rows import ROW, with_row_name
from tiersmith.session import scratch_path

cloudpickle.register_pickle_by_value(files)

BLOCK = "__block"


def dealt_into_blocks(items: DataFrame, limit: int) -> DataFrame:
    """``items`` with the name of each row and its block of about ``limit`` bytes of ``text``."""
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    block = F.pmod(F.xxhash64(f"{ROW}.file", f"{ROW}.place"), F.lit(-(-size // limit) or 1))
    return with_row_name(items).withColumn(BLOCK, block.cast("int"))


class Blocks:
    """Rows by block in the shared folder; tasks get this object, not the rows."""

    def __init__(self, path: str, numbers: list[int]) -> None:
        self.path = path
        self.numbers = numbers
        self._held: pa.Table | None = None

    @classmethod
    def write(cls, rows: DataFrame, label: str) -> Blocks:
        """Each block of ``rows`` (by ``__block``) goes to a folder of its own."""
        spark = rows.sparkSession
        path = scratch_path(spark, label)
        rows.repartition(BLOCK).write.partitionBy(BLOCK).parquet(path)
        # The partition folders alone answer this: one number a block reaches the driver.
        numbers = spark.read.schema(rows.schema).parquet(path).select(BLOCK).distinct().collect()
        return cls(path, sorted(row[0] for row in numbers))

    def __iter__(self) -> Iterator[pa.Table]:
        """The blocks one after the other; a single one is read once a task."""
        for number in self.numbers:
            if self._held is not None:
                yield self._held
                continue
            filesystem, place = open_uri(self.path)
            table = dataset.dataset(f"{place}/{BLOCK}={number}", filesystem=filesystem, format="parquet").to_table()
            if len(self.numbers) == 1:
                self._held = table
            yield table
