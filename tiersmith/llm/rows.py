"""A name for each row that every later scan agrees on."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.session import stage

ROW = "__row"


def with_row_name(docs: DataFrame) -> DataFrame:
    """``docs`` and a column ``__row``: the row's file and its place in it.

    Rows read straight from Parquet are named by the file's metadata, which
    does not depend on how a scan is split. Others are staged first.
    """
    try:
        return _named(docs)
    except AnalysisException:
        return _named(stage(docs, "rows"))


def _named(docs: DataFrame) -> DataFrame:
    name = F.struct(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place"),
    )
    return docs.withColumn(ROW, name)
