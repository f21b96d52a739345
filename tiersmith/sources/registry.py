"""Surrogate keys that stay the same from run to run."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.operators.columns import column, require_columns
from tiersmith.operators.keys import number_rows
from tiersmith.session import stage
from tiersmith.sources.tables import AUDIT_COLUMN, read_table, save_table


class KeyRegistry:
    """A table of business keys and their numbers, which only grows.

    Keys it knows keep their number. New ones are numbered in key order behind
    the highest number there is and added in one append, so a run that dies
    before it leaves nothing, and one that dies after it finds its numbers again.
    Runs that number keys of one registry must follow each other.
    """

    def __init__(self, spark: SparkSession, location: str, database: str, table: str, name: str = "id") -> None:
        self.spark = spark
        self.location = location
        self.database = database
        self.table = table
        self.name = name

    def known(self, like: DataFrame) -> DataFrame:
        """The number and key columns of all keys so far; ``like`` has the key columns' types."""
        if self.spark.catalog.tableExists(f"`{self.database}`.`{self.table}`"):
            return read_table(self.spark, self.database, self.table).drop(AUDIT_COLUMN)
        return like.where(F.lit(False)).select(F.lit(0).cast("long").alias(self.name), "*")

    def assign(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The distinct ``keys`` of ``df``, NULL parts too, with their numbers first."""
        require_columns(df, keys)
        # Read twice, for what is new and for the answer: the numbers must fit what was looked up.
        distinct = stage(df.select(*[column(key) for key in keys]).distinct(), "keys")

        def same() -> Column:
            pairs = [F.col(f"k.`{key}`").eqNullSafe(F.col(f"r.`{key}`")) for key in keys]
            return functools.reduce(Column.__and__, pairs)

        known = self.known(distinct)
        new = distinct.alias("k").join(known.alias("r"), same(), "left_anti")
        last = known.agg(F.max(column(self.name))).first()[0] or 0
        number = (F.col("__number") + F.lit(last)).cast("long").alias(self.name)
        numbered = number_rows(new, keys, "__number").select(number, *[column(key) for key in keys])
        if not new.isEmpty():
            save_table(self.spark, numbered, self.location, self.database, self.table)
        registered = self.known(distinct).alias("r")
        found = distinct.alias("k").join(registered, same())
        return found.select(F.col(f"r.`{self.name}`"), *[F.col(f"k.`{key}`") for key in keys])
