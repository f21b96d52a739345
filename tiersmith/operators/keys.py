"""Row numbers, surrogate keys, neighbours in an order, and column pairs."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.errors import ColumnError
from tiersmith.operators.columns import column, require_columns
from tiersmith.session import stage

# Tasks get the code of their functions, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# monotonically_increasing_id keeps the row's place in its partition in the
# lower 33 bits and the partition above them.
_PLACE_BITS = 33


def number_rows(df: DataFrame, keys: Sequence[str], name: str = "row_no") -> DataFrame:
    """``row_number()`` over ``keys`` without gathering the rows in one task.

    The rows are range partitioned and sorted, and get the place in their
    partition plus the number of rows in the partitions before. Only the count
    of each partition is brought together. ``keys`` must be unique, or the
    numbers of equal rows are arbitrary.
    """
    order = [column(key) for key in keys]
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id())
    )
    placed = stage(placed, "numbered")
    partition = F.shiftrightunsigned("__place", _PLACE_BITS)
    counts = placed.groupBy(partition.alias("__partition")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__partition",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"),
    )
    place = F.col("__place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    # One row per shuffle partition: small by construction.
    return (
        placed.withColumn("__partition", partition)
        .join(F.broadcast(offsets), "__partition")
        .select(*[column(c) for c in df.columns], (place + F.col("__offset") + 1).alias(name))
    )


def surrogate_key(df: DataFrame, keys: Sequence[str], name: str = "id") -> DataFrame:
    """The distinct ``keys`` with a dense number 1..N in key order, number first."""
    require_columns(df, keys)
    distinct = df.select(*[column(key) for key in keys]).distinct()
    numbered = number_rows(distinct, keys, name)
    return numbered.select(column(name), *[column(key) for key in keys])


def sparse_id(df: DataFrame, name: str = "id") -> DataFrame:
    """A unique but not dense number for each row."""
    return df.withColumn(name, F.monotonically_increasing_id())


def _beside_next(width: int):
    """Each row of a sorted partition with the row behind it, and where the partition begins and ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def joined(batch: pa.RecordBatch, behind: pa.RecordBatch | None, first: bool) -> pa.RecordBatch:
            n = batch.num_rows
            tail = batch.slice(0, 0) if behind is None else behind.slice(0, 1)
            following = []
            for own, next_ in zip(batch.columns, tail.columns, strict=True):
                column = pa.concat_arrays([own.slice(1), next_])
                missing = n - len(column)
                following.append(pa.concat_arrays([column, pa.nulls(missing, own.type)]) if missing else column)
            begins = [first] + [False] * (n - 1)
            ends = [False] * (n - 1) + [behind is None]
            names = [f"c{i}" for i in range(width)] + [f"n{i}" for i in range(width)]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, *following, pa.array([part] * n, pa.int32()), pa.array(begins), pa.array(ends)],
                names=[*names, "part", "begins", "ends"],
            )

        held, first = None, True
        for batch in batches:
            if batch.num_rows:
                if held is not None:
                    yield joined(held, batch, first)
                    first = False
                held = batch
        if held is not None:
            yield joined(held, None, first)

    return run


def with_next(
    df: DataFrame,
    value: str,
    order_by: Sequence[str],
    series: Sequence[str] = (),
    name: str = "next_value",
) -> DataFrame:
    """``lead(value)`` over the distinct (series, order, value) rows.

    A window per series would sort a series in one task, however long it is.
    Here the rows are range partitioned and sorted; a row finds its follower
    in its own partition, and the last one in the first row of the next
    partition. Only these first rows are brought together.
    """
    columns = list(dict.fromkeys([*series, *order_by, value]))
    rows = df.select(*[column(c).alias(f"c{i}") for i, c in enumerate(columns)]).distinct()
    order = [F.col(c) for c in rows.columns]
    width = len(columns)
    fields = list(rows.schema.fields)
    fields += [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(rows.schema.fields)]
    fields += [T.StructField("part", T.IntegerType())]
    fields += [T.StructField(flag, T.BooleanType()) for flag in ("begins", "ends")]
    paired = stage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_beside_next(width), T.StructType(fields)),
        "paired",
    )
    firsts = paired.where("begins").select("part", *[f"c{i}" for i in range(width)])
    ahead = Window.orderBy("part")
    # One row per shuffle partition: small by construction.
    followers = F.broadcast(
        firsts.select(
            "part",
            F.lead("part").over(ahead).isNotNull().alias("more"),
            *[F.lead(f"c{i}").over(ahead).alias(f"f{i}") for i in range(width)],
        )
    )
    behind = [F.when(F.col("ends"), F.col(f"f{i}")).otherwise(F.col(f"n{i}")) for i in range(width)]
    same = F.col("more") | ~F.col("ends")
    for key in series:
        i = columns.index(key)
        same = same & behind[i].eqNullSafe(F.col(f"c{i}"))
    return paired.join(followers, "part").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)],
        F.when(same, behind[columns.index(value)]).alias(name),
    )


def column_pairs(df: DataFrame, left: str, right: str, mode: str = "count") -> DataFrame:
    """The ``(left, right)`` pairs of all rows that have both values.

    ``mode="count"`` rejects the table when the two sides differ in their
    number of distinct values; ``mode="bijective"`` when any value of one side
    goes with two of the other. The check runs at once, on the cluster.
    """
    pairs = df.select(column(left).alias("left"), column(right).alias("right"))
    pairs = pairs.where(F.col("left").isNotNull() & F.col("right").isNotNull())
    if mode == "count":
        # Each side is counted over its own non-NULL values.
        sides = df.agg(
            F.count_distinct(column(left)).alias("left"),
            F.count_distinct(column(right)).alias("right"),
        ).first()
        rejected = sides["left"] != sides["right"]
    elif mode == "bijective":
        rejected = not (
            column_pair_conflicts(pairs, "left", "right").isEmpty()
            and column_pair_conflicts(pairs, "right", "left").isEmpty()
        )
    else:
        raise ValueError(f"unknown mode {mode!r}; known: bijective, count")
    if rejected:
        raise ColumnError("Duplicate value in pair")
    return pairs


def column_pair_conflicts(df: DataFrame, left: str, right: str) -> DataFrame:
    """The ``left`` values that go with more than one ``right`` value."""
    return (
        df.where(column(left).isNotNull())
        .groupBy(column(left).alias(left))
        .agg(F.count_distinct(column(right)).alias("distinct_values"))
        .where("distinct_values > 1")
    )
