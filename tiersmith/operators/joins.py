"""Equi-joins on one pair of differently named keys, and chains of them."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.errors import ColumnError
from tiersmith.operators.columns import column, reject_duplicates

# The spellings Spark accepts -> one name for each join type.
JOIN_TYPES = {
    "inner": "inner",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "outer": "full",
    "full": "full",
    "fullouter": "full",
    "semi": "semi",
    "leftsemi": "semi",
    "anti": "anti",
    "leftanti": "anti",
}

_LEFT, _RIGHT = "__left_key", "__right_key"
# A key is hot when it alone has more rows than this many tasks should take.
HOT_TASKS = 2
# Its salts are this many for each task it calls for, so tasks get even shares
# though salts are dealt to them by hash.
SALTS_PER_TASK = 4


def join_table(
    left_table: DataFrame,
    right_table: DataFrame,
    join_pair: tuple[str, str],
    how: str,
    drop_joined_column: bool = True,
    other_drop_columns: Sequence[str] | None = None,
    salt: bool | None = None,
) -> DataFrame:
    """Join ``left.join_pair[0] == right.join_pair[1]``; NULL keys never match.

    The result holds the left columns and then the right ones, without the two
    keys unless ``drop_joined_column`` is false, and without
    ``other_drop_columns``, which are pruned on both sides before the join.

    Spark picks the algorithm and, at run time, splits skewed partitions. In
    outer joins it can only split the side whose rows are all kept, and neither
    side of a full one. So by default the keys of the other side, unless Spark
    takes it to be small enough to broadcast, are looked over when the join is
    built, in one job, and hot and NULL keys, if there are any, are spread by
    salts; the rows of the result are the same. ``salt=False`` skips that,
    ``salt=True`` salts in any case and both sides.
    """
    kind = JOIN_TYPES.get(how.lower().replace("_", ""))
    if kind is None:
        raise ValueError(f"unknown join type {how!r}; known: {', '.join(sorted(JOIN_TYPES))}")
    left_key, right_key = join_pair
    for name, table, side in ((left_key, left_table, "left"), (right_key, right_table, "right")):
        if name not in table.columns:
            raise ColumnError(f"Cannot resolve column {name} of the {side} table")

    dropped = set(other_drop_columns or ())
    left = _pruned(left_table, left_key, _LEFT, dropped)
    right = _pruned(right_table, right_key, _RIGHT, dropped)

    names = {_LEFT: left_key, _RIGHT: right_key}
    kept = [*left.columns, *([] if kind in ("semi", "anti") else right.columns)]
    if drop_joined_column:
        kept = [name for name in kept if name not in names]
    kept = [name for name in kept if names.get(name) not in dropped]
    output = [names.get(name, name) for name in kept]
    reject_duplicates(output)

    if kind in ("semi", "anti"):
        # Copies of a key cannot change the answer; partial aggregation removes
        # them before the shuffle, which the join then reuses.
        right = right.select(_RIGHT).distinct()
    # The keys of a stream cannot be looked over beforehand.
    lasting = not (left.isStreaming or right.isStreaming)
    joined = _salted_join(left, right, kind, salt) if lasting and salt is not False else None
    if joined is None:
        # Names are unique only within each side until the projection below.
        joined = left.join(right, F.col(_LEFT) == F.col(_RIGHT), kind)
    return joined.select(*[column(name).alias(names.get(name, name)) for name in kept])


def _pruned(df: DataFrame, key: str, alias: str, dropped: set[str]) -> DataFrame:
    return df.select(
        *[
            column(name).alias(alias) if name == key else column(name)
            for name in df.columns
            if name == key or name not in dropped
        ]
    )


def _comparable(left: T.DataType, right: T.DataType) -> bool:
    """Whether key values read from the two sides are equal exactly when Spark says so."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(left, whole) and isinstance(right, whole):
        return True
    return left == right and (
        left == T.StringType() or isinstance(left, (T.DateType, T.DecimalType))
    )


@dataclass(frozen=True)
class KeySkew:
    """The keys that are hot on a side, each with its number of salts, and whether NULL is."""

    hot: dict = field(default_factory=dict)
    nulls: bool = False


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_skews(sides: Sequence[tuple[DataFrame, str, bool]]) -> list[KeySkew]:
    """Look over the keys of ``(table, key, whether to tell them apart)``: one job, no shuffle of rows.

    A key is hot if it has more rows than ``HOT_TASKS`` tasks should take when
    the rows are dealt evenly. A frequent-items sketch, whose size follows the
    number of tasks, finds these. They only steer how rows are spread, never
    which rows are joined.
    """
    looks = []
    for number, (df, key, apart) in enumerate(sides):
        # No more keys than this can be hot; the sketch has room to spare.
        most = min(100_000, max(1, _partitions(df) // HOT_TASKS))
        top = f"approx_top_k(`{key}`, {most}, {min(1_000_000, max(10_000, 20 * most))})" if apart else "NULL"
        looks.append(
            df.select(
                F.lit(number).alias("side"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col(key).isNull()).alias("n_nulls"),
                # Keys of two types do not fit one column of items.
                F.expr(top).alias(f"top{number}"),
            )
        )
    union = functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), looks)
    found = {row["side"]: row for row in union.collect()}
    skews = []
    for number, (df, _, _) in enumerate(sides):
        row = found[number]
        task = HOT_TASKS * row["n_rows"] / _partitions(df)
        hot = {
            e["item"]: math.ceil(SALTS_PER_TASK * e["count"] / max(1.0, task / HOT_TASKS))
            for e in row[f"top{number}"] or []
            if e["item"] is not None and e["count"] > max(task, 1)
        }
        skews.append(KeySkew(hot, row["n_nulls"] > max(task, 1)))
    return skews


def key_skew(df: DataFrame, key: str, sketch: bool = True) -> KeySkew:
    """``key_skews`` of one table."""
    return key_skews([(df, key, sketch)])[0]


def _small(df: DataFrame) -> bool:
    """Whether Spark estimates a side to be within its limit for broadcasts."""
    try:
        plan, session = df._jdf.queryExecution(), df.sparkSession._jsparkSession
    except AttributeError:
        # A session over the wire tells no sizes: the side's keys are looked over then.
        return False
    return int(str(plan.optimizedPlan().stats().sizeInBytes())) <= session.sessionState().conf().autoBroadcastJoinThreshold()


def _salted_join(left: DataFrame, right: DataFrame, kind: str, salt: bool | None) -> DataFrame | None:
    """Join on (key, left salt, right salt); None if nothing calls for it.

    A row with a hot key takes one salt of its own side and is repeated for
    every salt of the other side, so each pair still meets exactly once. A key
    has salts in proportion to its rows. Rows with NULL keys cannot match; they
    take a salt and are not repeated.
    """
    sides = {"left": (left, _LEFT), "right": (right, _RIGHT)}
    # The sides whose partitions Spark cannot split.
    rigid = {"left": ["right"], "right": ["left"], "full": ["left", "right"]}.get(kind, [])
    if salt:
        looked = ["left"] if kind in ("semi", "anti") else ["left", "right"]
    else:
        looked = [side for side in rigid if not _small(sides[side][0])]
    if not looked:
        return None
    typed = _comparable(left.schema[_LEFT].dataType, right.schema[_RIGHT].dataType)
    skews = dict(zip(looked, key_skews([(*sides[side], typed) for side in looked]), strict=True))
    # NULL keys take part in the shuffle only if their rows are kept.
    if not salt and not any(skew.hot or (skew.nulls and kind == "full") for skew in skews.values()):
        return None
    hot_left, hot_right = (skews.get(side, KeySkew()).hot for side in ("left", "right"))
    salts = [(key, hot_left.get(key, 1), hot_right.get(key, 1)) for key in hot_left.keys() | hot_right.keys()]
    spread_nulls = max(2, _partitions(left))

    def spread(df: DataFrame, key: str, own: str, own_salt: str, other_salt: str, copies: str):
        hashable = [
            column(field.name)
            for field in df.schema
            if not any(part in field.dataType.simpleString() for part in ("map<", "variant"))
        ]
        # Copies of one row differ in the partition they come from, and a
        # repeated task sees the same partition: the salt is stable.
        hashed = F.xxhash64(*hashable, F.spark_partition_id())
        other = "__on_right" if own == "__on_left" else "__on_left"
        if salts:
            schema = T.StructType(
                [T.StructField("__hot", df.schema[key].dataType), T.StructField("__on_left", T.IntegerType()), T.StructField("__on_right", T.IntegerType())]
            )
            # At most a key for every HOT_TASKS partitions.
            hot = F.broadcast(df.sparkSession.createDataFrame(salts, schema))
            known = df.withColumn(own_salt, hashed).join(hot, F.col(key) == F.col("__hot"), "left").drop("__hot")
        else:
            # Always 1, but computed: as a literal it would be folded into a filter
            # on the other side, and the salts would not take part in the shuffle.
            one = (F.pmod(F.xxhash64(key), F.lit(1)) + 1).cast("int")
            known = df.withColumns({own_salt: hashed, own: one, other: one})
        number = F.when(F.col(key).isNull(), F.lit(spread_nulls)).otherwise(F.coalesce(F.col(own), F.lit(1)))
        return (
            known.withColumn(own_salt, F.pmod(F.col(own_salt), number).cast("int"))
            .withColumn(copies, F.coalesce(F.col(other), F.lit(1)))
            .withColumn(other_salt, F.explode(F.sequence(F.lit(0), F.col(copies) - 1)))
            .drop("__on_left", "__on_right")
        )

    spread_left = spread(left, _LEFT, "__on_left", "__l_own", "__l_other", "__l_copies")
    spread_right = spread(right, _RIGHT, "__on_right", "__r_own", "__r_other", "__r_copies")
    joined = spread_left.join(
        spread_right,
        (F.col(_LEFT) == F.col(_RIGHT))
        & (F.col("__l_own") == F.col("__r_other"))
        & (F.col("__l_other") == F.col("__r_own")),
        kind,
    )
    if kind in ("left", "right", "full") and salts:
        # A key for which rows are repeated is on the other side, so a copy
        # without a partner is one whose salt met nobody; other copies did.
        lonely_left = (F.col("__l_copies") > 1) & F.col("__r_own").isNull()
        lonely_right = (F.col("__r_copies") > 1) & F.col("__l_own").isNull()
        joined = joined.where(~(F.coalesce(lonely_left | lonely_right, F.lit(False))))
    return joined


def star_join(
    base: DataFrame,
    joins: Sequence[tuple[DataFrame, tuple[str, str]]],
    how: str = "left",
    drop: Sequence[str] = ("processing_ts",),
    salt: bool | None = False,
) -> DataFrame:
    """Fold tables onto ``base`` in order; a later key may come from an earlier table.

    The tables joined on are taken to have few rows for each key, as
    dimensions do; where that may not be so, ``salt=None`` looks for hot keys.
    """

    def fold(joined: DataFrame, step: tuple[DataFrame, tuple[str, str]]) -> DataFrame:
        table, pair = step
        return join_table(joined, table, pair, how, other_drop_columns=drop, salt=salt)

    return functools.reduce(fold, joins, base)
