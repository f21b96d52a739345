"""Renames, projections and in-place column edits.

Names are worked out from metadata and applied in one projection, so a wide
table costs one analysis step however many of its columns change.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.errors import ColumnError
from tiersmith.functions.casts import lenient_cast


def column(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    for name in names:
        if name not in df.columns:
            raise ColumnError(f"Column {name} not in DataFrame")


def reject_duplicates(names: Sequence[str]) -> None:
    clashes = sorted(n for n, times in Counter(map(str.lower, names)).items() if times > 1)
    if clashes:
        raise ColumnError(f"duplicate column name(s): {', '.join(clashes)}")


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    reject_duplicates(names)
    return df.toDF(*names)


def replace_column_names(df: DataFrame, column_pair: list[tuple[str, str]]) -> DataFrame:
    """Rename by ``(old, new)`` pairs, all at once, so names may be swapped."""
    require_columns(df, (old for old, _ in column_pair))
    new_names = dict(column_pair)
    return _renamed(df, [new_names.get(name, name) for name in df.columns])


def clean_column_names(df: DataFrame) -> DataFrame:
    """Lower-case names of letters and digits, with ``_`` for what lies between."""
    names = ["_".join(re.findall("[A-Za-z0-9]+", name)).lower() for name in df.columns]
    for old, new in zip(df.columns, names):
        if not new:
            raise ColumnError(f"column name {old!r} holds no letter or digit")
    return _renamed(df, names)


def apply_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Put ``prefix_`` before every name."""
    return _renamed(df, [f"{prefix}_{name}" for name in df.columns])


def cast_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in declared order and type; bad values are NULL."""
    require_columns(df, schema.names)
    source = {field.name: field.dataType for field in df.schema}
    return df.select(
        *[
            lenient_cast(column(f.name), source[f.name], f.dataType).alias(f.name)
            for f in schema
        ]
    )


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop every column of these names; names not present are ignored."""
    return df.drop(*names)


def default_for_null(df: DataFrame, names: Sequence[str], default, dtype: T.DataType) -> DataFrame:
    """``default`` where the stored value is NULL, the cast value elsewhere.

    A malformed value is not a missing one: it becomes NULL, not the default.
    """
    require_columns(df, names)
    source = {field.name: field.dataType for field in df.schema}
    return df.withColumns(
        {
            name: F.when(column(name).isNull(), F.lit(default).cast(dtype)).otherwise(
                lenient_cast(column(name), source[name], dtype)
            )
            for name in names
        }
    )


def regex_replace_column(
    df: DataFrame, original_column: str, regex_replacement_pair: tuple[str, str]
) -> DataFrame:
    """Replace all matches of a pattern within a column."""
    pattern, replacement = regex_replacement_pair
    replaced = F.regexp_replace(column(original_column), F.lit(pattern), F.lit(replacement))
    return df.withColumn(original_column, replaced)


def where_all_present(df: DataFrame, *names: str) -> DataFrame:
    """The rows in which none of the named columns is NULL."""
    condition = F.lit(True)
    for name in names:
        condition = condition & column(name).isNotNull()
    return df.where(condition)
