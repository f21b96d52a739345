import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tiersmith import ColumnError
from tiersmith.operators import keys


def test_number_rows_equals_global_row_number(spark):
    rows = [(random.Random(i).randrange(10**6), f"n{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, n string").repartition(7)
    numbered = keys.number_rows(df, ["k", "n"])
    expected = df.withColumn(
        "row_no", F.row_number().over(Window.orderBy("k", "n")).cast("bigint")
    )
    assert numbered.columns == ["k", "n", "row_no"]
    assert numbered.exceptAll(expected).isEmpty() and expected.exceptAll(numbered).isEmpty()


def test_number_rows_keeps_its_numbers(spark):
    numbered = keys.number_rows(spark.range(1000).select((-F.col("id")).alias("k")), ["k"])
    assert sorted(numbered.collect()) == sorted(numbered.collect())


def test_number_rows_of_nothing(spark):
    assert keys.number_rows(spark.range(0), ["id"]).count() == 0


def test_surrogate_key(spark):
    df = spark.createDataFrame([("B", "1"), ("A", "2"), ("B", "1"), ("A", None)], "n string, c string")
    rows = keys.surrogate_key(df, ["n", "c"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "A", None), (2, "A", "2"), (3, "B", "1")]


def test_sparse_id_is_unique(spark):
    ids = keys.sparse_id(spark.range(100).repartition(4).select(F.lit(1).alias("x")))
    assert ids.select("id").distinct().count() == 100


@pytest.mark.parametrize("batch_rows", [1, 2, 3, 7, 1000])
def test_with_next_equals_lead(spark, batch_rows):
    rows = [(s, o, (o * 7 + s) % 5) for s in (0, 1, 2) for o in range(9 - s)]
    rows += [(None, 1, 4), (None, 2, 5), (0, 3, 9), (0, 3, 9)]
    df = spark.createDataFrame(rows, "s int, o int, v int").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        got = keys.with_next(df, "v", ["o"], ["s"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ahead = Window.partitionBy("s").orderBy("o", "v")
    expected = df.distinct().withColumn("next_value", F.lead("v").over(ahead))
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_with_next_of_few_rows(spark):
    df = spark.createDataFrame([(1, 5)], "o int, v int")
    assert [tuple(r) for r in keys.with_next(df, "v", ["o"]).collect()] == [(1, 5, None)]
    assert keys.with_next(df.where("o > 1"), "v", ["o"]).count() == 0
    assert [tuple(r) for r in keys.with_next(df.withColumn("a.b", F.lit("x")), "a.b", ["o"]).collect()] == [(1, "x", None)]


def test_with_next_does_not_gather_rows_again(spark, capsys):
    keys.with_next(spark.range(100).selectExpr("id AS o", "id AS v"), "v", ["o"]).explain()
    plan = capsys.readouterr().out
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_column_pairs(spark):
    df = spark.createDataFrame([("1", "2", "3"), (None, "4", "5")], "A string, B string, C string")
    assert [tuple(r) for r in keys.column_pairs(df, "B", "C").collect()] == [("2", "3"), ("4", "5")]


def test_column_pairs_with_unequal_counts(spark):
    df = spark.createDataFrame([("1", "2"), ("1", "4")], "A string, B string")
    with pytest.raises(ColumnError, match="Duplicate value in pair"):
        keys.column_pairs(df, "A", "B")


def test_column_pairs_that_only_the_bijective_mode_rejects(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "A int, B string")
    assert keys.column_pairs(df, "A", "B").count() == 3
    with pytest.raises(ColumnError, match="Duplicate value in pair"):
        keys.column_pairs(df, "A", "B", mode="bijective")
    assert [tuple(r) for r in keys.column_pair_conflicts(df, "A", "B").collect()] == [(1, 2)]
