import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tiersmith import ColumnError
from tiersmith.operators import joins


@pytest.fixture
def tables(spark):
    rows = [("1", "2", "3"), ("_4", "5", "6")]
    return (
        spark.createDataFrame(rows, "A string, B string, C string"),
        spark.createDataFrame(rows, "D string, E string, F string"),
    )


@pytest.mark.parametrize(
    "keep, drop, expected",
    [
        (False, None, ["B", "C", "E", "F"]),
        (True, None, ["A", "B", "C", "D", "E", "F"]),
        (True, ["C", "F"], ["A", "B", "D", "E"]),
        (False, ["C", "F"], ["B", "E"]),
        (True, ["A", "nowhere"], ["B", "C", "D", "E", "F"]),
    ],
)
def test_columns_of_a_join(tables, keep, drop, expected):
    given = None if drop is None else list(drop)
    joined = joins.join_table(
        *tables, ("A", "D"), "left", drop_joined_column=not keep, other_drop_columns=given
    )
    assert joined.columns == expected
    assert joined.count() == 2
    assert given == drop


def test_missing_key(tables):
    with pytest.raises(ColumnError, match="Cannot resolve"):
        joins.join_table(*tables, ("A", "A"), "left")


def test_unknown_join_type(tables):
    with pytest.raises(ValueError, match="unknown join type"):
        joins.join_table(*tables, ("A", "D"), "sideways")


def test_same_key_name_on_both_sides(spark, tables):
    left, _ = tables
    right = left.select("A", left.B.alias("X"))
    assert joins.join_table(left, right, ("A", "A"), "inner").columns == ["B", "C", "X"]
    with pytest.raises(ColumnError, match="duplicate"):
        joins.join_table(left, right, ("A", "A"), "inner", drop_joined_column=False)


def test_audit_columns_are_pruned_on_both_sides(spark):
    left = spark.createDataFrame([(1, 10, 0)], "k int, a int, processing_ts int")
    right = spark.createDataFrame([(1, 20, 0)], "j int, b int, processing_ts int")
    third = spark.createDataFrame([(20, 30, 0)], "i int, c int, processing_ts int")
    assert joins.star_join(left, [(right, ("k", "j")), (third, ("b", "i"))]).collect() == [(10, 30)]


def brute_force(left, right, kind):
    """Nested loops over rows of (key, value)."""
    pairs = [(l, r) for l, r in itertools.product(left, right) if l[0] is not None and l[0] == r[0]]
    matched_left = Counter(l for l, _ in set(pairs))
    matched_right = Counter(r for _, r in set(pairs))
    if kind == "semi":
        return Counter(l for l in left if l in matched_left)
    if kind == "anti":
        return Counter(l for l in left if l not in matched_left)
    rows = [l + r for l, r in pairs]
    if kind in ("left", "full"):
        rows += [l + (None, None) for l in left if l not in matched_left]
    if kind in ("right", "full"):
        rows += [(None, None) + r for r in right if r not in matched_right]
    return Counter(rows)


# Hot on the left (1), on the right (2), on both (3), on one side only (4, 5),
# NULL keys, and copies of whole rows.
LEFT = (
    [(1, i) for i in range(60)] + [(3, i % 3) for i in range(20)] + [(4, i) for i in range(40)]
    + [(2, 0), (2, 0), (None, 1), (None, 1), (None, 2), (8, 1), (9, 1)] + [(1, 7)] * 30
)
RIGHT = (
    [(2, i) for i in range(50)] + [(3, 5)] * 15 + [(5, i) for i in range(40)]
    + [(1, 0), (1, 1), (None, 3), (9, 2), (10, 1)]
)


@pytest.mark.parametrize("salt", [False, True, None])
@pytest.mark.parametrize("kind", ["inner", "left", "right", "full", "semi", "anti"])
@pytest.mark.parametrize("types", [("int", "int"), ("int", "bigint"), ("string", "string"), ("string", "int")])
def test_every_join_type_against_nested_loops(spark, monkeypatch, kind, salt, types):
    # Small tables are looked over too.
    monkeypatch.setattr(joins, "_small", lambda df: False)

    def build(rows, dtype, key, value):
        text = dtype == "string"
        rows = [(None if k is None else str(k) if text else k, v) for k, v in rows]
        return rows, spark.createDataFrame(rows, f"{key} {dtype}, {value} int").repartition(5)

    left_rows, left = build(LEFT, types[0], "a", "x")
    right_rows, right = build(RIGHT, types[1], "b", "y")
    joined = joins.join_table(left, right, ("a", "b"), kind, drop_joined_column=False, salt=salt)
    if types == ("string", "int"):
        got = Counter((None if r[0] is None else int(r[0]), *r[1:]) for r in joined.collect())
        left_rows = LEFT
    else:
        got = Counter(tuple(r) for r in joined.collect())
    assert got == brute_force(left_rows, right_rows, kind)


@pytest.mark.parametrize(
    "key", ["CAST(k AS decimal(10,2))", "date_add(DATE'2024-01-01', k)", "CAST(k AS double)", "array(k)"]
)
def test_salting_with_keys_of_other_types(spark, key):
    left = spark.createDataFrame(LEFT, "k int, x int").selectExpr(f"{key} AS a", "k", "x")
    right = spark.createDataFrame(RIGHT, "k int, y int").selectExpr(f"{key} AS b", "k AS j", "y")
    if key == "array(k)":
        left, right = (df.where(f"{c} IS NOT NULL") for df, c in ((left, "k"), (right, "j")))
    joined = joins.join_table(left, right, ("a", "b"), "full", salt=True).select("k", "x", "j", "y")
    rows = [[r for r in side if key != "array(k)" or r[0] is not None] for side in (LEFT, RIGHT)]
    assert Counter(tuple(r) for r in joined.collect()) == brute_force(*rows, "full")


def test_skew_of_keys(spark):
    df = spark.range(9000).selectExpr("CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN id + 100 END AS k")
    # A third of the rows calls for a third of the eight tasks, with four salts each.
    assert joins.key_skew(df, "k") == joins.KeySkew({7: 11}, True)
    assert joins.key_skew(df, "k", sketch=False) == joins.KeySkew({}, True)
    assert joins.key_skews([(df, "k", True), (spark.range(9000), "id", True)]) == [joins.KeySkew({7: 11}, True), joins.KeySkew()]
    assert joins.key_skew(spark.range(9000), "id") == joins.KeySkew()
    assert joins.key_skew(spark.range(0), "id") == joins.KeySkew()


def exchanges(df, capsys):
    df.explain()
    return [line for line in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in line]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "how, hot_side, salted",
    [
        ("left", "right", True), ("left", "left", False), ("left", None, False),
        ("right", "left", True), ("right", "right", False),
        ("full", "left", True), ("full", "right", True), ("full", None, False),
        ("inner", "left", False), ("semi", "left", False),
    ],
)
def test_salts_only_where_spark_cannot_split(spark, capsys, no_broadcast, how, hot_side, salted):
    def build(side, key, value):
        chosen = "if(id % 3 = 0, 7, id)" if side == hot_side else "id"
        return spark.range(3000).selectExpr(f"{chosen} AS {key}", f"id AS {value}")

    left, right = build("left", "a", "x"), build("right", "b", "y")
    joined = joins.join_table(left, right, ("a", "b"), how, drop_joined_column=False)
    found = exchanges(joined, capsys)
    assert len(found) == 2 and all(("__l_" in e or "__r_" in e) == salted for e in found)
    plain = joins.join_table(left, right, ("a", "b"), how, drop_joined_column=False, salt=False)
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_salts_take_part_in_the_shuffle(spark, capsys, no_broadcast):
    """NULL keys of a full join must not meet in one task."""
    left = spark.range(1000).selectExpr("if(id % 2 = 0, NULL, id) AS a", "id AS x")
    right = spark.range(10).selectExpr("id AS b", "id AS y")
    joined = joins.join_table(left, right, ("a", "b"), "full", drop_joined_column=False)
    found = exchanges(joined, capsys)
    assert len(found) == 2 and all("__l_own" in e or "__r_other" in e for e in found)
    assert joined.count() == 500 + 500 + 5


def test_stream_joined_to_a_table(spark, tmp_path):
    spark.range(5).selectExpr("id AS a", "id * 10 AS x").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("a bigint, x bigint").parquet(f"{tmp_path}/in")
    joined = joins.join_table(stream, spark.range(3).selectExpr("id AS b", "'n' AS y"), ("a", "b"), "left")
    query = (
        joined.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True).start(f"{tmp_path}/out")
    )
    query.awaitTermination()
    rows = sorted((r.x, r.y) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert rows == [(0, "n"), (10, "n"), (20, "n"), (30, None), (40, None)]


def test_the_largest_task_of_a_join_with_hot_keys(spark, no_broadcast):
    """A third of the rows on both sides has one key, a third none: all tasks share them."""
    key = "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN id + 100 END"
    left = spark.range(24_000).selectExpr(f"{key} AS a", "id AS x")
    right = spark.range(600).selectExpr("if(id < 20, 7, id + 90) AS b", "id AS y")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for salt, most in ((False, 0.6), (None, 0.3)):
            joined = joins.join_table(left, right, ("a", "b"), "full", drop_joined_column=False, salt=salt)
            tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            share = max(tasks) / sum(tasks)
            assert share > most if salt is False else share < most
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_no_job_for_a_side_that_is_broadcast(spark, monkeypatch):
    def fail(sides):
        raise AssertionError("looked over the keys")

    monkeypatch.setattr(joins, "key_skews", fail)
    left, right = spark.range(100).selectExpr("id AS a"), spark.range(10).selectExpr("id AS b")
    assert joins.join_table(left, right, ("a", "b"), "left", drop_joined_column=False).count() == 100


def test_a_session_that_tells_no_sizes(spark, monkeypatch):
    class Remote:
        @property
        def _jdf(self):
            raise AttributeError("no such thing here")

    assert joins._small(Remote()) is False
    assert joins._small(spark.range(3)) is True
