import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from pathlib import Path
from urllib.parse import unquote

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tiersmith.sources import tables

NOON = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)


def files(location, name, table):
    """The files that a reader of the table gets now."""
    found = tables.read_table(SparkSession.getActiveSession(), name, table).inputFiles()
    return [Path(unquote(p.split(":", 1)[1])) for p in found]


@pytest.mark.parametrize(
    "src, dst, run, expected",
    [
        ("bronze", "silver", None, ("bronze", "silver")),
        ("bronze", "silver", "", ("bronze", "silver")),
        ("bronze", "silver", "abc", ("bronze_abc", "silver_abc")),
        (None, "bronze", "abc", (None, "bronze_abc")),
    ],
)
def test_database_names(src, dst, run, expected):
    assert tables.create_database_name(src, dst, run) == expected


def test_database_life(spark, database):
    name, location = database
    assert not tables.database_exists(spark, name)
    tables.create_database(spark, name, location)
    tables.create_database(spark, name, location)
    assert tables.database_exists(spark, name)
    tables.drop_databases(spark, name, "never_there")
    assert not tables.database_exists(spark, name)


def test_overwrite_append_and_stamp(spark, database):
    name, location = database
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, part string")
    tables.save_table(spark, df, location, name, "t", run_ts=NOON)
    tables.save_table(spark, df, location, name, "t", run_ts=NOON)
    saved = tables.read_table(spark, name, "t")
    assert saved.count() == 4 and saved.columns == ["id", "part", "processing_ts"]
    assert [r[0] for r in saved.selectExpr("CAST(processing_ts AS string)").distinct().collect()] == [
        "2024-05-01 12:00:00"
    ]
    tables.save_table(spark, df, location, name, "t", overwrite=True)
    again = tables.read_table(spark, name, "t")
    assert again.count() == 2 and again.select("processing_ts").distinct().count() == 1


def test_partitions_move_to_the_end_and_are_pruned(spark, database, capsys):
    name, location = database
    df = spark.createDataFrame([("a", 1), ("b", 2)], "part string, id int")
    tables.save_table(spark, df, location, name, "t", partition_by="part")
    saved = tables.read_table(spark, name, "t")
    assert saved.columns == ["id", "processing_ts", "part"]
    saved.where("part = 'a'").explain()
    assert "PartitionFilters: [isnotnull(part" in capsys.readouterr().out


def test_partition_column_with_a_dot(spark, database):
    name, location = database
    df = spark.createDataFrame([("x", 1), ("y", 2)], "`a.b` string, id int")
    tables.save_table(spark, df, location, name, "t", partition_by="a.b", optimize_table=True)
    assert sorted(r[0] for r in tables.read_table(spark, name, "t").select("`a.b`").collect()) == ["x", "y"]


def test_append_of_other_columns_fails(spark, database):
    name, location = database
    df = spark.createDataFrame([(1, "a")], "id int, part string")
    tables.save_table(spark, df, location, name, "t")
    with pytest.raises(AnalysisException):
        tables.save_table(spark, df.selectExpr("*", "1 AS more"), location, name, "t")


@pytest.mark.parametrize("partition_by", [None, ["part", "n"]])
def test_compaction(spark, database, partition_by):
    name, location = database
    rows = [(i, None if i % 5 == 0 else f"o'n/e {i % 3}", i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, part string, n int").repartition(10)
    for _ in range(3):
        tables.save_table(spark, df, location, name, "t", partition_by=partition_by, run_ts=NOON)
    saved = tables.read_table(spark, name, "t")
    before, count = sorted(map(str, saved.collect())), len(files(location, name, "t"))
    for _ in range(2):
        tables.compact_table(spark, name, "t")
        again = tables.read_table(spark, name, "t")
        assert sorted(map(str, again.collect())) == before
        assert again.columns == saved.columns
    assert len(files(location, name, "t")) < count
    assert [t.name for t in spark.catalog.listTables(name)] == ["t"]


def test_compaction_after_a_lost_exchange(spark, database):
    name, location = database
    tables.save_table(spark, spark.range(10), location, name, "t")
    spark.sql(f"ALTER TABLE {name}.t RENAME TO {name}.t__before")
    tables.compact_table(spark, name, "t")
    assert tables.read_table(spark, name, "t").count() == 10
    assert [t.name for t in spark.catalog.listTables(name)] == ["t"]


def test_save_with_compaction(spark, database):
    name, location = database
    df = spark.range(1000).repartition(10)
    tables.save_table(spark, df, location, name, "t", optimize_table=True)
    assert tables.read_table(spark, name, "t").count() == 1000
    assert len(files(location, name, "t")) < 10


@pytest.mark.parametrize("name_of_column", ["Location", "Provider", "Type"])
def test_compaction_of_columns_named_like_table_facts(spark, database, name_of_column):
    name, location = database
    df = spark.createDataFrame([(f"v{i}", i % 3) for i in range(9)], f"{name_of_column} string, p int").repartition(5)
    for _ in range(2):
        tables.save_table(spark, df, location, name, "t", partition_by="p")
    count = len(files(location, name, "t"))
    tables.compact_table(spark, name, "t")
    saved = tables.read_table(spark, name, "t")
    assert sorted(r[0] for r in saved.collect()) == sorted(f"v{i % 9}" for i in range(18))
    assert len(files(location, name, "t")) < count


@pytest.mark.parametrize("partition_by", [None, "part"])
@pytest.mark.parametrize("cut", ["after the copy", "while partitions are published", "before the end is noted"])
@pytest.mark.parametrize("then", ["compact", "append", "overwrite"])
def test_no_rows_are_lost_to_a_crash(spark, database, monkeypatch, partition_by, cut, then):
    name, location = database
    df = spark.createDataFrame([(i, f"p{i % 3}") for i in range(60)], "id int, part string").repartition(6)
    for _ in range(2):
        tables.save_table(spark, df, location, name, "t", partition_by=partition_by, run_ts=NOON)
    publish = tables._publish

    class Cut(RuntimeError):
        pass

    def broken_publish(spark, live, facts, moves):
        if cut != "after the copy":
            publish(spark, live, facts, moves if cut == "before the end is noted" else moves[:2])
        raise Cut

    with monkeypatch.context() as patched, pytest.raises(Cut):
        patched.setattr(tables, "_publish", broken_publish)
        tables.compact_table(spark, name, "t")
    ids = lambda: sorted(r[0] for r in tables.read_table(spark, name, "t").select("id").collect())
    assert ids() == sorted(list(range(60)) * 2)
    if then == "compact":
        tables.compact_table(spark, name, "t")
    else:
        tables.save_table(spark, df, location, name, "t", overwrite=then == "overwrite", partition_by=partition_by, run_ts=NOON)
    assert ids() == sorted(list(range(60)) * {"compact": 2, "append": 3, "overwrite": 1}[then])
    assert [t.name for t in spark.catalog.listTables(name)] == ["t"]
    # What the dead compaction left goes once it is old enough.
    monkeypatch.setattr(tables, "ABANDONED", timedelta(0))
    tables.compact_table(spark, name, "t")
    tables.remove_replaced(spark, name, "t")
    in_use = {p.split(":", 1)[1].lstrip("/") for p in tables.read_table(spark, name, "t").inputFiles()}
    left = {str(p).lstrip("/") for p in Path(location).rglob("*.parquet") if "t__versions" in str(p)}
    assert left <= in_use and ids() == sorted(list(range(60)) * {"compact": 2, "append": 3, "overwrite": 1}[then])


@pytest.mark.parametrize("partition_by", [None, "part"])
def test_replaced_files_stay_for_readers_until_the_next_compaction(spark, database, partition_by):
    name, location = database
    df = spark.createDataFrame([(i, f"o'n/e%{i % 2}") for i in range(40)], "id int, part string").repartition(8)
    for _ in range(2):
        tables.save_table(spark, df, location, name, "t", partition_by=partition_by, run_ts=NOON)
    early = tables.read_table(spark, name, "t")
    old = early.inputFiles()
    tables.compact_table(spark, name, "t")
    assert early.count() == 80
    late = tables.read_table(spark, name, "t")
    new = late.inputFiles()
    assert not set(old) & set(new) and len(new) < len(old)
    # Rows that come later go where the catalog points to, and are compacted with the rest.
    tables.save_table(spark, df, location, name, "t", partition_by=partition_by, run_ts=NOON)
    tables.compact_table(spark, name, "t")
    again = tables.read_table(spark, name, "t")
    assert again.count() == 120 and len(again.inputFiles()) == len(new)
    assert not [p for p in old if Path(unquote(p.split(":", 1)[1])).exists()]
    tables.save_table(spark, df, location, name, "t", overwrite=True, partition_by=partition_by, run_ts=NOON)
    assert tables.read_table(spark, name, "t").count() == 40


def test_side_by_side_compactions_keep_all_rows(spark, database):
    name, location = database
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, p int").repartition(3)
    names = [f"t{n}" for n in range(6)]
    mode = "spark.sql.sources.partitionOverwriteMode"
    settings = {k: spark.conf.get(k) for k in (mode, "spark.sql.classic.shuffleDependency.fileCleanup.enabled")}
    stop, seen = threading.Event(), []

    def read():
        while not stop.is_set():
            # Appends are over before compactions begin, so the rows of a table never change here.
            for table in names:
                counts = {r["p"]: r["count"] for r in tables.read_table(spark, name, table).groupBy("p").count().collect()}
                seen.append(sorted(counts.items()) == [(p, 10 * expected) for p in range(3)])

    for round_ in range(4):
        expected = round_ + 2
        for table in names:
            for _ in range(2 if not round_ else 1):
                tables.save_table(spark, df, location, name, table, partition_by="p", run_ts=NOON)
        stop.clear()
        reader = threading.Thread(target=read)
        reader.start()
        with ThreadPoolExecutor(6) as pool:
            list(pool.map(lambda table: tables.compact_table(spark, name, table), names))
        stop.set()
        reader.join()
        for table in names:
            assert tables.read_table(spark, name, table).count() == 30 * expected
    assert seen and all(seen)
    assert {k: spark.conf.get(k) for k in settings} == settings


def test_a_table_written_to_meanwhile_is_left_alone(spark, database, monkeypatch):
    name, location = database
    df = spark.range(20).selectExpr("id", "id % 2 AS p").repartition(4)
    for _ in range(2):
        tables.save_table(spark, df, location, name, "t", partition_by="p")
    calls, folders = [], tables._folders

    def late_rows(*args):
        calls.append(args)
        if len(calls) == 2:
            tables.save_table(spark, df, location, name, "t", partition_by="p")
        return folders(*args)

    with monkeypatch.context() as patched:
        patched.setattr(tables, "_folders", late_rows)
        tables.compact_table(spark, name, "t")
    assert tables.read_table(spark, name, "t").count() == 60
    assert not list(Path(location).rglob("*__versions*/**/*.parquet"))
    tables.compact_table(spark, name, "t")
    assert tables.read_table(spark, name, "t").count() == 60


def test_partitions_in_few_files_are_left_alone(spark, database):
    name, location = database
    tables.save_table(spark, spark.range(10).selectExpr("id", "'one' AS part").coalesce(1), location, name, "t", partition_by="part")
    for _ in range(3):
        tables.save_table(spark, spark.range(5).selectExpr("id", "'many' AS part"), location, name, "t", partition_by="part")
    one = [p for p in files(location, name, "t") if "part=one" in str(p)]
    tables.compact_table(spark, name, "t")
    after = files(location, name, "t")
    assert [p for p in after if "part=one" in str(p)] == one
    assert len(after) == 2 and tables.read_table(spark, name, "t").count() == 25
