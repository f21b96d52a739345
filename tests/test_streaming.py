from datetime import datetime, timezone

import pytest

from tiersmith.errors import ColumnError
from tiersmith.plans.jobs import IncrementalBronzeJob
from tiersmith.sources.tables import read_table
from tiersmith.streaming import incremental


@pytest.fixture
def run(spark, database, tmp_path):
    name, location = database
    (tmp_path / "landing").mkdir()

    def call(**options):
        incremental.ingest_new_files(
            spark,
            f"{location}/landing",
            location,
            name,
            "t",
            f"{location}/checkpoint",
            f"{location}/archive",
            run_ts=datetime(2024, 1, 1, tzinfo=timezone.utc),
            **options,
        )
        return sorted(
            tuple(r)
            for r in incremental.without_load_columns(read_table(spark, name, "t")).collect()
        )

    return call


def test_each_file_is_loaded_once_and_archived(run, tmp_path):
    landing = tmp_path / "landing"
    (landing / "a.csv").write_text("Id,First Name\n1,x\n2,\n")
    assert run() == [("1", "x"), ("2", None)]
    assert run() == [("1", "x"), ("2", None)]
    (landing / "b.csv").write_text("Id,First Name\n1,x\n")
    assert run() == [("1", "x"), ("1", "x"), ("2", None)]
    (landing / "c.csv").write_text("Id,First Name\n3,z\n")
    assert run() == [("1", "x"), ("1", "x"), ("2", None), ("3", "z")]
    archived = {p.name for p in (tmp_path / "archive").rglob("*.csv")}
    assert "a.csv" in archived and not (landing / "a.csv").exists()
    assert (landing / "c.csv").exists()


def test_a_repeated_batch_replaces_itself(spark, run, database, tmp_path):
    """A stream that lost its commit runs the batch again."""
    landing = tmp_path / "landing"
    (landing / "a.csv").write_text("id\n1\n")
    run()
    (landing / "b.csv").write_text("id\n2\n")
    assert run() == [("1",), ("2",)]
    for marker in (tmp_path / "checkpoint" / "commits").glob("*1*"):
        marker.unlink()
    assert run() == [("1",), ("2",)]


def test_a_file_with_other_columns_is_an_error(run, tmp_path):
    landing = tmp_path / "landing"
    (landing / "a.csv").write_text("id,name\n1,x\n")
    run()
    (landing / "b.csv").write_text("name,number\ny,2\n")
    with pytest.raises(ColumnError, match="columns"):
        run()


def test_files_of_one_load_are_read_under_their_own_headers(run, tmp_path):
    landing = tmp_path / "landing"
    (landing / "a.csv").write_text("id,name\n1,x\n")
    (landing / "b.csv").write_text("name,id\ny,2\nid,3\n")
    (landing / "c [1]{2}.csv").write_text("\ufeffid,name\r\n4,w\r\n")
    (landing / "empty.csv").write_text("")
    (landing / "header.csv").write_text("name,id")
    assert run() == [("1", "x"), ("2", "y"), ("3", "id"), ("4", "w")]
    (landing / "d.csv").write_text("Name,ID\nz,5\n")
    assert run()[-1] == ("5", "z")


def test_line_breaks_in_an_incremental_load(run, tmp_path):
    landing = tmp_path / "landing"
    (landing / "a.csv").write_text('id,name\n1,"x\ny"\n')
    assert run(line_breaks=True, escape='"') == [("1", "x\ny")]
    (landing / "b.csv").write_text('name,id\n"a ""q""\n\n,b",2\n')
    assert run(line_breaks=True, escape='"') == [("1", "x\ny"), ("2", 'a "q"\n\n,b')]


@pytest.mark.parametrize("file", ["sales_2024_returns", "sales-1x", "sales_returns_1", "sales2024", "sales_", "xsales_1", "sales_2024_returns_2"])
def test_files_of_other_tables_are_not_touched(spark, database, tmp_path, file):
    name, location = database
    landing = tmp_path / "landing"
    landing.mkdir()
    mine = ["sales", "sales_2024", "sales-2024-01-02", "sales.7", "sales_20240102T030405Z"]
    for n, own in enumerate(mine):
        (landing / f"{own}.csv").write_text(f"id\n{n}\n")
    (landing / f"{file}.csv").write_text("other,columns\n8,9\n")
    job = IncrementalBronzeJob(
        spark, str(landing), location, name, {"sales": {"file_name": "sales"}},
        checkpoint=f"{location}/checkpoint", archive=f"{location}/archive",
    )
    job.run()
    (landing / "sales_99.csv").write_text("id\n99\n")
    (output,) = job.run()
    assert sorted(r.id for r in output.df.collect()) == ["0", "1", "2", "3", "4", "99"]
    assert (landing / f"{file}.csv").exists() and not (landing / "sales.csv").exists()


def test_nothing_left_in_landing(run, tmp_path):
    (tmp_path / "landing" / "a.csv").write_text("Id,First Name\n1,x\n")
    run()
    (tmp_path / "landing" / "a.csv").unlink()
    assert run() == [("1", "x")]


def test_job_loads_the_files_of_each_table(spark, database, tmp_path):
    name, location = database
    landing = tmp_path / "landing"
    landing.mkdir()
    job = IncrementalBronzeJob(
        spark, str(landing), location, name,
        {"one": {"file_name": "one_data"}, "two": {"file_name": "two_data"}},
        missing="skip", checkpoint=f"{location}/checkpoint", archive=f"{location}/archive",
    )
    (landing / "one_data.csv").write_text("Id\n1\n")
    job.run()
    (landing / "one_data_2.csv").write_text("Id\n2\n")
    (landing / "two_data.csv").write_text("Key\n5\n")
    job.run()
    job.run()
    assert sorted(r.id for r in read_table(spark, name, "one").collect()) == ["1", "2"]
    assert [r.key for r in read_table(spark, name, "two").collect()] == ["5"]


def test_a_backlog_in_several_batches(spark, run, database, tmp_path):
    for i in range(5):
        (tmp_path / "landing" / f"{i}.csv").write_text(f"id\n{i}\n")
    assert run(files_per_batch=2) == [(str(i),) for i in range(5)]
    loads = read_table(spark, database[0], "t").select("load_id").distinct().collect()
    assert sorted(r.load_id for r in loads) == [0, 1, 2]


def test_two_streams_into_one_table(spark, database, tmp_path):
    name, location = database
    for folder, text in (("a", "id,name\n1,x\n2,y\n"), ("b", "name,id\nz,3\n")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "f.csv").write_text(text)
        incremental.ingest_new_files(spark, f"{location}/{folder}", location, name, "t", f"{location}/checkpoint_{folder}")
    saved = read_table(spark, name, "t")
    assert sorted((r.id, r.name) for r in saved.collect()) == [("1", "x"), ("2", "y"), ("3", "z")]
    assert saved.select("load_stream").distinct().count() == 2


def test_columns_are_matched_by_name_once_old_files_are_gone(run, tmp_path):
    landing = tmp_path / "landing"
    (landing / "a.csv").write_text("a,b\n1,2\n")
    run()
    (landing / "a.csv").unlink()
    (landing / "b.csv").write_text("b,a\n20,10\n")
    assert run() == [("1", "2"), ("10", "20")]
    (landing / "b.csv").unlink()
    (landing / "c.csv").write_text("a,c\n5,6\n")
    with pytest.raises(ColumnError, match="columns"):
        run()


def test_names_that_begin_alike_are_other_tables(spark, database, tmp_path):
    name, location = database
    landing = tmp_path / "landing"
    landing.mkdir()
    for file, text in (("person.csv", "id\n1\n"), ("person_2024-01-02.csv", "id\n2\n"), ("person_address_1.csv", "id\n9\n"), ("persons.csv", "id\n8\n")):
        (landing / file).write_text(text)
    job = IncrementalBronzeJob(
        spark, str(landing), location, name, {"person": {"file_name": "person"}}, checkpoint=f"{location}/checkpoint"
    )
    (output,) = job.run(partition_by="id", optimize_table=True)
    assert output.table == f"{name}.person" and sorted(r.id for r in output.df.collect()) == ["1", "2"]
    assert [c.name for c in spark.catalog.listColumns(f"{name}.person") if c.isPartition] == ["load_stream", "load_id", "id"]


def test_the_jobs_options_are_honoured(spark, database, tmp_path):
    name, location = database
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "t.csv").write_text("id\n1\n")
    options = {"checkpoint": f"{location}/checkpoint"}
    args = (spark, f"{location}/landing", location, name, {"t": {"file_name": "t"}})
    with pytest.raises(ValueError, match="overwrite"):
        IncrementalBronzeJob(*args, overwrite=True, **options)
    IncrementalBronzeJob(*args, file_format="orc", **options).run()
    assert list((tmp_path / name / "_db" / "t").rglob("*.orc"))
