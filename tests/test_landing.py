import random
import shutil
import subprocess
import sys
import zipfile
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tiersmith.errors import ColumnError, LandingError
from tiersmith.plans.jobs import BronzeJob, IncrementalBronzeJob
from tiersmith.sources import archives, landing
from tiersmith.sources.tables import read_table


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "archive").mkdir()
    (tmp_path / "a.csv").write_text('Id;Full Name\n1;"x;y"\n2;\n\n3;NA\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("Id,Full Name\n4,ü\n", encoding="utf-8")
    return tmp_path


def test_csv_tables(spark, folder):
    config = {"first": {"file_name": "a"}, "second": {"file_name": "b"}}
    outputs = landing.read_csv_tables(spark, str(folder), config, "db", sep=";")
    assert [o.table for o in outputs] == ["db.first", "db.second"]
    assert outputs[0].df.dtypes == [("Id", "string"), ("Full Name", "string")]
    assert [tuple(r) for r in outputs[0].df.collect()] == [("1", "x;y"), ("2", None), ("3", "NA")]


def test_missing_csv(spark, folder):
    config = {"first": {"file_name": "a"}, "gone": {"file_name": "z"}}
    with pytest.raises(AnalysisException):
        landing.read_csv_tables(spark, str(folder), config, "db")
    outputs = landing.read_csv_tables(spark, str(folder), config, "db", missing="skip")
    assert [o.table for o in outputs] == ["db.first"]


def test_bronze_names_are_clean(spark, folder):
    job = BronzeJob(spark, str(folder), str(folder), "db", {"t": {"file_name": "a"}}, sep=";")
    assert job.transform()[0].df.columns == ["id", "full_name"]


def test_list_files(spark, folder):
    names = {r.name for r in landing.list_files(spark, str(folder)).collect()}
    assert names == {"a.csv", "b.csv"}
    left = landing.list_files(spark, str(folder), "*.csv", ("a.csv",)).collect()
    assert [(r.name, r.length) for r in left] == [("b.csv", (folder / "b.csv").stat().st_size)]


def test_zip_round_trip(spark, folder):
    packed = archives.zip_files(spark, str(folder), str(folder / "archive"), "run1", "*.csv")
    assert sorted(r.archive.rsplit("/", 1)[1] for r in packed.collect()) == ["a.csv.zip", "b.csv.zip"]
    with zipfile.ZipFile(folder / "archive" / "run1" / "a.csv.zip") as file:
        assert file.read("a.csv") == (folder / "a.csv").read_bytes()
    rows = archives.read_zip_csv(
        spark, str(folder / "archive" / "run1"), ["id", "name"], "a.csv", sep=";"
    )
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "x;y"), ("2", None), ("3", "NA")]


def test_zip_members_in_folders_and_many_batches(spark, tmp_path):
    lines = [f"{i},{'x' * (i % 50)}" for i in range(30_000)]
    with zipfile.ZipFile(tmp_path / "all.zip", "w", zipfile.ZIP_DEFLATED) as file:
        file.writestr("deep/one.csv", "id,text\r\n" + "\r\n".join(lines))
        file.writestr("two.csv", "﻿id,text\n7,last")
        file.writestr("notes.txt", "no")
        file.mkdir("empty")
    (tmp_path / "other.txt").write_text("no zip")
    read = archives.read_zip_lines(spark, str(tmp_path))
    # All members are there unless a glob leaves some out.
    assert {r.member for r in read.select("member").distinct().collect()} == {"deep/one.csv", "two.csv", "notes.txt"}
    rows = archives.read_zip_csv(spark, str(tmp_path), ["id", "text"], members="*.csv")
    assert rows.count() == 30_001
    wanted = {tuple(line.split(",")) for line in lines} | {("7", "last")}
    assert {(r.id, r.text or "") for r in rows.collect()} == wanted
    first = read.where("member = 'two.csv' AND line_no = 0").first()
    assert first.line == "id,text"


def test_tasks_do_not_need_the_package(tmp_path):
    """A session started elsewhere: its Python workers cannot import tiersmith."""
    root = Path(__file__).resolve().parent.parent
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry_points
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print(entry_points.queries()["archive_ingest"](spark, "/root/testdata/sf0.001").count())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.strip().splitlines()[-1:] == ["1500"], done.stderr[-2000:]


def test_header_of_zipped_csv(spark, folder):
    archives.zip_files(spark, str(folder), str(folder / "archive"), "r", "a.csv")
    rows = archives.read_zip_csv(spark, str(folder / "archive" / "r"), sep=";")
    assert rows.columns == ["Id", "Full Name"] and rows.count() == 3


@pytest.mark.parametrize("place", ["plain", "odd %20 näme"])
def test_bronze_job_archives_only_what_it_loaded(spark, folder, database, place):
    name, location = database
    shutil.copytree(folder, folder / place)
    folder = folder / place
    config = {"t": {"file_name": "a"}}
    job = BronzeJob(
        spark, str(folder), location, name, config, sep=";", archive=str(folder / "archive"),
        run_ts=datetime(2024, 1, 1, tzinfo=timezone.utc),
    )
    job.run()
    assert read_table(spark, name, "t").count() == 3
    assert not (folder / "a.csv").exists() and (folder / "b.csv").exists()
    with zipfile.ZipFile(folder / "archive" / "20240101T000000" / "a.csv.zip") as file:
        assert file.namelist() == ["a.csv"]


def test_exclusion_from_packing(spark, folder):
    packed = archives.zip_files(spark, str(folder), str(folder / "archive"), "r", exclude=("a.csv",))
    assert [r.path.rsplit("/", 1)[1] for r in packed.collect()] == ["b.csv"]


def zipped(path, **members):
    with zipfile.ZipFile(path, "w") as file:
        for name, text in members.items():
            file.writestr(name.replace("__", "."), text)


def test_members_are_read_under_their_own_headers(spark, tmp_path):
    zipped(tmp_path / "one.zip", a__csv="a,b\n1,2\n", b__CSV="b,a\n20,10\n")
    zipped(tmp_path / "TWO.ZIP", a__csv="a,b\n3,4\n")
    rows = archives.read_zip_csv(spark, str(tmp_path)).collect()
    assert sorted((r.a, r.b) for r in rows) == [("1", "2"), ("10", "20"), ("3", "4")]
    zipped(tmp_path / "three.zip", c__csv="a,c\n5,6\n")
    with pytest.raises(ColumnError, match="columns"):
        archives.read_zip_csv(spark, str(tmp_path))


def test_all_members_are_unpacked(spark, tmp_path):
    zipped(tmp_path / "x.zip", **{"t__txt": "test", "in/u__CSV": "id\n1", "../../out__txt": "no"})
    got = archives.expand_archives(spark, str(tmp_path), str(tmp_path / "landing"))
    assert sorted(r.member for r in got.collect()) == ["../../out.txt", "in/u.CSV", "t.txt"]
    unpacked = {str(p.relative_to(tmp_path / "landing")): p.read_text() for p in (tmp_path / "landing").rglob("*") if p.is_file() and p.suffix != ".crc"}
    assert unpacked == {"t.txt": "test", "in/u.CSV": "id\n1", "out.txt": "no"}


def test_no_archives(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    assert archives.read_zip_csv(spark, str(tmp_path), ["a"]).count() == 0


def texts(folder):
    return {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file() and not p.name.startswith(".")}


@pytest.fixture
def zips(tmp_path):
    (tmp_path / "zips").mkdir()
    zipped(tmp_path / "zips" / "a.zip", **{"p__csv": "id\n1\n", "x/q__csv": "id\n5\n"})
    zipped(tmp_path / "zips" / "b.zip", **{"p__csv": "id\n2\n"})
    return tmp_path / "zips", tmp_path / "landing"


def test_members_of_one_path_are_an_error_or_numbered(spark, zips):
    source, target = zips
    with pytest.raises(LandingError, match="p.csv"):
        archives.expand_archives(spark, str(source), str(target))
    assert not target.exists()
    got = archives.expand_archives(spark, str(source), str(target), clash="rename")
    assert sorted((r.member, r.path.rsplit("/", 1)[1]) for r in got.collect()) == [("p.csv", "p-2.csv"), ("p.csv", "p.csv"), ("x/q.csv", "q.csv")]
    assert texts(target) == {"p.csv": "id\n1\n", "p-2.csv": "id\n2\n", "x/q.csv": "id\n5\n"}


def test_nothing_is_unpacked_twice(spark, zips):
    source, target = zips
    archives.expand_archives(spark, str(source), str(target), clash="rename")
    shutil.rmtree(target)  # taken away by a load
    assert archives.expand_archives(spark, str(source), str(target), clash="rename").count() == 0
    assert not target.exists()
    # More arrives: numbers go on, and a changed member takes the place of its earlier state.
    zipped(source / "c.zip", **{"p__csv": "id\n3\n"})
    zipped(source / "b.zip", **{"p__csv": "id\n22\n"})
    got = archives.expand_archives(spark, str(source), str(target), clash="rename")
    assert got.count() == 2 and texts(target) == {"p-3.csv": "id\n3\n", "p-2.csv": "id\n22\n"}


def test_paths_within_an_archive_are_resolved(spark, tmp_path):
    (tmp_path / "zips").mkdir()
    with zipfile.ZipFile(tmp_path / "zips" / "a.zip", "w") as file:
        file.writestr("x/p.csv", "one")
        file.writestr("x/../p.csv", "two")
        with pytest.warns(UserWarning):
            file.writestr("x/p.csv", "three")
    with pytest.raises(LandingError):
        archives.expand_archives(spark, str(tmp_path / "zips"), str(tmp_path / "landing"))
    archives.expand_archives(spark, str(tmp_path / "zips"), str(tmp_path / "landing"), clash="rename")
    assert texts(tmp_path / "landing") == {"x/p.csv": "one", "p.csv": "two", "x/p-2.csv": "three"}


def test_a_file_of_other_origin_is_not_replaced(spark, zips):
    source, target = zips
    (source / "b.zip").unlink()
    target.mkdir()
    (target / "p.csv").write_text("mine")
    with pytest.raises(LandingError):
        archives.expand_archives(spark, str(source), str(target))
    archives.expand_archives(spark, str(source), str(target), clash="rename")
    assert texts(target) == {"p.csv": "mine", "p-2.csv": "id\n1\n", "x/q.csv": "id\n5\n"}


@pytest.mark.parametrize("cut", ["before the commit", "before the move", "after some moves"])
def test_a_call_that_died_is_finished_by_the_next(spark, zips, monkeypatch, cut):
    source, target = zips
    finish, calls = archives._Manifest.finish, []

    def dying(self):
        calls.append(1)
        if len(calls) == 2:
            if cut == "after some moves":
                row = self.rows().first()
                target.mkdir()
                Path(row.held.removeprefix("file:")).rename(target / row.path.rsplit("/", 1)[1]) if row.inner == "p.csv" else None
            raise KeyboardInterrupt
        return finish(self)

    def no_commit(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(archives._Manifest, "finish", dying)
        if cut == "before the commit":
            patched.setattr(archives.DataFrame, "withColumnRenamed", no_commit)
        archives.expand_archives(spark, str(source), str(target), clash="rename")
    archives.expand_archives(spark, str(source), str(target), clash="rename")
    assert texts(target) == {"p.csv": "id\n1\n", "p-2.csv": "id\n2\n", "x/q.csv": "id\n5\n"}
    assert not list((target.parent / "_landing.unpacked" / "files").iterdir())


def test_archives_move_away_and_their_members_are_loaded_once(spark, zips, database):
    source, target = zips
    name, location = database
    job = IncrementalBronzeJob(
        spark, str(target), location, name, {"t": {"file_name": "p"}}, checkpoint=f"{location}/checkpoint"
    )
    for _ in range(2):
        archives.expand_archives(spark, str(source), str(target), clash="rename", consumed=str(source.parent / "done"))
        job.run()
    assert sorted(r.id for r in read_table(spark, name, "t").collect()) == ["1", "2"]
    assert sorted(p.name for p in (source.parent / "done").iterdir()) == ["a.zip", "b.zip"] and not list(source.iterdir())


def awkward_rows(n, escape):
    """Values with quotes, escapes, separators and line breaks, next to each other in many ways."""
    draw = random.Random(n)
    pieces = ['"', "\n", ",", "x", "ü", "\n\n", '""', " ", "y" * 30] + (["\\", '\\"', "\\\\"] if escape == "\\" else [])
    return [(str(i), "v" + "".join(draw.choice(pieces) for _ in range(draw.randint(0, 6))) + "v", draw.choice(["", "z"])) for i in range(n)]


@pytest.mark.parametrize("escape", ['"', "\\"])
@pytest.mark.parametrize("part_bytes", [1, 2, 7, 64, 1 << 20])
@pytest.mark.parametrize("ending", ["\n", ""])
def test_records_are_found_in_parts_of_any_size(spark, tmp_path, escape, part_bytes, ending):
    rows = awkward_rows(30 if part_bytes < 7 else 300, escape)
    quote = lambda v: '"' + (v.replace("\\", "\\\\") if escape == "\\" else v).replace('"', escape + '"') + '"'
    text = "id,text,more\n" + "\n".join(f"{i},{quote(t)},{m}" for i, t, m in rows) + ending
    (tmp_path / "a.csv").write_text(text, encoding="utf-8", newline="")
    got = landing.read_csv_records(spark, [str(tmp_path / "a.csv")], escape=escape, part_bytes=part_bytes)
    assert got.columns == ["id", "text", "more"]
    assert sorted((r.id, r.text, r.more or "") for r in got.collect()) == sorted(rows)


def test_a_large_file_with_line_breaks_goes_to_several_tasks(spark, tmp_path):
    df = spark.range(20_000).selectExpr("cast(id AS string) AS id", "concat('line ', id, '\n\"second\", line\n') AS text")
    landing.write_csv(df.coalesce(1), str(tmp_path / "big.csv"))
    (output,) = landing.read_csv_tables(
        spark, str(tmp_path), {"t": {"file_name": "big"}}, "db", line_breaks=True, part_bytes=50_000
    )
    assert output.df.count() == 20_000 and output.df.exceptAll(df).isEmpty()
    per_task = output.df.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 4 and max(r["count"] for r in per_task) < 8_000


def test_parts_are_dealt_evenly(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,t\n" + "".join(f'{i:05d},"x\ny"\n' for i in range(4_000)))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = (tmp_path / "a.csv").stat().st_size
    got = landing.csv_records(spark, [str(tmp_path / "a.csv")], part_bytes=-(-size // (2 * tasks)))
    per_task = [row["count"] for row in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 4_000 and len(per_task) == tasks and max(per_task) < 1.1 * 4_000 / tasks


def test_bytes_that_are_no_text_stay_in_their_record(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"t\na\xc3\r\r\n\r\n\xa9b\n\n")
    got = landing.csv_records(spark, [str(tmp_path / "a.csv")])
    assert sorted(row.record for row in got.collect()) == ["a\ufffd", "\ufffdb"]


def test_records_of_odd_files(spark, tmp_path):
    files = {"a": "id,t\r\n1,\"x\r\ny\"\r\n\r\n2,z\r\n", "b": "id,t", "c": "\ufeffid,t\n3,w", "d": ""}
    for name, text in files.items():
        (tmp_path / f"{name} %20[1].csv").write_text(text, encoding="utf-8", newline="")
    paths = [str(tmp_path / f"{name} %20[1].csv") for name in "abcd"]
    got = landing.read_csv_records(spark, paths, part_bytes=5)
    assert sorted(r.id for r in got.collect()) == ["1", "2", "3"]


def test_a_bronze_job_with_line_breaks_archives_header_only_files(spark, database, tmp_path):
    name, location = database
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "t.csv").write_text('Id,Text\n1,"a\nb"\n')
    (tmp_path / "landing" / "u.csv").write_text("Id,Text\n")
    config = {"t": {"file_name": "t"}, "u": {"file_name": "u"}}
    BronzeJob(spark, str(tmp_path / "landing"), location, name, config, archive=f"{location}/archive", line_breaks=True).run()
    assert [tuple(r)[:2] for r in read_table(spark, name, "t").collect()] == [("1", "a\nb")]
    assert read_table(spark, name, "u").count() == 0
    assert not list((tmp_path / "landing").glob("*.csv"))
    assert sorted(p.name for p in (tmp_path / "archive").rglob("*.zip")) == ["t.csv.zip", "u.csv.zip"]
