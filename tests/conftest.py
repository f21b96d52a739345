import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tiersmith-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}/staged")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def database(spark, tmp_path):
    """A database name and location of their own, dropped afterwards."""
    from tiersmith.sources.tables import drop_databases

    name = "t_" + tmp_path.name.lower().replace("-", "_").replace("[", "_").replace("]", "_")
    yield name, str(tmp_path)
    drop_databases(spark, name)
