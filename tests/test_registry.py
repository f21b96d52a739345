import pytest

from tiersmith.errors import ColumnError
from tiersmith.plans import demo
from tiersmith.sources import registry as module
from tiersmith.sources.registry import KeyRegistry
from tiersmith.sources.tables import read_table


@pytest.fixture
def registry(spark, database):
    name, location = database
    return KeyRegistry(spark, location, name, "keys")


def numbers(registry, rows, schema="a string, b int", keys=("a", "b")):
    df = registry.spark.createDataFrame(rows, schema)
    return {tuple(r)[1:]: r[0] for r in registry.assign(df, list(keys)).collect()}


def test_known_keys_keep_their_numbers(registry):
    first = numbers(registry, [("m", 1), ("b", 2), ("m", 1), (None, 3), ("z", None)])
    assert first == {(None, 3): 1, ("b", 2): 2, ("m", 1): 3, ("z", None): 4}
    second = numbers(registry, [("a", 0), ("z", None), (None, 3), (None, None), ("m", 1)])
    assert second == {("z", None): 4, (None, 3): 1, ("m", 1): 3, (None, None): 5, ("a", 0): 6}
    # Seen again with nothing new, and without the keys of this run.
    assert numbers(registry, [("b", 2)]) == {("b", 2): 2}
    assert numbers(registry, []) == {}


def test_numbers_are_dense_and_unique_over_many_runs(registry):
    seen = {}
    for start in (50, 0, 120, 30):
        found = numbers(registry, [(f"k{i:03}", i) for i in range(start, start + 60)])
        assert all(seen.setdefault(key, n) == n for key, n in found.items())
    assert sorted(seen.values()) == list(range(1, len(seen) + 1))


def test_a_run_that_dies_before_the_append_leaves_nothing(registry, monkeypatch):
    first = numbers(registry, [("x", 1)])

    def dies(*args, **options):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(module, "save_table", dies)
        numbers(registry, [("a", 0), ("x", 1)])
    assert numbers(registry, [("c", 0), ("x", 1)]) == first | {("c", 0): 2}


def test_odd_columns(registry):
    assert numbers(registry, [("v", 1)], "`a.b` string, id int", ("a.b",)) == {("v",): 1}
    with pytest.raises(ColumnError):
        registry.assign(registry.spark.range(1), ["no"])


def test_countries_of_two_runs(spark, database):
    name, location = database
    keep = demo.registered_transforms(KeyRegistry(spark, location, name, "country_keys"))
    countries = [("Namibia", "NA"), ("France", "FR")]
    as_df = lambda rows: spark.createDataFrame(rows, "name string, code string")
    first = {r.country: r.id for r in keep["country"](as_df(countries)).collect()}
    second = {r.country: r.id for r in keep["country"](as_df([*countries, ("Angola", "AO")])).collect()}
    assert first == {"France": 1, "Namibia": 2} and second == first | {"Angola": 3}
    assert read_table(spark, name, "country_keys").count() == 3
