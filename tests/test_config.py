import json

import pytest

from tiersmith.plans.config import read_config


def test_json(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"a": {"b": [1, 2]}}, indent=1))
    assert read_config(spark, str(tmp_path / "c.json")) == {"a": {"b": [1, 2]}}


def test_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c.yml").write_text("a:\n  b: [1, 2]\n")
    assert read_config(spark, str(tmp_path / "c.yml")) == {"a": {"b": [1, 2]}}


@pytest.mark.parametrize("name, text, message", [("c.txt", "{}", "ends in"), ("c.json", "[1]", "mapping")])
def test_what_is_no_configuration(spark, tmp_path, name, text, message):
    (tmp_path / name).write_text(text)
    with pytest.raises(ValueError, match=message):
        read_config(spark, str(tmp_path / name))
