"""Job configurations from files."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


def read_config(spark: SparkSession, path: str) -> dict[str, Any]:
    """The mapping in a ``.json``, ``.yml`` or ``.yaml`` file of any store Spark reads.

    YAML needs the ``yaml`` module, which is not a dependency.
    """
    text = "\n".join(row.value for row in spark.read.option("wholetext", True).text(path).collect())
    if path.lower().endswith(".json"):
        found = json.loads(text)
    elif path.lower().endswith((".yml", ".yaml")):
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError(f"{path}: reading YAML needs the yaml module") from error
        found = yaml.safe_load(text)
    else:
        raise ValueError(f"{path}: a configuration ends in .json, .yml or .yaml")
    if not isinstance(found, dict):
        raise ValueError(f"{path}: a configuration is a mapping")
    return found
