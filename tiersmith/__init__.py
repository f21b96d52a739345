"""tiersmith: layered (landing, bronze, silver, gold) pipelines on PySpark."""

from tiersmith.errors import ColumnError, DataQualityError, TransformError

__all__ = ["ColumnError", "DataQualityError", "TransformError"]
