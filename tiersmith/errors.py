"""Errors raised by the library."""


class ColumnError(ValueError):
    """A column is missing, ambiguous, or holds values an operator rejects."""


class LandingError(ValueError):
    """Files that arrived cannot be told apart or placed without loss."""


class TransformError(LookupError):
    """A job configuration names a transform that nobody registered."""


class DataQualityError(RuntimeError):
    """At least one table failed its checks; ``report`` lists the failures."""

    def __init__(self, report: list[dict]) -> None:
        self.report = report
        lines = [
            "{table_name}.{column_name}: {check_name} failed on {failed_rows} row(s)".format(**row)
            for row in report
        ]
        super().__init__("data quality checks failed\n" + "\n".join(lines))
