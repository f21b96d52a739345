"""The person / airport / country pipeline: specs, transforms and configuration."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tiersmith.operators.columns import (
    default_for_null,
    drop_columns,
    replace_column_names,
    where_all_present,
)
from tiersmith.operators.keys import surrogate_key
from tiersmith.operators.quality import Check, ColumnSpec, TableSpec
from tiersmith.plans.config import read_config
from tiersmith.plans.jobs import BronzeJob, GoldJob, RunLedger, SilverJob, Transforms
from tiersmith.session import get_session
from tiersmith.sources.archives import expand_archives
from tiersmith.sources.registry import KeyRegistry
from tiersmith.sources.tables import AUDIT_COLUMN, layer_name, read_table

_NON_NEGATIVE = (Check("ge", {"bound": 0}),)
_COORDINATE = T.DecimalType(10, 0)

# The declared silver tables.
AIRPORT = TableSpec(
    "airport",
    (
        ColumnSpec("airport_id", T.IntegerType(), nullable=True, checks=_NON_NEGATIVE),
        ColumnSpec("airport_code", T.StringType()),
        ColumnSpec("airport_latitude", _COORDINATE, nullable=True, checks=_NON_NEGATIVE),
        ColumnSpec("airport_longitude", _COORDINATE, nullable=True, checks=_NON_NEGATIVE),
        ColumnSpec("airport_name", T.StringType()),
        ColumnSpec("airport_country_code", T.StringType()),
    ),
)
COUNTRY = TableSpec(
    "country",
    (
        ColumnSpec("country_id", T.IntegerType(), nullable=True, checks=_NON_NEGATIVE),
        ColumnSpec("country_country", T.StringType(), unique=True),
        ColumnSpec("country_country_code", T.StringType(), unique=True),
    ),
)
PERSON = TableSpec(
    "person",
    (
        ColumnSpec("person_id", T.IntegerType(), unique=True, checks=_NON_NEGATIVE),
        ColumnSpec("person_first_name", T.StringType()),
        ColumnSpec("person_last_name", T.StringType(), nullable=True),
        ColumnSpec("person_email", T.StringType(), unique=True),
        ColumnSpec("person_gender", T.StringType(), nullable=True),
        ColumnSpec("person_airport_code", T.StringType()),
    ),
)
SPECS = {spec.name: spec for spec in (AIRPORT, COUNTRY, PERSON)}

# Which file, transform and join makes which table.
BRONZE_CONFIG = {
    "airport": {"file_name": "airport_data"},
    "country": {"file_name": "country_data"},
    "person": {"file_name": "person_data"},
}
SILVER_CONFIG = {
    "airport": {"src_name": "airport", "transformation": "airport"},
    "person": {"src_name": "person", "prefix": "person", "transformation": "person"},
    "country": {"src_name": "country", "prefix": "country", "transformation": "country"},
}
GOLD_CONFIG = {
    "person_airport_location": {
        "src_table": "person",
        "transformation": "star_join",
        "join_tables": [
            {"table": "airport", "column_pairs": ["person_airport_code", "airport_code"]},
            {"table": "country", "column_pairs": ["airport_country_code", "country_country_code"]},
        ],
    }
}

transforms = Transforms()


@transforms.register("airport")
def clean_airport(df: DataFrame) -> DataFrame:
    """Unknown coordinates are 0; the id gets the table's prefix."""
    located = default_for_null(df, ["airport_latitude", "airport_longitude"], 0, _COORDINATE)
    return replace_column_names(drop_columns(located, AUDIT_COLUMN), [("id", "airport_id")])


def _country_keys(df: DataFrame) -> DataFrame:
    short = {"name": "country", "code": "country_code"}
    return replace_column_names(df, [(o, n) for o, n in short.items() if o in df.columns])


@transforms.register("country")
def clean_country(df: DataFrame) -> DataFrame:
    """Each country once, numbered in the order of name and code."""
    return surrogate_key(_country_keys(df), ["country", "country_code"], "id")


@transforms.register("person")
def clean_person(df: DataFrame) -> DataFrame:
    return drop_columns(df, AUDIT_COLUMN)


def registered_transforms(countries: KeyRegistry) -> Transforms:
    """The same transforms with countries numbered by a registry, so that later runs keep their ids."""
    kept = Transforms()
    kept.register("airport")(clean_airport)
    kept.register("person")(clean_person)
    kept.register("country")(lambda df: countries.assign(_country_keys(df), ["country", "country_code"]))
    return kept


def run_demo(
    spark: SparkSession,
    landing: str,
    location: str,
    run_hash: str | None = None,
    validate: str = "report",
    run_ts: datetime | None = None,
    archives: str | None = None,
    config: str | None = None,
    resume: bool = False,
    transforms: Transforms = transforms,
) -> DataFrame:
    """Landing to gold in one session; returns the located persons of the gold table.

    With ``resume``, tables that an earlier call with the same ``run_hash`` and
    configuration has finished are not made again.

    With ``archives``, the zip files of that folder are unpacked into landing
    first. ``config`` is a JSON or YAML file whose entries ``bronze``,
    ``silver`` and ``gold`` take the place of the built-in ones.
    """
    layers = {"bronze": BRONZE_CONFIG, "silver": SILVER_CONFIG, "gold": GOLD_CONFIG}
    layers |= read_config(spark, config) if config is not None else {}
    if archives is not None:
        expand_archives(spark, archives, landing)
    bronze, silver, gold = (layer_name(name, run_hash) for name in ("bronze", "silver", "gold"))
    if resume and not run_hash:
        raise ValueError("only a run with a hash can be resumed")
    ledger = RunLedger(spark, location, run_hash) if resume else None
    options = {"overwrite": True, "run_ts": run_ts, "ledger": ledger}
    BronzeJob(spark, landing, location, bronze, layers["bronze"], **options).run()
    SilverJob(
        spark, location, bronze, silver, layers["silver"], SPECS, transforms, validate, **options
    ).run()
    GoldJob(spark, location, silver, gold, layers["gold"], **options).run()
    return where_all_present(
        read_table(spark, gold, "person_airport_location"), "person_id", "airport_id", "country_id"
    )


def preview(df: DataFrame, order_by: Sequence[str | Column], rows: int = 20) -> DataFrame:
    """The first rows of an order; each task keeps no more than these."""
    return df.orderBy(*order_by).limit(rows)


def main() -> None:
    parser = argparse.ArgumentParser(description="Landing to gold; shows located persons.")
    parser.add_argument("landing", help="folder of the CSV files")
    parser.add_argument("location", help="folder for the databases")
    parser.add_argument("--run-hash", help="suffix of the database names")
    parser.add_argument("--validate", choices=("off", "report", "strict"), default="report")
    parser.add_argument("--archives", help="folder of zip files to unpack into landing first")
    parser.add_argument("--resume", action="store_true", help="go on where an earlier run with this hash ended")
    parser.add_argument("--config", help="JSON or YAML file with the configuration of the layers")
    args = parser.parse_args()
    located = run_demo(
        get_session("demo"), args.landing, args.location, args.run_hash, args.validate,
        archives=args.archives, config=args.config, resume=args.resume,
    )
    preview(located, ["person_id"]).show()


if __name__ == "__main__":
    main()
