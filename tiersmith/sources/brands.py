"""Brand maps: own brands and their competitors, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.functions.products import quote_path

BRAND_MAP_TYPE = "map<string, array<string>>"


def brand_bridge(maps: DataFrame, json_column: str, base_url: str) -> DataFrame:
    """``(own_brand, role, brand, url)`` rows of JSON maps ``{own: [competitor, ...]}``.

    Each own brand gives one ``own`` row and one ``competitor`` row per listed
    name; a competitor of two brands appears under both.
    """
    entries = maps.select(F.explode(F.from_json(json_column, BRAND_MAP_TYPE)))
    named = entries.select(
        F.col("key").alias("own_brand"),
        F.inline(
            F.concat(
                F.array(F.struct(F.lit("own").alias("role"), F.col("key").alias("brand"))),
                F.transform(
                    F.coalesce("value", F.array().cast("array<string>")),
                    lambda name: F.struct(F.lit("competitor").alias("role"), name.alias("brand")),
                ),
            )
        ),
    )
    return named.withColumn("url", brand_url(base_url, F.col("brand")))


def brand_url(base_url: str, brand):
    """The address of a brand's first shop page."""
    return F.concat(F.lit(f"{base_url}/b/"), quote_path(brand))
