"""Price capture: shop pages in, products with unit prices out."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.functions.products import (
    base_quantity,
    clean_name,
    clean_price,
    pack_size,
    price_per,
    size_number,
    size_unit,
)
from tiersmith.operators.joins import join_table
from tiersmith.session import stage
from tiersmith.sources.brands import brand_bridge
from tiersmith.sources.landing import write_csv
from tiersmith.sources.pages import absolute_url, linked_cards, product_cards, reached_pages


def unit_price(
    products: DataFrame,
    name: str = "name",
    brand: str = "brand",
    url: str = "url",
    price: Column | None = None,
    keep: tuple[str, ...] = (),
    run_ts: datetime | None = None,
) -> DataFrame:
    """Product rows with cleaned names, parsed pack sizes and unit prices.

    ``price`` is a decimal amount, by default read from ``price_text``. The
    columns ``keep`` are passed on behind the others.
    """
    price = clean_price(F.col("price_text")) if price is None else price
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    read = products.select(
        stamp.alias("timestamp"),
        clean_name(F.col(name)).alias("product_name"),
        F.col(brand).alias("brand_name"),
        F.col(url).alias("url"),
        price.alias("product_price_now"),
        *keep,
    )
    # Columns of their own, so a name is searched once and not once per use.
    found = read.withColumn("__found", pack_size(F.col("product_name")))
    split = found.select(
        "*",
        size_number(F.col("__found")).alias("__number"),
        size_unit(F.col("__found")).alias("__unit"),
    )
    sized = split.withColumn("__size", base_quantity(F.col("__number"), F.col("__unit")))
    priced = sized.withColumn("__per", price_per(F.col("product_price_now"), F.col("__size")))
    return priced.select(
        *[c for c in read.columns if c not in keep],
        F.col("__size.multiplier").alias("product_quantity"),
        F.col("__size.quantity").alias("product_size"),
        F.col("__size.unit").alias("product_size_unit"),
        F.col("__per.price").alias("product_price_per"),
        F.col("__per.unit").alias("product_price_per_unit"),
        *keep,
    )


def capture_prices(
    pages: DataFrame,
    brand_maps: DataFrame,
    json_column: str,
    base_url: str,
    run_ts: datetime | None = None,
    follow_links: bool = False,
) -> DataFrame:
    """Products of all own and competitor brands found on the pages.

    A page belongs to the brand whose address is its url up to the query; with
    ``follow_links`` the pages of a brand are the one at its address and those
    reached from it along the links to the next page, whatever their paths. Own
    and competitor brands are one list of addresses, so the pages are read once
    for all of them; a competitor of two own brands gives its products twice.
    """
    bridge = brand_bridge(brand_maps, json_column, base_url)
    addresses = stage(bridge.groupBy("brand", "url").agg(F.count("*").alias("listed")), "brands")
    # The latter is never NULL, and an empty one is no brand's: else the join has Spark look for NULL
    # where the pages are scanned, which may be in one task.
    shop_url = F.coalesce(F.regexp_extract("url", r"^[^?#]*", 0), F.lit(""))
    place = F.regexp_replace("url", "#.*$", "") if follow_links else shop_url
    # Each page becomes its few small cards before anything is joined or moved,
    # however many brands list its address.
    shop_pages = pages.select(F.col("url").alias("page_url"), place.alias("shop_url"), "html")
    if follow_links:
        # Staged, as both the prices and the walks need them and a page is to be searched once.
        found = stage(linked_cards(shop_pages, "page_url", "shop_url"), "cards")
        cards = found.where("is_card").drop("is_card", "next_link")
        walks = reached_pages(found.select(F.col("page_url").alias("url"), "next_link"), addresses)
        addresses = addresses.join(walks.withColumnRenamed("url", "page"), F.col("url") == F.col("start")).select(
            "brand", F.col("page").alias("url"), "listed"
        )
    else:
        cards = product_cards(shop_pages, "page_url", "shop_url").drop("next_link")
    branded = join_table(cards, addresses, ("shop_url", "url"), "inner")
    products = branded.select(
        "name",
        "brand",
        absolute_url(F.col("page_url"), F.col("link")).alias("url"),
        F.concat("pounds", "rest").alias("price_text"),
        "listed",
    )
    priced = unit_price(products, keep=("listed",), run_ts=run_ts)
    copies = F.explode(F.array_repeat(F.lit(1), F.col("listed").cast("int")))
    return priced.withColumn("listed", copies).drop("listed")


def export_products(products: DataFrame, path: str) -> None:
    """The products as CSV files with a header; quotes in a field are doubled."""
    write_csv(products, path, escape='"')


class PriceJob:
    """From shop pages and brand maps to a landed product file.

    ``run`` captures the prices of all listed brands and lands them as a folder
    of CSV files, ``<landing>/<file_name>_<time of the run>.csv``, which the
    incremental bronze job loads under ``file_name``. It returns that path.
    """

    def __init__(
        self,
        pages: DataFrame,
        brand_maps: DataFrame,
        json_column: str,
        base_url: str,
        landing: str,
        file_name: str = "products",
        run_ts: datetime | None = None,
        follow_links: bool = False,
    ) -> None:
        self.follow_links = follow_links
        self.pages = pages
        self.brand_maps = brand_maps
        self.json_column = json_column
        self.base_url = base_url
        self.landing = landing.rstrip("/")
        self.file_name = file_name
        self.run_ts = run_ts

    def run(self) -> str:
        run_ts = self.run_ts or datetime.now(timezone.utc)
        products = capture_prices(
            self.pages, self.brand_maps, self.json_column, self.base_url, run_ts, self.follow_links
        )
        path = f"{self.landing}/{self.file_name}_{run_ts:%Y%m%dT%H%M%S}.csv"
        export_products(products, path)
        return path
