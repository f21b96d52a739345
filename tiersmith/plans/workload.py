"""The registered queries: each operator over whole tables of the test data.

Keys are made to miss on purpose: orders that are pending have no buyer, error
events no user, and customers in debt no nation, so outer joins and filters
have something to do.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.functions.products import clean_name, clean_price
from tiersmith.operators import columns, joins, keys, quality
from tiersmith.operators.quality import Check, ColumnSpec, TableSpec
from tiersmith.plans.demo import BRONZE_CONFIG, GOLD_CONFIG, SILVER_CONFIG, preview, run_demo
from tiersmith.plans.jobs import BronzeJob, IncrementalBronzeJob, SilverJob, Transforms
from tiersmith.plans.prices import PriceJob, capture_prices, export_products, unit_price
from tiersmith.session import scratch_path, stage
from tiersmith.sources.archives import expand_archives, pack_files, read_zip_csv, zip_files
from tiersmith.sources.brands import brand_bridge, brand_url
from tiersmith.sources.landing import list_files, read_csv, write_csv
from tiersmith.sources.pages import link_items, product_cards
from tiersmith.sources.registry import KeyRegistry
from tiersmith.sources.tables import AUDIT_COLUMN, compact_table, read_table, save_table
from tiersmith.streaming.incremental import without_load_columns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RUN_TS = datetime(2024, 1, 1, tzinfo=timezone.utc)
SHOP = "https://shop.example"


def query(function):
    """Register a query under its name, which may end in ``_`` beside an import."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to as many tasks as a shuffle has.

    A scan is cut by bytes and row groups, so rows that are small where they
    are stored and large in what is made of them sit in too few tasks.
    """
    return df.repartition(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def money(name: str) -> Column:
    return F.col(name).cast("decimal(15,2)")


def fresh_database(spark: SparkSession, label: str) -> tuple[str, str]:
    """A location in the shared folder and a database name of their own."""
    location = scratch_path(spark, label)
    return location, location.rsplit("/", 1)[1].replace("-", "_")


# --- joins ---------------------------------------------------------------


def orders_with_buyer(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyer = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", buyer.alias("o_buyer"), "o_orderstatus", "o_totalprice"
    )


def skewed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the orders has one buyer, a third has none."""
    buyer = F.when(F.col("o_orderstatus") == "F", F.lit(7).cast("bigint")).when(
        F.col("o_orderstatus") == "O", F.col("o_custkey") * 2
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", buyer.alias("o_buyer"), "o_orderstatus"
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.when(F.col("event_type") != "error", F.col("user_id"))
    return table(spark, sf_dir, "events").select("event_id", user.alias("buyer"), "event_type")


@query
def gold_star_join(spark, sf_dir):
    nation_of = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))
    customer = table(spark, sf_dir, "customer").withColumn("c_nationkey", nation_of)
    person, airport, country = (
        columns.apply_prefix(df, prefix)
        for df, prefix in (
            (customer, "person"),
            (table(spark, sf_dir, "nation"), "airport"),
            (table(spark, sf_dir, "region"), "country"),
        )
    )
    located = joins.star_join(
        person,
        [
            (airport, ("person_c_nationkey", "airport_n_nationkey")),
            (country, ("airport_n_regionkey", "country_r_regionkey")),
        ],
    )
    return columns.where_all_present(
        located, "person_c_custkey", "airport_n_name", "country_r_name"
    )


@query
def join_drop_keys(spark, sf_dir):
    return joins.join_table(
        orders_with_buyer(spark, sf_dir),
        table(spark, sf_dir, "customer"),
        ("o_buyer", "c_custkey"),
        "left",
    )


@query
def join_keep_keys(spark, sf_dir):
    return joins.join_table(
        orders_with_buyer(spark, sf_dir),
        table(spark, sf_dir, "customer"),
        ("o_buyer", "c_custkey"),
        "left",
        drop_joined_column=False,
    )


@query
def join_drop_other(spark, sf_dir):
    return joins.join_table(
        orders_with_buyer(spark, sf_dir),
        table(spark, sf_dir, "customer"),
        ("o_buyer", "c_custkey"),
        "left",
        drop_joined_column=False,
        other_drop_columns=["o_totalprice", "c_acctbal", "c_mktsegment"],
    )


def _customer_events(how: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return joins.join_table(
            table(spark, sf_dir, "customer"),
            user_events(spark, sf_dir),
            ("c_custkey", "buyer"),
            how,
            drop_joined_column=False,
        )

    return run


for _how in ("inner", "right", "full", "semi", "anti"):
    QUERIES[f"join_how_{_how}"] = _customer_events(_how)


def _skewed(how: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return joins.join_table(
            skewed_orders(spark, sf_dir),
            table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
            ("o_buyer", "c_custkey"),
            how,
            drop_joined_column=False,
            salt=True,
        )

    return run


for _how in ("left", "full", "anti"):
    QUERIES[f"join_skewed_{_how}"] = _skewed(_how)


@query
def join_hot_full(spark, sf_dir):
    """A full join that finds its hot and NULL keys by itself, as sides too large to broadcast do."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, -1)
    try:
        return joins.join_table(
            skewed_orders(spark, sf_dir),
            table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
            ("o_buyer", "c_custkey"),
            "full",
            drop_joined_column=False,
        )
    finally:
        spark.conf.set(limit, before)


# --- columns -------------------------------------------------------------


@query
def rename_columns(spark, sf_dir):
    pairs = [("p_name", "p_type"), ("p_type", "p_name"), ("p_size", "pieces")]
    return columns.replace_column_names(table(spark, sf_dir, "part"), pairs)


@query
def clean_columns(spark, sf_dir):
    dirty = table(spark, sf_dir, "supplier").toDF("S SuppKey", "s.Name!", "__Nation--Key", "(Bal)")
    return columns.clean_column_names(dirty)


@query
def prefix_columns(spark, sf_dir):
    return columns.apply_prefix(table(spark, sf_dir, "part"), "item")


def texts_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text the way landing files hold them, good and bad."""
    order = F.col("o_orderkey").cast("string")
    pending = F.col("o_orderstatus") == "P"
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", money("o_totalprice").cast("string"))
        .when(priority == "2-HIGH", F.concat(F.lit("  "), order, F.lit(" ")))
        .when((priority == "3-MEDIUM") & pending, F.concat(order, F.lit("e1")))
        .when(priority == "3-MEDIUM", F.concat(F.lit("-"), order, F.lit(".5")))
        .when((priority == "4-NOT SPECIFIED") & pending, F.concat(F.lit("99999999999"), order))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("x"), order))
        .when(pending, F.lit(""))
    )
    return table(spark, sf_dir, "orders").select(order.alias("id"), text.alias("amount"), "o_orderstatus")


@query
def cast_table(spark, sf_dir):
    texts = texts_of_orders(spark, sf_dir)
    whole = texts.select("id", "amount", F.col("amount").alias("rounded"), "o_orderstatus")
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("amount", T.IntegerType()),
            T.StructField("rounded", T.DecimalType(10, 0)),
        ]
    )
    return columns.cast_table(whole, schema).withColumn("rounded", F.col("rounded").cast("bigint"))


@query
def regex_replace(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return columns.regex_replace_column(customer, "c_name", ("[#0]+", "-"))


@query
def null_default(spark, sf_dir):
    texts = texts_of_orders(spark, sf_dir)
    filled = columns.default_for_null(texts, ["amount"], 0, T.DecimalType(10, 0))
    return filled.withColumn("amount", F.col("amount").cast("bigint"))


@query
def drop_columns(spark, sf_dir):
    return columns.drop_columns(
        table(spark, sf_dir, "lineitem"), "l_tax", "l_discount", "l_shipdate", "not_there"
    )


# --- keys ----------------------------------------------------------------


@query
def surrogate_key(spark, sf_dir):
    return keys.surrogate_key(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


@query
def surrogate_key_scaled(spark, sf_dir):
    return keys.surrogate_key(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"])


@query
def key_registry(spark, sf_dir):
    """Customers of two runs: those of the first keep their numbers in the second."""
    location, database = fresh_database(spark, "registry")
    registry = KeyRegistry(spark, location, database, "customer_keys")
    customers = table(spark, sf_dir, "customer").select("c_mktsegment", "c_name")
    registry.assign(customers.where("c_acctbal < 3000"), ["c_mktsegment", "c_name"])
    return registry.assign(customers, ["c_mktsegment", "c_name"])


@query
def sparse_id(spark, sf_dir):
    """The ids are arbitrary; whether each is the only one of its kind is not."""
    numbered = stage(keys.sparse_id(table(spark, sf_dir, "part")).select("p_partkey", "id"), "sparse")
    counted = numbered.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return numbered.join(counted, "id", "left").select("p_partkey", (F.col("n") == 1).alias("unique_id"))


@query
def column_pair_map(spark, sf_dir):
    return keys.column_pairs(table(spark, sf_dir, "customer"), "c_custkey", "c_name")


@query
def column_pair_conflicts(spark, sf_dir):
    return keys.column_pair_conflicts(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority"
    )


# --- data quality --------------------------------------------------------

ORDERS_SPEC = TableSpec(
    "orders",
    (
        ColumnSpec("o_orderkey", T.LongType(), unique=True, checks=(Check("ge", {"bound": 1}),)),
        ColumnSpec("o_buyer", T.LongType(), unique=True),
        ColumnSpec(
            "o_orderstatus", T.StringType(), checks=(Check("isin", {"values": ["F", "O"]}),)
        ),
        ColumnSpec("o_totalprice", T.DecimalType(15, 2), checks=(Check("ge", {"bound": 2000}),)),
        ColumnSpec("o_clerk", T.StringType()),
    ),
)


@query
def dq_report(spark, sf_dir):
    return quality.validate_table(orders_with_buyer(spark, sf_dir), ORDERS_SPEC)


@query
def violations(spark, sf_dir):
    """Orders without a buyer do not fail the condition on it."""
    return quality.violations(orders_with_buyer(spark, sf_dir), F.col("o_buyer") >= 100)


@query
def any_violations(spark, sf_dir):
    """Whether a condition fails anywhere, for one that does and one that does not."""
    orders = orders_with_buyer(spark, sf_dir)
    return spark.range(1).select(
        F.lit(quality.has_violations(orders, F.col("o_totalprice") >= 2000)).alias("any_cheap"),
        F.lit(quality.has_violations(orders, F.col("o_orderkey").isNotNull())).alias("any_without_key"),
    )


@query
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(orders_with_buyer(spark, sf_dir), "o_buyer")


@query
def dq_not_future(spark, sf_dir):
    as_of = datetime(1999, 12, 31, tzinfo=timezone.utc)
    checks = (Check("not_in_future", {"as_of": as_of}),)
    dated = ColumnSpec("o_orderdate", T.TimestampType(), checks=checks)
    report = quality.validate_table(
        table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")),
        TableSpec("orders", (dated,)),
    )
    return report.select(
        "column_name", F.split("check_name", "\\(")[0].alias("check_name"), "failed_rows"
    )


@query
def dq_recent_years(spark, sf_dir):
    checks = (Check("within_years", {"ref_col": "l_shipdate", "years": 5}),)
    dated = ColumnSpec("l_shipdate", T.TimestampType(), checks=checks)
    report = quality.validate_table(
        table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")),
        TableSpec("lineitem", (dated,)),
    )
    return report.select(
        "column_name", F.split("check_name", "\\(")[0].alias("check_name"), "failed_rows"
    )


def supplier_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.extract(F.lit("YEAROFWEEK"), F.col("l_shipdate")).cast("bigint").alias("year"),
        F.weekofyear("l_shipdate").cast("bigint").alias("week"),
    )


@query
def adjacent_rows(spark, sf_dir):
    return keys.with_next(supplier_weeks(spark, sf_dir), "week", ["year"], ["l_suppkey"])


@query
def dq_week_continuity(spark, sf_dir):
    return quality.continuity_breaks(
        supplier_weeks(spark, sf_dir), "week", order_by=["year"], series=["l_suppkey"]
    )


# --- landing files and tables --------------------------------------------


@query
def csv_ingest(spark, sf_dir):
    location, database = fresh_database(spark, "csv_ingest")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Cust Key"),
        F.col("c_name").alias("Name!"),
        money("c_acctbal").alias("Acct.Bal"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("--segment--"),
    )
    landing = f"{location}/landing"
    write_csv(customers, f"{landing}/customer_data.csv")
    config = {"customer": {"file_name": "customer_data"}}
    BronzeJob(spark, landing, location, database, config, run_ts=RUN_TS).run()
    return columns.drop_columns(read_table(spark, database, "customer"), AUDIT_COLUMN)


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order Key"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order Date"),
        F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"')).alias("Note"),
        money("o_totalprice").alias("Total"),
    )


@query
def csv_line_breaks(spark, sf_dir):
    """One large file whose quoted fields hold line breaks and quotes, read by several tasks."""
    location, database = fresh_database(spark, "line_breaks")
    note = F.concat("o_orderpriority", F.lit(':\n "'), "o_orderstatus", F.lit('",\n\n'), F.col("o_orderkey").cast("string"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Order Key"), note.alias("Note"))
    write_csv(orders.coalesce(1), f"{location}/landing/orders_data.csv", escape='"')
    config = {"orders": {"file_name": "orders_data"}}
    BronzeJob(
        spark, f"{location}/landing", location, database, config, run_ts=RUN_TS,
        line_breaks=True, escape='"', part_bytes=1 << 17,
    ).run()
    return columns.drop_columns(read_table(spark, database, "orders"), AUDIT_COLUMN)


@query
def zip_ingest(spark, sf_dir):
    """Packed files with their columns in two orders, read under their own headers."""
    folder = scratch_path(spark, "zip_ingest")
    orders = order_texts(spark, sf_dir)
    even = F.col("Order Key") % 2 == 0
    write_csv(orders.where(even), f"{folder}/landing_a")
    write_csv(orders.where(~even).select(*reversed(orders.columns)), f"{folder}/landing_b")
    for part in "ab":
        zip_files(spark, f"{folder}/landing_{part}", f"{folder}/archive/{part}", "first", include="*.csv")
    return columns.clean_column_names(read_zip_csv(spark, f"{folder}/archive/*/first"))


@query
def archive_once(spark, sf_dir):
    """Archives with members of one name, unpacked and loaded once however often both are run."""
    location, database = fresh_database(spark, "archive_once")
    orders = order_texts(spark, sf_dir)
    urgent = orders["Note"].startswith("1-URGENT")
    for number, rows in enumerate((orders.where(~urgent), orders.where(urgent).select(*reversed(orders.columns)))):
        write_csv(rows.coalesce(1), f"{location}/written/{number}")
        named = list_files(spark, f"{location}/written/{number}", "*.csv").select("path", F.lit("orders_data.csv").alias("name"))
        pack_files(named, f"{location}/arrived/{number}")
    job = IncrementalBronzeJob(
        spark, f"{location}/landing", location, database, {"orders": {"file_name": "orders_data"}},
        run_ts=RUN_TS, checkpoint=f"{location}/checkpoint",
    )
    for _ in range(2):
        expand_archives(spark, f"{location}/arrived/*", f"{location}/landing", clash="rename")
        job.run()
    return without_load_columns(read_table(spark, database, "orders"))


@query
def archive_ingest(spark, sf_dir):
    """What a bronze job loaded, read back from where it archived the files."""
    location, database = fresh_database(spark, "archive_ingest")
    write_csv(order_texts(spark, sf_dir), f"{location}/landing/orders_data.csv")
    config = {"orders": {"file_name": "orders_data"}}
    archive = f"{location}/archive"
    BronzeJob(
        spark, f"{location}/landing", location, database, config, archive=archive, run_ts=RUN_TS
    ).run()
    archived = read_zip_csv(spark, f"{archive}/20240101T000000/orders_data.csv")
    return columns.clean_column_names(archived)


@query
def save_append_overwrite(spark, sf_dir):
    location, database = fresh_database(spark, "saved")
    customers = table(spark, sf_dir, "customer")
    later = datetime(2024, 2, 1, tzinfo=timezone.utc)
    for overwrite, run_ts in ((False, RUN_TS), (True, RUN_TS), (False, later)):
        save_table(
            spark,
            customers,
            location,
            database,
            "customer",
            overwrite=overwrite,
            partition_by="c_mktsegment",
            run_ts=run_ts,
        )
    saved = read_table(spark, database, "customer")
    return saved.withColumn(AUDIT_COLUMN, F.date_format(AUDIT_COLUMN, "yyyy-MM-dd HH:mm:ss"))


@query
def compact_table_(spark, sf_dir):
    """Two tables compacted side by side, appended to where they are then, and compacted again."""
    location, database = fresh_database(spark, "compacted")
    orders = table(spark, sf_dir, "orders")
    halves = {"early": orders.where("o_orderkey % 2 = 0"), "late": orders.where("o_orderkey % 2 = 1")}

    def save(name: str, overwrite: bool) -> None:
        save_table(
            spark, halves[name], location, database, name, overwrite=overwrite, partition_by=["o_orderstatus"], run_ts=RUN_TS
        )

    def fill(name: str) -> None:
        save(name, overwrite=True)
        compact_table(spark, database, name)
        save(name, overwrite=False)
        compact_table(spark, database, name)

    with ThreadPoolExecutor(len(halves)) as pool:
        list(pool.map(inheritable_thread_target(spark)(fill), halves))
    saved = [columns.drop_columns(read_table(spark, database, name), AUDIT_COLUMN) for name in halves]
    return saved[0].unionByName(saved[1])


@query
def incremental_ingest(spark, sf_dir):
    """Two landing folders into one table; the second has its columns in another order."""
    location, database = fresh_database(spark, "incremental")
    orders = table(spark, sf_dir, "orders").withColumn("o_totalprice", money("o_totalprice"))
    orders = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    pending, urgent = F.col("o_orderstatus") == "P", F.col("o_orderpriority") == "1-URGENT"
    for folder, rows in (("a", orders.where(~urgent)), ("b", orders.where(urgent).select(*reversed(orders.columns)))):
        landing = f"{location}/landing_{folder}"
        job = IncrementalBronzeJob(
            spark,
            landing,
            location,
            database,
            {"orders": {"file_name": "orders_data"}},
            run_ts=RUN_TS,
            checkpoint=f"{location}/checkpoint_{folder}",
            archive=f"{location}/archive_{folder}",
        )
        # The name of another table begins alike; the third run finds nothing new.
        rows.limit(5).write.option("header", True).csv(f"{landing}/orders_data_old.csv")
        rows.limit(5).select("o_orderkey").write.option("header", True).csv(f"{landing}/orders_data_2024_returns.csv")
        for arrived in (rows.where(~pending), rows.where(pending), None):
            if arrived is not None:
                arrived.write.mode("append").option("header", True).csv(f"{landing}/orders_data.csv")
            job.run(optimize_table=arrived is None)
    return without_load_columns(read_table(spark, database, "orders"))


# --- products ------------------------------------------------------------


@query
def brand_bridge_(spark, sf_dir):
    maps = table(spark, sf_dir, "part").select(
        F.to_json(
            F.create_map(
                F.concat("p_brand", F.lit("+")),
                F.array(F.concat("p_type", F.lit(" & "), "p_name"), F.concat("p_name", F.lit("/~*"))),
            )
        ).alias("brands")
    )
    return brand_bridge(maps, "brands", SHOP)


@query
def page_items(spark, sf_dir):
    return link_items(table(spark, sf_dir, "pages"))


def _by_turn(options: list[Column]) -> Column:
    """One of the options for each part, in turn of the part keys."""
    chosen = options[-1]
    for turn, option in enumerate(options[:-1]):
        chosen = F.when(F.col("p_partkey") % len(options) == turn, option).otherwise(chosen)
    return chosen


def priced_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = money("p_retailprice").cast("string")
    size = F.col("p_size").cast("string")
    names = [
        F.concat("p_name", F.lit(" "), size, F.lit(suffix))
        for suffix in ("ml", "g", " L", "cl", "kg", " Pack", "'s", "", ".5 litre", " Sachets")
    ]
    names += [
        F.concat(F.lit("3x"), size, F.lit("ML "), "p_name"),
        F.concat("p_name", F.lit(" ."), size, F.lit("g")),
        F.concat("p_name", F.lit(" 0ml")),
    ]
    prices = [
        F.concat(F.lit("£"), price),
        F.concat(F.lit(" £ "), price, F.lit(" ")),
        price,
        F.lit("n/a"),
        F.concat(F.lit("was £"), price, F.lit("\n")),
    ]
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(_by_turn(names), F.lit(" &amp; "), "p_type").alias("name"),
        F.col("p_brand").alias("brand"),
        brand_url(SHOP, F.col("p_brand")).alias("url"),
        _by_turn(prices).alias("price_text"),
    )


def comparable(products: DataFrame) -> DataFrame:
    """The decimal columns as doubles, without the time of the run."""
    return products.drop("timestamp").withColumns(
        {
            name: F.col(name).cast("double")
            for name in ("product_price_now", "product_size", "product_price_per")
        }
    )


@query
def clean_name_price(spark, sf_dir):
    return priced_parts(spark, sf_dir).select(
        "p_partkey",
        clean_name(F.col("name")).alias("product_name"),
        clean_price(F.col("price_text")).cast("double").alias("product_price_now"),
    )


@query
def unit_price_(spark, sf_dir):
    return comparable(unit_price(priced_parts(spark, sf_dir), run_ts=RUN_TS))


@query
def product_csv_export(spark, sf_dir):
    path = scratch_path(spark, "products")
    export_products(unit_price(priced_parts(spark, sf_dir), run_ts=RUN_TS), path)
    return read_csv(spark, path, escape='"').drop("timestamp")


def shop_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shop page for each part: the part in two packs, and a link to the next page."""

    def card(size: Column, pounds: Column, pence: Column) -> Column:
        return F.concat(
            F.lit('<li class="col item__gutter"><a class="item__productName" href="/p/'),
            F.col("p_partkey").cast("string"),
            F.lit("-"),
            size,
            F.lit('">'),
            F.col("p_name"),
            F.lit(" "),
            size,
            F.lit('</a><span class="item__price"><span class="item__price--theme-large">£'),
            pounds,
            F.lit("</span>."),
            pence,
            F.lit("</span></li>"),
        )

    part = spread(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size", "p_retailprice"))
    amount = F.split(money("p_retailprice").cast("string"), "\\.")
    size = F.col("p_size").cast("string")
    html = F.concat(
        F.lit('<html><body><div class="plp grid"><ul>'),
        card(F.concat(size, F.lit("ml")), amount[0], amount[1]),
        card(F.concat(size, F.lit("pk")), F.concat(amount[0], F.lit("0")), amount[1]),
        F.lit('</ul><a class="icon icon-angle-right" href="?page='),
        (F.col("p_partkey") + 1).cast("string"),
        # What comes behind the shelf is none of it.
        F.lit('">next</a><div class="note"><div>End</div></div></div><div class="recommended"><ul>'),
        card(F.lit("9999ml"), F.lit("1"), F.lit("99")),
        F.lit('</ul></div><a class="icon-angle-right" href="/elsewhere">more</a></body></html>'),
    )
    url = F.concat(
        brand_url(SHOP, F.col("p_brand")), F.lit("?page="), F.col("p_partkey").cast("string")
    )
    return part.select(F.col("p_partkey").alias("page_id"), url.alias("url"), html.alias("html"))


def brand_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every brand in the parts one map: the brand and one or two competitors."""
    number = F.split("p_brand", "#")[1].cast("int")

    def brand(n: Column) -> Column:
        return F.concat(F.lit("Brand#"), n.cast("string"))

    competitors = F.when(number * 2 <= 25, F.array(brand(26 - number), brand(number * 2)))
    competitors = competitors.otherwise(F.array(brand(26 - number)))
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    return brands.select(F.to_json(F.create_map("p_brand", competitors)).alias("brands"))


@query
def shop_cards(spark, sf_dir):
    return product_cards(shop_pages(spark, sf_dir), "page_id")


@query
def price_capture(spark, sf_dir):
    found = capture_prices(
        shop_pages(spark, sf_dir), brand_maps(spark, sf_dir), "brands", SHOP, run_ts=RUN_TS
    )
    return comparable(found)


@query
def price_job(spark, sf_dir):
    """The file that the price job lands, read back."""
    landing = scratch_path(spark, "price_job")
    job = PriceJob(shop_pages(spark, sf_dir), brand_maps(spark, sf_dir), "brands", SHOP, landing, run_ts=RUN_TS)
    return read_csv(spark, job.run(), escape='"').drop("timestamp")


def walked_shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of a brand on pages of its own that only links lead to, the last one back to the first.

    The page at the brand's address is an empty shelf. Pages behind it have other
    paths, comments within their shelf, and a neighbour that nothing links to.
    """
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size", "p_retailprice")
    by_key = Window.partitionBy("p_brand").orderBy("p_partkey")
    ahead = F.coalesce(F.lead("p_partkey").over(by_key), F.min("p_partkey").over(Window.partitionBy("p_brand")))
    # The brands are few, and each one's parts come from one task.
    numbered = spread(parts.withColumn("ahead", ahead))
    amount = F.split(money("p_retailprice").cast("string"), "\\.")

    def page(body: Column, link: Column) -> Column:
        return F.concat(
            F.lit('<div class="plp"><!-- <div> --><ul>'), body,
            F.lit('</ul><a title="more > next" class="icon-angle-right" href="'), link,
            F.lit('">next</a></div><a class="icon-angle-right" href="/b/none">no</a>'),
        )

    card = F.concat(
        F.lit('<li class="item__gutter"><a class="item__productName" href="/p/'), F.col("p_partkey").cast("string"),
        F.lit('">'), F.col("p_name"), F.lit(" "), F.col("p_size").cast("string"),
        F.lit('ml</a><span class="item__price"><span class="item__price--theme-large">£'), amount[0],
        F.lit("</span>."), amount[1], F.lit("</span></li>"),
    )
    place = F.concat(F.lit(f"{SHOP}/list?part="), F.col("p_partkey").cast("string"), F.lit("&v="))
    linked = numbered.select(
        F.concat(place, F.lit("1")).alias("url"),
        page(card, F.concat(F.lit("?part="), F.col("ahead").cast("string"), F.lit("&amp;v=1#top"))).alias("html"),
    )
    unlinked = spread(parts).select(
        F.concat(place, F.lit("2")).alias("url"), page(card, F.lit("?part=1&amp;v=1")).alias("html")
    )
    first = parts.groupBy("p_brand").agg(F.min("p_partkey").alias("first")).select(
        brand_url(SHOP, F.col("p_brand")).alias("url"),
        page(F.lit(""), F.concat(F.lit("/list?part="), F.col("first").cast("string"), F.lit("&amp;v=1"))).alias("html"),
    )
    return first.unionByName(linked).unionByName(unlinked)


@query
def price_walk(spark, sf_dir):
    """Prices of the pages that the links from each brand's address lead to."""
    found = capture_prices(
        walked_shop(spark, sf_dir), brand_maps(spark, sf_dir), "brands", SHOP, run_ts=RUN_TS, follow_links=True
    )
    return comparable(found)


# --- end to end ----------------------------------------------------------


@query
def price_job_bronze(spark, sf_dir):
    """The price job's file as a bronze table, with line breaks and quotes in product names."""
    location, database = fresh_database(spark, "price_job_bronze")
    pages = shop_pages(spark, sf_dir).withColumn("html", F.replace("html", F.lit("ml</a>"), F.lit('ml\n "new", big</a>')))
    PriceJob(pages, brand_maps(spark, sf_dir), "brands", SHOP, f"{location}/landing", run_ts=RUN_TS).run()
    IncrementalBronzeJob(
        spark, f"{location}/landing", location, database, {"prices": {"file_name": "products"}},
        run_ts=RUN_TS, checkpoint=f"{location}/checkpoint", escape='"', line_breaks=True,
    ).run()
    return without_load_columns(read_table(spark, database, "prices")).drop("timestamp")


@query
def silver_cached(spark, sf_dir):
    """A silver table whose checked rows are kept for the save."""
    location, database = fresh_database(spark, "silver_cached")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), "c_name", F.col("c_acctbal").cast("string").alias("c_acctbal")
    )
    save_table(spark, customers, location, f"{database}_bronze", "customer", run_ts=RUN_TS)
    spec = TableSpec(
        "customer",
        (
            ColumnSpec("customer_id", T.LongType(), unique=True),
            ColumnSpec("customer_c_name", T.StringType(), unique=True),
            ColumnSpec("customer_c_acctbal", T.DecimalType(10, 0)),
        ),
    )
    transforms = Transforms()
    transforms.register("plain")(lambda df: columns.drop_columns(df, AUDIT_COLUMN))
    config = {"customer": {"src_name": "customer", "prefix": "customer", "transformation": "plain"}}
    SilverJob(
        spark, location, f"{database}_bronze", database, config, {"customer": spec}, transforms,
        validate="strict", cache_checked=True, run_ts=RUN_TS,
    ).run()
    saved = columns.drop_columns(read_table(spark, database, "customer"), AUDIT_COLUMN)
    return saved.withColumn("customer_c_acctbal", F.col("customer_c_acctbal").cast("bigint"))


@query
def preview_rows(spark, sf_dir):
    """The first located customers by balance."""
    located = gold_star_join(spark, sf_dir).select("person_c_custkey", "person_c_acctbal", "country_r_name")
    return preview(located, [F.desc("person_c_acctbal"), "person_c_custkey"])




@query
def medallion_end_to_end(spark, sf_dir):
    location, run_hash = fresh_database(spark, "demo")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    in_debt = F.col("c_acctbal") < 0
    nation_code = F.concat(F.lit("A"), F.col("n_nationkey").cast("string"))
    files = {
        "person": customer.select(
            F.col("c_custkey").alias("ID"),
            F.col("c_mktsegment").alias("First Name"),
            F.when(~in_debt, F.col("c_name")).alias("Last Name"),
            F.concat("c_name", F.lit("@example.com")).alias("Email"),
            F.lit(None).cast("string").alias("gender"),
            F.when(in_debt, "none")
            .otherwise(F.concat(F.lit("A"), F.col("c_nationkey").cast("string")))
            .alias("Airport Code"),
        ),
        "airport": nation.select(
            F.col("n_nationkey").alias("id"),
            nation_code.alias("airport_code"),
            F.when(F.col("n_regionkey") > 0, F.concat(F.col("n_nationkey").cast("string"), F.lit(".6")))
            .alias("airport_latitude"),
            F.concat(F.lit("-"), F.col("n_nationkey").cast("string"), F.lit(".4")).alias("airport_longitude"),
            F.col("n_name").alias("airport_name"),
            F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("airport_country_code"),
        ),
        "country": region.select(
            F.col("r_regionkey").alias("id"),
            F.col("r_name").alias("name"),
            F.concat(F.lit("C"), F.col("r_regionkey").cast("string")).alias("code"),
        ),
    }
    for name, df in files.items():
        write_csv(df, f"{location}/arrived/{name}_data.csv")
        # The names inside an archive are the file names that landing expects.
        zip_files(spark, f"{location}/arrived/{name}_data.csv", f"{location}/archives", name, include="*.csv")
    landing = f"{location}/landing"
    for name in files:
        expand_archives(spark, f"{location}/archives/{name}", f"{landing}/{name}_data.csv")
    layers = {"bronze": BRONZE_CONFIG, "silver": SILVER_CONFIG, "gold": GOLD_CONFIG}
    config = f"{location}/layers.json"
    spark.range(1).select(F.lit(json.dumps(layers))).coalesce(1).write.text(config)
    located = run_demo(spark, landing, location, run_hash, "report", RUN_TS, config=config)
    return located.drop(AUDIT_COLUMN).withColumns(
        {name: F.col(name).cast("bigint") for name in ("airport_latitude", "airport_longitude")}
    )
