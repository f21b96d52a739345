"""What Spark makes of the operators: scans, joins and exchanges."""

import re

import pytest

from tiersmith.operators.keys import surrogate_key
from tiersmith.plans.workload import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture
def plan(spark, capsys):
    def explain(df):
        df.explain()
        return capsys.readouterr().out

    return explain


def test_star_join_broadcasts_dimensions_and_pushes_its_filter(spark, plan):
    text = plan(QUERIES["gold_star_join"](spark, SF_DIR))
    assert text.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in text
    # The filter on the joined rows turns the left joins into inner ones.
    assert "LeftOuter" not in text
    assert "PushedFilters: [IsNotNull(c_custkey)]" in text


def test_semi_join_shuffles_distinct_keys(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(QUERIES["join_how_semi"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange each side: the join reuses that of the distinct keys.
    assert text.count("Exchange hashpartitioning") == 2


def test_surrogate_key_gathers_only_partition_counts(spark, plan):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(surrogate_key(orders, ["o_custkey", "o_orderpriority"]))
    gathered = text[text.index("Exchange SinglePartition"):]
    assert text.count("Exchange SinglePartition") == 1
    assert "_groupingexpression" in gathered and "o_custkey" not in gathered


def test_row_checks_share_one_scan(spark, plan):
    text = plan(QUERIES["dq_report"](spark, SF_DIR))
    # One for all row checks, one for both unique columns, which reads what these are made of.
    assert text.count("FileScan") == 2
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>", text)


def test_recent_years_is_no_join(spark, plan):
    text = plan(QUERIES["dq_recent_years"](spark, SF_DIR))
    assert "Join" not in text and "Cartesian" not in text
    assert set(re.findall(r"ReadSchema: (\S+)", text)) == {"struct<l_shipdate:timestamp_ntz>"}


def test_dropped_columns_are_not_read(spark, plan):
    text = plan(QUERIES["join_drop_other"](spark, SF_DIR))
    read = " ".join(re.findall(r"ReadSchema: (\S+)", text))
    assert "c_acctbal" not in read and "o_totalprice" not in read
