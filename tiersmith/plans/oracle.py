"""For each registered query the SQL that states its result independently."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_BUYERS = """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_buyer,
           o_orderstatus, o_totalprice
    FROM orders
"""

_SKEWED = """
    SELECT o_orderkey, o_orderstatus,
           CASE o_orderstatus WHEN 'F' THEN CAST(7 AS BIGINT) WHEN 'O' THEN o_custkey * 2 END AS o_buyer
    FROM orders
"""

_EVENTS = """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS buyer, event_type
    FROM events
"""

_TEXTS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus,
           CASE WHEN o_orderpriority = '1-URGENT'
                  THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)
                WHEN o_orderpriority = '2-HIGH' THEN '  ' || o_orderkey || ' '
                WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN o_orderkey || 'e1'
                WHEN o_orderpriority = '3-MEDIUM' THEN '-' || o_orderkey || '.5'
                WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'
                  THEN '99999999999' || o_orderkey
                WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'x' || o_orderkey
                WHEN o_orderstatus = 'P' THEN '' END AS amount
    FROM orders
"""

_ROUNDED = """TRY_CAST(CAST(round(TRY_CAST(trim(amount) AS DECIMAL(38,6))) AS DECIMAL(38,0)) AS DECIMAL(10,0))"""

ORACLE["gold_star_join"] = """
    SELECT c_custkey AS person_c_custkey, c_name AS person_c_name, c_acctbal AS person_c_acctbal,
           c_mktsegment AS person_c_mktsegment, n_name AS airport_n_name, r_name AS country_r_name
    FROM customer
    LEFT JOIN nation ON n_nationkey = CASE WHEN c_acctbal >= 0 THEN c_nationkey END
    LEFT JOIN region ON n_regionkey = r_regionkey
    WHERE c_custkey IS NOT NULL AND n_name IS NOT NULL AND r_name IS NOT NULL
"""
ORACLE["join_drop_keys"] = f"""
    SELECT o_orderkey, o_orderstatus, o_totalprice, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM ({_BUYERS}) LEFT JOIN customer ON o_buyer = c_custkey
"""
ORACLE["join_keep_keys"] = f"""
    SELECT o_orderkey, o_buyer, o_orderstatus, o_totalprice,
           c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM ({_BUYERS}) LEFT JOIN customer ON o_buyer = c_custkey
"""
ORACLE["join_drop_other"] = f"""
    SELECT o_orderkey, o_buyer, o_orderstatus, c_custkey, c_name, c_nationkey
    FROM ({_BUYERS}) LEFT JOIN customer ON o_buyer = c_custkey
"""
for _how in ("INNER", "RIGHT", "FULL", "SEMI", "ANTI"):
    ORACLE[f"join_how_{_how.lower()}"] = (
        f"SELECT * FROM customer {_how} JOIN ({_EVENTS}) ON c_custkey = buyer"
    )
for _how in ("LEFT", "FULL", "ANTI"):
    _right = "" if _how == "ANTI" else ", c_custkey, c_name"
    ORACLE[f"join_skewed_{_how.lower()}"] = f"""
        SELECT o_orderkey, o_buyer, o_orderstatus{_right}
        FROM ({_SKEWED}) {_how} JOIN customer ON o_buyer = c_custkey
    """

ORACLE["join_hot_full"] = ORACLE["join_skewed_full"]
ORACLE["rename_columns"] = """
    SELECT p_partkey, p_name AS p_type, p_brand, p_type AS p_name, p_size AS pieces, p_retailprice
    FROM part
"""
ORACLE["clean_columns"] = """
    SELECT s_suppkey AS s_suppkey, s_name AS s_name, s_nationkey AS nation_key, s_acctbal AS bal
    FROM supplier
"""
ORACLE["prefix_columns"] = """
    SELECT p_partkey AS item_p_partkey, p_name AS item_p_name, p_brand AS item_p_brand,
           p_type AS item_p_type, p_size AS item_p_size, p_retailprice AS item_p_retailprice
    FROM part
"""
ORACLE["cast_table"] = f"""
    SELECT CAST(id AS BIGINT) AS id,
           CASE WHEN regexp_full_match(trim(amount), '[+-]?[0-9]+([.][0-9]*)?')
                THEN TRY_CAST(trunc(TRY_CAST(trim(amount) AS DECIMAL(38,6))) AS INTEGER) END AS amount,
           CAST({_ROUNDED} AS BIGINT) AS rounded
    FROM ({_TEXTS})
"""
ORACLE["regex_replace"] = """
    SELECT c_custkey, regexp_replace(c_name, '[#0]+', '-', 'g') AS c_name FROM customer
"""
ORACLE["null_default"] = f"""
    SELECT id, CASE WHEN amount IS NULL THEN 0 ELSE CAST({_ROUNDED} AS BIGINT) END AS amount,
           o_orderstatus
    FROM ({_TEXTS})
"""
ORACLE["drop_columns"] = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           l_returnflag, l_linestatus
    FROM lineitem
"""
ORACLE["surrogate_key"] = """
    SELECT row_number() OVER (ORDER BY p_brand, p_type) AS id, p_brand, p_type
    FROM (SELECT DISTINCT p_brand, p_type FROM part)
"""
ORACLE["surrogate_key_scaled"] = """
    SELECT row_number() OVER (ORDER BY o_custkey, o_orderpriority) AS id, o_custkey, o_orderpriority
    FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)
"""
ORACLE["sparse_id"] = "SELECT p_partkey, true AS unique_id FROM part"
ORACLE["column_pair_map"] = """
    SELECT c_custkey AS "left", c_name AS "right" FROM customer
    WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL
"""
ORACLE["column_pair_conflicts"] = """
    SELECT o_custkey, count(DISTINCT o_orderpriority) AS distinct_values
    FROM orders WHERE o_custkey IS NOT NULL
    GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 1
"""


def _line(column: str, check: str, failed: str) -> str:
    check = check.replace("'", "''")
    return (
        f"SELECT 'orders' AS table_name, '{column}' AS column_name, '{check}' AS check_name, "
        f"CAST(({failed}) AS BIGINT) AS failed_rows"
    )


def _repeated(column: str) -> str:
    return (
        f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM ({_BUYERS}) "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


ORACLE["dq_report"] = " UNION ALL ".join(
    [
        _line("o_orderkey", "present", "0"),
        _line("o_orderkey", "dtype(bigint)", "0"),
        _line("o_orderkey", "not_null", "SELECT count(*) FILTER (o_orderkey IS NULL) FROM orders"),
        _line("o_orderkey", "ge(bound=1)", "SELECT count(*) FILTER (NOT o_orderkey >= 1) FROM orders"),
        _line("o_orderkey", "unique", _repeated("o_orderkey")),
        _line("o_buyer", "present", "0"),
        _line("o_buyer", "dtype(bigint)", "0"),
        _line("o_buyer", "not_null", f"SELECT count(*) FILTER (o_buyer IS NULL) FROM ({_BUYERS})"),
        _line("o_buyer", "unique", _repeated("o_buyer")),
        _line("o_orderstatus", "present", "0"),
        _line("o_orderstatus", "dtype(string)", "0"),
        _line("o_orderstatus", "not_null", "SELECT count(*) FILTER (o_orderstatus IS NULL) FROM orders"),
        _line(
            "o_orderstatus",
            "isin(values=['F', 'O'])",
            "SELECT count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders",
        ),
        _line("o_totalprice", "present", "0"),
        _line("o_totalprice", "dtype(decimal(15,2))", "SELECT count(*) FROM orders"),
        _line("o_totalprice", "not_null", "SELECT count(*) FILTER (o_totalprice IS NULL) FROM orders"),
        _line("o_totalprice", "ge(bound=2000)", "SELECT count(*) FILTER (o_totalprice < 2000) FROM orders"),
        _line("o_clerk", "present", "SELECT count(*) FROM orders"),
    ]
)


def _date_lines(table: str, column: str, check: str, condition: str) -> str:
    found = f"SELECT count(*) FILTER (NOT ({condition})) FROM {table}"
    missing = f"SELECT count(*) FILTER ({column} IS NULL) FROM {table}"
    lines = [("present", "0"), ("dtype", "0"), ("not_null", missing), (check, found)]
    return " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, '{name}' AS check_name, "
        f"CAST(({failed}) AS BIGINT) AS failed_rows"
        for name, failed in lines
    )


ORACLE["dq_not_future"] = _date_lines(
    "orders", "o_orderdate", "not_in_future", "o_orderdate <= TIMESTAMP '1999-12-31 00:00:00'"
)
ORACLE["dq_recent_years"] = _date_lines(
    "lineitem",
    "l_shipdate",
    "within_years",
    "l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 5 YEAR",
)
ORACLE["violations"] = f"SELECT * FROM ({_BUYERS}) WHERE NOT o_buyer >= 100"
ORACLE["any_violations"] = """
    SELECT bool_or(NOT o_totalprice >= 2000) AS any_cheap, bool_or(o_orderkey IS NULL) AS any_without_key
    FROM orders
"""
ORACLE["duplicate_keys"] = f"""
    SELECT o_buyer, count(*) AS n_rows FROM ({_BUYERS}) GROUP BY o_buyer HAVING count(*) > 1
"""
ORACLE["adjacent_rows"] = """
    SELECT *, lead(week) OVER (PARTITION BY l_suppkey ORDER BY year, week) AS next_value
    FROM (SELECT DISTINCT l_suppkey, CAST(isoyear(l_shipdate) AS BIGINT) AS year,
                 CAST(week(l_shipdate) AS BIGINT) AS week
          FROM lineitem)
"""
ORACLE["dq_week_continuity"] = f"""
    SELECT l_suppkey, year, week, next_value FROM ({ORACLE["adjacent_rows"]})
    WHERE NOT (next_value - week = 1 OR (next_value = 1 AND week IN (49, 50, 51, 52, 53, 54)))
"""

ORACLE["csv_ingest"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS cust_key, c_name AS name,
           CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR) AS acct_bal,
           CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment
    FROM customer
"""
ORACLE["zip_ingest"] = """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_key, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
           o_orderpriority || ', "' || o_orderstatus || '"' AS note,
           CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total
    FROM orders
"""
ORACLE["archive_ingest"] = ORACLE["archive_once"] = ORACLE["zip_ingest"]
ORACLE["csv_line_breaks"] = r"""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
           o_orderpriority || E':\n "' || o_orderstatus || E'",\n\n' || o_orderkey AS note
    FROM orders
"""
ORACLE["save_append_overwrite"] = """
    SELECT *, '2024-01-01 00:00:00' AS processing_ts FROM customer
    UNION ALL SELECT *, '2024-02-01 00:00:00' AS processing_ts FROM customer
"""
ORACLE["compact_table"] = "SELECT * FROM orders UNION ALL SELECT * FROM orders"
ORACLE["incremental_ingest"] = """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders
"""

_QUOTED = "replace(url_encode(brand), '%2F', '/')"
ORACLE["brand_bridge"] = f"""
    SELECT own_brand, role, brand, 'https://shop.example/b/' || {_QUOTED} AS url FROM (
        SELECT p_brand || '+' AS own_brand, 'own' AS role, p_brand || '+' AS brand FROM part
        UNION ALL SELECT p_brand || '+', 'competitor', p_type || ' & ' || p_name FROM part
        UNION ALL SELECT p_brand || '+', 'competitor', p_name || '/~*' FROM part)
"""
ORACLE["page_items"] = """
    SELECT page_id, CAST(unnest(range(len(hrefs))) AS INTEGER) AS pos, unnest(hrefs) AS value
    FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages)
"""

_PRICE = "CAST(CAST(p_retailprice AS DECIMAL(15,2)) AS VARCHAR)"
_PRODUCTS = f"""
    SELECT p_partkey, p_brand AS brand_name,
           'https://shop.example/b/' || url_encode(p_brand) AS url,
           CASE p_partkey % 13
                WHEN 0 THEN p_name || ' ' || p_size || 'ml' WHEN 1 THEN p_name || ' ' || p_size || 'g'
                WHEN 2 THEN p_name || ' ' || p_size || ' L' WHEN 3 THEN p_name || ' ' || p_size || 'cl'
                WHEN 4 THEN p_name || ' ' || p_size || 'kg' WHEN 5 THEN p_name || ' ' || p_size || ' Pack'
                WHEN 6 THEN p_name || ' ' || p_size || '''s' WHEN 7 THEN p_name || ' ' || p_size
                WHEN 8 THEN p_name || ' ' || p_size || '.5 litre'
                WHEN 9 THEN p_name || ' ' || p_size || ' Sachets'
                WHEN 10 THEN '3x' || p_size || 'ML ' || p_name
                WHEN 11 THEN p_name || ' .' || p_size || 'g' ELSE p_name || ' 0ml' END
             || ' & ' || p_type AS product_name,
           CASE p_partkey % 5 WHEN 3 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS price
    FROM part
"""
_PATTERN = "([0-9]*[.]?[0-9]+)\\s?(ml|cl|g|kg|l|s|pk|litre|pack|pads|''s)"


def _unit_prices(products: str) -> str:
    """Exact arithmetic: cents and millionths as integers, one rounded division."""
    return f"""
    SELECT product_name, brand_name, url, price, 1 AS product_quantity,
           CAST(CAST(micro AS DECIMAL(24,0)) * 0.000001 AS DECIMAL(18,6)) AS size, unit,
           CASE WHEN micro > 0 THEN
             CAST(CAST((2 * cents * factor * 10000000000000000 + micro) // (2 * micro) AS DECIMAL(25,0))
                  * 0.000000000001 AS DECIMAL(38,12)) END AS per,
           CASE unit WHEN 'g' THEN '100g' WHEN 'ml' THEN '100ml' WHEN 'ea' THEN 'ea' END AS per_unit
    FROM (
      SELECT *, CAST(price * 100 AS HUGEINT) AS cents,
             CASE WHEN unit IN ('g', 'ml') THEN 100 ELSE 1 END AS factor
      FROM (
        SELECT *, CASE WHEN number = '' THEN CAST(1000000 AS HUGEINT)
                       ELSE CAST(CAST(number AS DECIMAL(18,6)) * 1000000 AS HUGEINT)
                            * CASE raw WHEN 'l' THEN 1000 WHEN 'litre' THEN 1000 WHEN 'cl' THEN 10 ELSE 1 END
                  END AS micro,
               CASE WHEN number = '' OR raw IN ('s', '''s', 'pk', 'pack', 'pads') THEN 'ea'
                    WHEN raw IN ('l', 'litre', 'cl') THEN 'ml' ELSE raw END AS unit
        FROM (SELECT *, regexp_extract(product_name, '{_PATTERN}', 1, 'i') AS number,
                     lower(regexp_extract(product_name, '{_PATTERN}', 2, 'i')) AS raw
              FROM ({products}))))
    """


def _comparable(products: str) -> str:
    def number(name: str) -> str:
        return f"CAST(CAST({name} AS VARCHAR) AS DOUBLE)"

    return f"""
    SELECT product_name, brand_name, url, {number('price')} AS product_price_now, product_quantity,
           {number('size')} AS product_size, unit AS product_size_unit,
           {number('per')} AS product_price_per, per_unit AS product_price_per_unit
    FROM ({_unit_prices(products)})
    """


ORACLE["clean_name_price"] = f"""
    SELECT p_partkey, product_name, CAST(price AS DOUBLE) AS product_price_now FROM ({_PRODUCTS})
"""
ORACLE["unit_price"] = _comparable(_PRODUCTS)


def _exported(products: str) -> str:
    return f"""
    SELECT product_name, brand_name, url, CAST(price AS VARCHAR) AS product_price_now,
           CAST(product_quantity AS VARCHAR) AS product_quantity,
           CAST(size AS VARCHAR) AS product_size, unit AS product_size_unit,
           CAST(per AS VARCHAR) AS product_price_per, per_unit AS product_price_per_unit
    FROM ({_unit_prices(products)})
    """


ORACLE["product_csv_export"] = _exported(_PRODUCTS)
_AMOUNT = f"split_part({_PRICE}, '.', 1)"
ORACLE["shop_cards"] = f"""
    SELECT p_partkey AS page_id, p_name || ' ' || p_size || pack AS name,
           '/p/' || p_partkey || '-' || p_size || pack AS link, '?page=' || (p_partkey + 1) AS next_link,
           '£' || {_AMOUNT} || CASE pack WHEN 'pk' THEN '0' ELSE '' END AS pounds,
           '.' || split_part({_PRICE}, '.', 2) AS rest
    FROM (SELECT *, unnest(['ml', 'pk']) AS pack FROM part)
"""
_NUMBERED = """
    SELECT p_brand, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS n
    FROM (SELECT DISTINCT p_brand FROM part)
"""
_CARDS = f"""
    SELECT p_name || ' ' || p_size || pack AS product_name, brand AS brand_name,
           'https://shop.example/p/' || p_partkey || '-' || p_size || pack AS url,
           CAST(CASE pack WHEN 'ml' THEN {_PRICE} ELSE replace({_PRICE}, '.', '0.') END
                AS DECIMAL(18,2)) AS price
    FROM (SELECT *, unnest(['ml', 'pk']) AS pack FROM part)
    JOIN (SELECT p_brand AS brand FROM ({_NUMBERED})
          UNION ALL SELECT 'Brand#' || (26 - n) FROM ({_NUMBERED})
          UNION ALL SELECT 'Brand#' || (2 * n) FROM ({_NUMBERED}) WHERE 2 * n <= 25)
      ON brand = p_brand
"""
ORACLE["key_registry"] = """
    SELECT row_number() OVER (ORDER BY later, c_mktsegment, c_name) AS id, c_mktsegment, c_name
    FROM (SELECT c_mktsegment, c_name, min(CASE WHEN c_acctbal < 3000 THEN 0 ELSE 1 END) AS later
          FROM customer GROUP BY ALL)
"""
ORACLE["price_capture"] = _comparable(_CARDS)
ORACLE["price_job"] = _exported(_CARDS)

ORACLE["price_job_bronze"] = _exported(
    f"""SELECT CASE WHEN product_name LIKE '%ml' THEN product_name || E'\\n "new", big' ELSE product_name END AS product_name,
               brand_name, url, price FROM ({_CARDS})"""
)
ORACLE["price_walk"] = _comparable(f"""
    SELECT p_name || ' ' || p_size || 'ml' AS product_name, brand AS brand_name,
           'https://shop.example/p/' || p_partkey AS url, CAST({_PRICE} AS DECIMAL(18,2)) AS price
    FROM part
    JOIN (SELECT p_brand AS brand FROM ({_NUMBERED})
          UNION ALL SELECT 'Brand#' || (26 - n) FROM ({_NUMBERED})
          UNION ALL SELECT 'Brand#' || (2 * n) FROM ({_NUMBERED}) WHERE 2 * n <= 25)
      ON brand = p_brand
""")

ORACLE["silver_cached"] = """
    SELECT c_custkey AS customer_id, c_name AS customer_c_name,
           CAST(round(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(15,2))) AS BIGINT) AS customer_c_acctbal
    FROM customer
"""
ORACLE["preview_rows"] = f"""
    SELECT person_c_custkey, person_c_acctbal, country_r_name FROM ({ORACLE["gold_star_join"]})
    ORDER BY person_c_acctbal DESC, person_c_custkey LIMIT 20
"""

ORACLE["medallion_end_to_end"] = """
    SELECT CAST(c_custkey AS INTEGER) AS person_id, c_mktsegment AS person_first_name,
           c_name AS person_last_name, c_name || '@example.com' AS person_email,
           CAST(NULL AS VARCHAR) AS person_gender, n_nationkey AS airport_id,
           CASE WHEN n_regionkey > 0
                THEN CAST(round(CAST(n_nationkey || '.6' AS DECIMAL(10,1))) AS BIGINT) ELSE 0 END
             AS airport_latitude,
           CAST(round(CAST('-' || n_nationkey || '.4' AS DECIMAL(10,1))) AS BIGINT) AS airport_longitude,
           n_name AS airport_name,
           country_id, r_name AS country_country
    FROM customer
    JOIN nation ON c_nationkey = n_nationkey
    JOIN (SELECT *, CAST(row_number() OVER (ORDER BY r_name, r_regionkey) AS INTEGER) AS country_id
          FROM region) ON n_regionkey = r_regionkey
    WHERE c_acctbal >= 0
"""
