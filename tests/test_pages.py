import csv
import re
from decimal import Decimal

from pyspark.sql import functions as F

from tiersmith.plans.prices import capture_prices, export_products
from tiersmith.sources.brands import brand_bridge
from tiersmith.sources.landing import read_csv
from tiersmith.sources.pages import Selector, absolute_url, attribute, inner_html, link_items, product_cards, reached_pages

SHELF = """
<html><body>
<ul><li class="item__gutter"><a class="item__productName" href="/ad">Not on the shelf 1g</a></li></ul>
<div id='x' class="grid plp wide">
 <ul>
  <li data-n="1" class="item__gutter first">
    <a class='item__productName' href="/p/1">Soap &amp; Gel 120ml</a>
    <span class="item__price"><span class="item__price--theme-large">£1</span>.99</span>
  </li>
  <LI CLASS="item__gutter">
    <a href="https://other.example/p/2" class="x item__productName y">Wipes
 20 pads</a>
    <span class="item__price">Now <span class="item__price--theme-large">£2</span>.50 </span>
  </LI>
  <li class="item__gutter--empty"><a class="item__productName" href="/p/3">Not a card</a></li>
  <li class="item__gutter"><a class="item__productName">No price, no link</a></li>
 </ul>
 <a class="icon icon-angle-right" href="?page=2">next</a>
</div></body></html>
"""


def pages(spark, url="https://shop.example/b/Calm%2B"):
    return spark.createDataFrame([(1, url, SHELF)], "page_id int, url string, html string")


def test_product_cards(spark):
    cards = product_cards(pages(spark), "page_id").collect()
    assert [(c.name, c.link, c.pounds, c.rest) for c in cards] == [
        ("Soap &amp; Gel 120ml", "/p/1", "£1", ".99"),
        ("Wipes\n 20 pads", "https://other.example/p/2", "£2", "Now .50 "),
        ("No price, no link", None, None, None),
    ]
    assert {c.next_link for c in cards} == {"?page=2"}


def test_a_shelf_ends_with_its_element(spark):
    card = '<li class="item__gutter"><a class="item__productName" href="/{0}">{0}</a></li>'
    inside = '<div class="row"><DIV>' + card.format("a") + "</DIV ></div>" + card.format("b")
    behind = card.format("c") + '<a class="icon-angle-right" href="/no">x</a>'
    htmls = [
        f'<div class="plp">{inside}</div>{behind}',
        f'<div class="plp">{inside}</div><div class="plp">{behind}</div>',
        f'<div class="plp">{inside}{behind}',
        f'<p><div class="plp"></div>{behind}</p>',
    ]
    df = spark.createDataFrame(list(enumerate(htmls)), "page_id int, html string")
    found = {}
    for row in product_cards(df, "page_id").collect():
        found.setdefault(row.page_id, []).append((row.name, row.next_link))
    assert found == {
        0: [("a", None), ("b", None)],
        1: [("a", None), ("b", None)],
        2: [("a", "/no"), ("b", "/no"), ("c", "/no")],
    }


def test_page_without_shelf(spark):
    df = spark.createDataFrame([(1, "u", "<p>empty</p>"), (2, "u", None)], "page_id int, url string, html string")
    assert product_cards(df, "page_id").count() == 0


def test_selectors(spark):
    df = spark.createDataFrame(
        [("<abbr>no</abbr><a class='k l' title=\"t\">yes</a><a class=\"k\">again</a>",)], "h string"
    )
    h = F.col("h")
    row = df.select(
        inner_html(h, Selector("a")), inner_html(h, Selector("a", "l")), inner_html(h, Selector("a", "z")),
        attribute(h, Selector("a", "k"), "title"), attribute(h, Selector("a", "k"), "href"),
    ).first()
    assert tuple(row) == ("yes", "yes", None, "t", None)


def test_link_items_in_page_order(spark):
    df = spark.createDataFrame([(5, '<a href="/1">x</a><a name="n">y</a><a HREF=\'/2\'>z</a>')], "page_id int, html string")
    assert [tuple(r) for r in link_items(df).collect()] == [(5, 0, "/1"), (5, 1, "/2")]


def test_absolute_url(spark):
    links = ["https://o.example/x", "//o.example/x", "/x", "?page=2", "x", None]
    df = spark.createDataFrame([(link,) for link in links], "link string")
    page = F.lit("https://s.example/b/Calm?page=1")
    got = [r[0] for r in df.select(absolute_url(page, F.col("link"))).collect()]
    assert got == [
        "https://o.example/x", "https://o.example/x", "https://s.example/x",
        "https://s.example/b/Calm?page=2", "https://s.example/b/x", None,
    ]


def test_long_pages_are_read_whole(spark):
    """Hundreds of thousands of tags and long texts without a stack overflow."""
    cards = "".join(
        f'<li class="item__gutter"><b>{"x" * 50}</b><a class="item__productName" href="/{i}">n{i} 5g</a>'
        f'<span class="item__price"><span class="item__price--theme-large">£1</span>.0{i % 10}</span></li>'
        for i in range(20_000)
    )
    html = "<p>" + "<i>a</i>" * 200_000 + '<div class="plp">' + "y" * 1_000_000 + cards + "</div>"
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    found = product_cards(df, "page_id")
    assert found.selectExpr("count(*)", "count(DISTINCT link)", "min(pounds)", "max(rest)").first() == (
        20_000, 20_000, "£1", ".09",
    )


BRANDS = '{"Calm+": ["Z9", "Big Comb"], "Balm": ["Z9"], "Alone": []}'


def test_brand_bridge(spark):
    df = spark.createDataFrame([(BRANDS,)], "brands string")
    rows = sorted(tuple(r) for r in brand_bridge(df, "brands", "https://s").collect())
    assert rows == sorted([
        ("Alone", "own", "Alone", "https://s/b/Alone"),
        ("Calm+", "competitor", "Z9", "https://s/b/Z9"),
        ("Calm+", "competitor", "Big Comb", "https://s/b/Big%20Comb"),
        ("Calm+", "own", "Calm+", "https://s/b/Calm%2B"),
        ("Balm", "competitor", "Z9", "https://s/b/Z9"),
        ("Balm", "own", "Balm", "https://s/b/Balm"),
    ])


def test_capture_and_export(spark, tmp_path):
    maps = spark.createDataFrame([(BRANDS,)], "brands string")
    shop = (
        pages(spark)
        .union(pages(spark, "https://shop.example/b/Z9?page=2"))
        .union(pages(spark, "https://shop.example/b/Unknown"))
    )
    found = capture_prices(shop, maps, "brands", "https://shop.example")
    rows = found.where("product_price_per_unit = '100ml'").orderBy("brand_name").collect()
    assert [r.brand_name for r in rows] == ["Calm+", "Z9", "Z9"]
    assert {(r.product_name, r.product_price_now) for r in rows} == {("Soap & Gel 120ml", Decimal("1.99"))}
    assert {r.url for r in rows} == {"https://shop.example/p/1"}
    export_products(found, f"{tmp_path}/out")
    assert read_csv(spark, f"{tmp_path}/out").columns == found.columns


def test_export_is_plain_csv(spark, tmp_path):
    names = ['6" pan, "large"', " padded ", "two\nlines", "", None, "back\\slash"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, product_name string").coalesce(1)
    export_products(df, f"{tmp_path}/out")
    (file,) = tmp_path.glob("out/*.csv")
    with open(file, newline="", encoding="utf-8") as text:
        rows = list(csv.reader(text))
    assert rows == [["id", "product_name"], *[[str(i), n or ""] for i, n in enumerate(names)]]
    again = read_csv(spark, f"{tmp_path}/out", escape='"', multiline=True)
    assert [r.product_name or "" for r in again.collect()] == [n or "" for n in names]


CARD = '<li class="item__gutter"><a class="item__productName" href="/{0}">{0}</a></li>'


def test_comments_scripts_and_quoted_brackets_are_no_tags(spark):
    inside, behind = CARD.format("a"), CARD.format("z")
    htmls = [
        f'<div class="plp"><!-- <div> -->{inside}</div>{behind}',
        f'<div class="plp"><!-- </div> -->{inside}</div>{behind}',
        f'<div class="plp"><script>x = "<div>" > 1</script><STYLE a="b">div > p {{}}</STYLE >{inside}</div>{behind}',
        f'<div title="a > b > c" class="plp">{inside}</div>{behind}',
        f'<!-- <div class="plp">{behind}</div> --><div data-x=\'>\' class=\'grid plp\'>{inside}</div>{behind}',
        f'<div class="plp">{inside}<!-- {behind}</div>',
        f'<div class="plp">{inside}<!-- {behind} --></div>',
        f'<div title=\'class="plp"\'>{behind}</div><div class="plp">{inside}</div>',
        f'<div class="plp"><scripted>{inside}</scripted></div>{behind}',
    ]
    df = spark.createDataFrame(list(enumerate(htmls)), "page_id int, html string")
    found = {}
    for row in product_cards(df, "page_id").collect():
        found.setdefault(row.page_id, []).append(row.name)
    assert found == {n: ["a"] for n in range(len(htmls))}


def shelf(name, next_link=None):
    arrow = f'<a class="icon-angle-right" href="{next_link}">next</a>' if next_link else ""
    return f'<div class="plp"><ul>{CARD.format(name)}</ul>{arrow}</div><a class="icon-angle-right" href="/b/Trap">x</a>'


def site(spark):
    """Walks that end, are long, circle, meet, break off and leave the shop; and pages that nothing leads to."""
    s, rows = "https://shop.example", []
    rows += [(f"{s}/b/Calm%2B", shelf("c0", "/list?brand=1&amp;page=1"))]
    rows += [(f"{s}/list?brand=1&page={n}", shelf(f"c{n}", f"?brand=1&amp;page={n + 1}" if n < 37 else None)) for n in range(1, 38)]
    rows += [(f"{s}/b/Calm%2B?page=9", shelf("never linked"))]
    rows += [(f"{s}/b/Z9", shelf("z0", "/z/1#top")), (f"{s}/z/1", shelf("z1", "/z/2")), (f"{s}/z/2", shelf("z2", "/z/1"))]
    rows += [(f"{s}/b/Big%20Comb", shelf("g0", "https://other.example/g")), ("https://other.example/g", shelf("g1", "/gone"))]
    rows += [(f"{s}/b/Balm", shelf("b0", "/z/2")), (f"{s}/b/Trap", shelf("trap")), (f"{s}/b/Alone", "<p>no shelf</p>")]
    return spark.createDataFrame(rows, "url string, html string")


def test_walks_along_links(spark):
    starts = [f"https://shop.example/b/{b}" for b in ("Calm%2B", "Z9", "Big%20Comb", "Balm", "Alone", "Missing")]
    found = reached_pages(site(spark), spark.createDataFrame([(x,) for x in [*starts, starts[1]]], "url string"))
    walks = {}
    for row in found.collect():
        walks.setdefault(row.start.rsplit("/", 1)[1], []).append(row.url.removeprefix("https://shop.example"))
    assert sorted(walks.pop("Calm%2B")) == sorted(["/b/Calm%2B", *(f"/list?brand=1&page={n}" for n in range(1, 38))])
    assert {k: sorted(v) for k, v in walks.items()} == {
        "Z9": ["/b/Z9", "/z/1", "/z/2"],
        "Big%20Comb": ["/b/Big%20Comb", "https://other.example/g"],
        "Balm": ["/b/Balm", "/z/1", "/z/2"],
        "Alone": ["/b/Alone"],
    }


def test_a_long_walk_takes_few_rounds(spark, monkeypatch):
    from tiersmith.sources import pages as module

    rows = [(f"https://s/{n}", shelf(str(n), f"/{n + 1}")) for n in range(200)]
    staged, real = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, label: (staged.append(label), real(df, label))[1])
    starts = spark.createDataFrame([("https://s/0",)], "url string")
    assert reached_pages(spark.createDataFrame(rows, "url string, html string"), starts).count() == 200
    assert staged.count("reached") <= 10


def test_prices_of_walked_pages(spark):
    maps = spark.createDataFrame([(BRANDS,)], "brands string")
    found = capture_prices(site(spark), maps, "brands", "https://shop.example", follow_links=True)
    names = {}
    for row in found.select("brand_name", "product_name").collect():
        names.setdefault(row.brand_name, []).append(row.product_name)
    assert sorted(names["Calm+"]) == sorted(f"c{n}" for n in range(38))
    # Z9 competes with two own brands, so its products are there twice.
    assert sorted(names["Z9"]) == sorted(["z0", "z1", "z2"] * 2)
    assert sorted(names["Balm"]) == ["b0", "z1", "z2"] and sorted(names["Big Comb"]) == ["g0", "g1"]
    assert set(names) == {"Calm+", "Z9", "Balm", "Big Comb"}


def test_no_pages_and_no_starts(spark):
    none = spark.createDataFrame([], "url string, html string")
    assert reached_pages(none, site(spark).select("url")).count() == 0
    assert reached_pages(site(spark), none.select("url")).count() == 0


def test_the_shelf_is_searched_once_for_a_page(spark):
    """Not once for each use of its pieces, and the next link not once for each card."""
    plan = product_cards(pages(spark), "page_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("plp") == 2  # in either quotes
    below = plan[plan.index("Generate"):]
    assert plan.count("icon\\-angle\\-right") == below.count("icon\\-angle\\-right") == 2


def test_pages_are_made_in_as_many_tasks_as_a_shuffle(spark, tmp_path):
    from tiersmith.plans.workload import shop_pages

    part = spark.range(50).selectExpr(
        "id AS p_partkey", "'Brand#11' AS p_brand", "'n' AS p_name", "1 AS p_size", "1.5D AS p_retailprice"
    )
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    tasks = shop_pages(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 8 and max(row["count"] for row in tasks) < 12


def test_the_code_made_for_a_capture_is_short_enough_to_be_compiled(spark, capsys):
    """The JVM leaves methods of more than 8000 bytes to its interpreter."""
    maps = spark.createDataFrame([(BRANDS,)], "brands string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        capture_prices(pages(spark), maps, "brands", "https://shop.example").explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


def test_pages_are_not_searched_for_missing_addresses_where_they_are_scanned(spark):
    maps = spark.createDataFrame([(BRANDS,)], "brands string")
    dealt = pages(spark).unionByName(pages(spark, None)).repartition(4)
    found = capture_prices(dealt, maps, "brands", "https://shop.example")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(regexp_extract" not in plan
    assert found.where("brand_name = 'Calm+'").count() == 3


def test_links_as_odd_pages_mean_them(spark):
    rows = [("shop", "x", "/x"), ("https://s.example", "x", "https://s.example/x"), (None, "x", None), (None, "a:b", "a:b"),
            ("https://s.example/a/b?c/d", "", "https://s.example/a/"), ("a:b/c/d", "x", "/x")]
    df = spark.createDataFrame([row[:2] for row in rows], "page string, link string")
    assert [r[0] for r in df.select(absolute_url(F.col("page"), F.col("link"))).collect()] == [row[2] for row in rows]


def test_walks_search_each_page_once_and_move_numbers(spark, monkeypatch):
    from tiersmith.plans import prices
    from tiersmith.sources import pages as module

    staged, real = {}, module.stage

    def note(df, label):
        staged.setdefault(label, []).append((df.dtypes, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, label)

    monkeypatch.setattr(module, "stage", note)
    monkeypatch.setattr(prices, "stage", note)
    maps = spark.createDataFrame([(BRANDS,)], "brands string")
    found = capture_prices(site(spark), maps, "brands", "https://shop.example", follow_links=True)
    plans = [plan for seen in staged.values() for _, plan in seen] + [found._jdf.queryExecution().optimizedPlan().toString()]
    assert sum("item__gutter" in plan or "icon" in plan for plan in plans) == 1
    for label in ("links", "reached"):
        assert {kind for types, _ in staged[label] for _, kind in types} == {"bigint"}
