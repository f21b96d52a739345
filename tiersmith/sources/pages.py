"""Product cards and links taken from HTML pages with Spark expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.session import stage


# The rest of a tag, and what of it may stand before an attribute: quoted values count as a whole.
_REST = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
# Lazy, as the attribute looked for mostly is the first: the matcher need not come back from the tag's end.
_BEFORE = r"(?:[^>\"']*(?:\"[^\"]*\"|'[^']*'))*?[^>\"']*?"


@dataclass(frozen=True)
class Selector:
    """An element by tag and, unless empty, by one of its classes."""

    tag: str
    css_class: str = ""

    @property
    def head(self) -> str:
        """A pattern for what tells the opening tag, behind its bracket."""
        tag = rf"{re.escape(self.tag)}(?=[\s>])"
        if not self.css_class:
            return tag
        name = re.escape(self.css_class)
        double = rf"\"(?:[^\"]*?\s)??{name}(?:\s[^\"]*+)?+\""
        single = rf"'(?:[^']*?\s)??{name}(?:\s[^']*+)?+'"
        return rf"{tag}(?={_BEFORE}\sclass\s*=\s*(?:{double}|{single}))"

    @property
    def opening(self) -> str:
        """A pattern for the opening tag, which ends at the first bracket outside quotes."""
        return rf"<{self.head}{_REST}>"

    @property
    def inner(self) -> str:
        """A pattern for the element; its group 1 is the text up to the closing tag."""
        return rf"{self.opening}(.*?)</{re.escape(self.tag)}\s*>"

    @property
    def block(self) -> str:
        """A pattern for the opening tag and all text up to the next such tag.

        Possessive, so the matcher runs through text in a loop and looks closer
        only at tags; a block of any length needs no recursion.
        """
        return rf"{self.opening}[^<]*+(?:<(?!{self.head})[^<]*+)*+"


# Where a shop page keeps its products.
SHELF = Selector("div", "plp")
CARD = Selector("li", "item__gutter")
CARD_NAME = Selector("a", "item__productName")
CARD_PRICE = Selector("span", "item__price")
CARD_POUNDS = Selector("span", "item__price--theme-large")
NEXT_LINK = Selector("a", "icon-angle-right")

_FLAGS = "(?is)"


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles, whose tags are no elements.

    One that is not closed takes the rest of the page with it, as in a browser.
    """
    hidden = r"<!--.*?(?:-->|\z)|<(script|style)(?=[\s>]).*?(?:</\1\s*>|\z)"
    # Looked for first, as most pages have none and need no second text.
    has_any = html.contains("<!--") | F.regexp_like(html, F.lit(r"(?i)<s(?:cript|tyle)[\s>]"))
    return F.when(has_any, F.regexp_replace(html, _FLAGS + hidden, "")).otherwise(html)


def inner_html(html: Column, selector: Selector) -> Column:
    """The inner text of the first such element, NULL without one."""
    # Taking the rest of the page into the match ends the search.
    return F.get(F.regexp_extract_all(html, F.lit(f"{_FLAGS}{selector.inner}.*"), F.lit(1)), 0)


def _attribute_of(tag: Column, name: str) -> Column:
    value = rf"{_FLAGS}\s{re.escape(name)}\s*=\s*([\"'])(.*?)\1"
    return F.get(F.regexp_extract_all(tag, F.lit(value), F.lit(2)), 0)


def attribute(html: Column, selector: Selector, name: str) -> Column:
    """An attribute of the first such element, NULL without one."""
    return _attribute_of(F.regexp_extract(html, _FLAGS + selector.opening, 0), name)


def link(html: Column, selector: Selector) -> Column:
    """The address that the first such element links to, as its text is meant."""
    return F.replace(attribute(html, selector, "href"), F.lit("&amp;"), F.lit("&"))


def attributes(html: Column, selector: Selector, name: str) -> Column:
    """An attribute of every such element, as an array in page order."""
    tags = F.regexp_extract_all(html, F.lit(_FLAGS + selector.opening), F.lit(0))
    return F.filter(
        F.transform(tags, lambda tag: _attribute_of(tag, name)), lambda value: value.isNotNull()
    )


def link_items(pages: DataFrame, selector: Selector = Selector("a"), name: str = "href") -> DataFrame:
    """One row per element with the attribute: ``(page_id, pos, value)``."""
    return pages.select(
        "page_id", F.posexplode(attributes(F.col("html"), selector, name)).alias("pos", "value")
    )


def blocks(html: Column, selector: Selector) -> Column:
    """The text from each such opening tag up to the next one, as an array."""
    return F.regexp_extract_all(html, F.lit(_FLAGS + selector.block), F.lit(0))


def rest_from(html: Column, selector: Selector) -> Column:
    """The page from the first such element on, empty without one."""
    return F.regexp_extract(html, f"{_FLAGS}{selector.opening}.*", 0)


def first_element(html: Column, selector: Selector) -> Column:
    """The first such element with all it holds, NULL or empty without one.

    It ends where as many of its tags are closed as were opened; a page that
    never closes it gives its rest. Only the tags of that name are counted,
    between the closing ones by which the text is cut; tags written inside
    an attribute's value count as tags.
    """
    tag = re.escape(selector.tag)
    # Piece k is followed by closing tag k + 1.
    start = F.struct(F.lit(0).alias("opened"), F.lit(0).alias("closed"), F.lit(0).alias("end"))

    def count(state: Column, more: Column) -> Column:
        opened, closed = state["opened"] + more, state["closed"] + 1
        end = F.when((state["end"] == 0) & (opened <= closed), closed).otherwise(state["end"])
        return F.struct(opened.alias("opened"), closed.alias("closed"), end.alias("end"))

    def element(pieces: Column) -> Column:
        opened = F.transform(pieces, lambda piece: F.regexp_count(piece, F.lit(rf"{_FLAGS}<{tag}(?=[\s/>])")))
        return F.aggregate(
            opened, start, count,
            lambda state: F.when(state["end"] > 0, F.slice(pieces, 1, state["end"])).otherwise(pieces),
        )

    # The function's argument is a value, so the text is searched and cut once and not once per use.
    pieces = F.split(rest_from(html, selector), f"{_FLAGS}</{tag}\\s*>")
    return F.array_join(F.get(F.transform(F.array(pieces), element), 0), f"</{selector.tag}>")


def absolute_url(page_url: Column, link: Column) -> Column:
    """A link as the page at ``page_url`` means it.

    Written for short generated code: each piece of an address is looked for in as few places as may be.
    """
    origin = F.regexp_extract(page_url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    scheme = F.regexp_extract(page_url, r"^[A-Za-z][A-Za-z0-9+.-]*:", 0)
    path = F.regexp_extract(page_url, r"^[^?#]*", 0)
    folder = F.get(F.regexp_extract_all(path, F.lit(r"^(.*://.*/)[^/]*$"), F.lit(1)), 0)
    before = (
        F.when(link.startswith("//"), scheme)
        .when(link.startswith("/"), origin)
        .when(link.startswith("?"), path)
        .otherwise(F.coalesce(folder, F.concat(origin, F.lit("/"))))
    )
    return F.when(F.regexp_like(link, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), link).otherwise(F.concat(before, link))


def product_cards(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per product card of a page's first shelf, which ends with its element.

    What is commented out, and scripts, are no part of the page. Gives the columns ``keep``, the card's ``name`` and ``link``, the page's
    ``next_link``, and the price text in two parts: the element that holds the
    pounds, and what the price element holds besides.
    """
    return _card_fields(_shelves(pages, *keep).select(*keep, "next_link", F.explode(blocks(F.col("shelf"), CARD)).alias("card")), *keep)


def linked_cards(pages: DataFrame, *keep: str) -> DataFrame:
    """The ``product_cards``, and a row without a ``card`` for each page that has none: its link counts too."""
    cards = _shelves(pages, *keep).select(*keep, "next_link", F.explode_outer(blocks(F.col("shelf"), CARD)).alias("card"))
    return _card_fields(cards, *keep, F.col("card").isNotNull().alias("is_card"))


def _shelves(pages: DataFrame, *keep: str) -> DataFrame:
    # Each step is a column of its own, so no text is searched twice for it.
    return (
        pages.select(*keep, visible(F.col("html")).alias("html"))
        .select(*keep, first_element(F.col("html"), SHELF).alias("shelf"))
        # Of the page and not of each card, so it is looked for before there are several.
        .select(*keep, attribute(F.col("shelf"), NEXT_LINK, "href").alias("next_link"), "shelf")
    )


def _card_fields(cards: DataFrame, *keep: str | Column) -> DataFrame:
    cards = cards.withColumn("price", rest_from(F.col("card"), CARD_PRICE))
    without_pounds = F.regexp_replace("price", _FLAGS + CARD_POUNDS.inner, "")
    return cards.select(
        *keep,
        inner_html(F.col("card"), CARD_NAME).alias("name"),
        attribute(F.col("card"), CARD_NAME, "href").alias("link"),
        "next_link",
        inner_html(F.col("price"), CARD_POUNDS).alias("pounds"),
        inner_html(without_pounds, CARD_PRICE).alias("rest"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``(url, next_url)`` of the pages whose shelf links to a next page, a row for each address.

    ``pages`` has ``html``, or the ``next_link`` found in it already. Addresses
    have no fragment. Of several pages with one address the least link counts.
    """
    found = pages if "next_link" in pages.columns else _shelves(pages, "url")
    # As the link's text is meant, see ``link``.
    found = found.select("url", F.replace("next_link", F.lit("&amp;"), F.lit("&")).alias("link"))
    linked = found.where(F.col("link").isNotNull()).select(
        _without_fragment(F.col("url")).alias("url"),
        _without_fragment(absolute_url(F.col("url"), F.col("link"))).alias("next_url"),
    )
    return linked.groupBy("url").agg(F.min("next_url").alias("next_url"))


def _without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def reached_pages(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """``(start, url)`` of the pages that are reached from each start along the links to the next page.

    ``starts`` has the column ``url``; ``pages`` is as for ``page_links``. A walk ends where the shelf has no such
    link, where the next page is not there, and where it comes back to a page it
    has seen. A start that is not among the pages reaches nothing.

    Each round doubles how far the walks go: with the pages within n steps known
    and, for every page, the one n steps on, both are joined to give 2n. The
    rounds are as many as the doublings of the longest walk, not as its pages.
    Only numbers that stand for the addresses move, and what a round found is
    staged. A page that is no start and that no page links to takes no part.
    """
    addresses = pages.select(_without_fragment(F.col("url")).alias("url")).where("url IS NOT NULL").distinct()
    # Staged, so an address keeps its number.
    there = stage(addresses.withColumn("id", F.monotonically_increasing_id()), "pages")
    next_there = there.select(F.col("url").alias("next_url"), F.col("id").alias("next_id"))
    ahead = stage(page_links(pages).join(there, "url").join(next_there, "next_url").select("id", "next_id"), "links")
    first = starts.select(_without_fragment(F.col("url")).alias("url")).distinct().join(there, "url")
    reached = stage(first.select(F.col("id").alias("start_id"), "id"), "reached")
    entered = ahead.select(F.col("next_id").alias("id")).union(reached.select("id")).distinct()
    ahead = stage(ahead.join(entered, "id", "left_semi"), "links")
    known = reached.count()
    while True:
        further = reached.join(ahead, "id").select("start_id", F.col("next_id").alias("id"))
        reached = stage(reached.unionByName(further).distinct(), "reached")
        count = reached.count()
        if count == known:
            break
        known = count
        beyond = ahead.select(F.col("id").alias("next_id"), F.col("next_id").alias("beyond"))
        ahead = stage(ahead.join(beyond, "next_id").select("id", F.col("beyond").alias("next_id")), "links")
    start_of = there.select(F.col("url").alias("start"), F.col("id").alias("start_id"))
    return reached.join(there, "id").join(start_of, "start_id").select("start", "url")
