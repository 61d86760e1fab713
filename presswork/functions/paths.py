"""Paths over a page as a table function: many paths on one parse, a row for each node found.

    pages.lateralJoin(html_paths(F.col("html").outer(), F.col("url").outer(), wanted(title="//title", links="css:nav a")))

    SELECT page_id, place, value FROM pages, LATERAL html_paths(html, url, map('title', '//title'))

The function takes columns, so that paths may come from a table as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from presswork.functions import dom
from presswork.functions.arrow import arrow_function

CSS = "css:"
SCHEMA = "name string, place int, value string, markup string"


@cache
def as_path(path: str) -> str:
    """A path, or the path of a selector that is marked by CSS."""
    return dom.css_to_xpath(path.removeprefix(CSS)) if path.startswith(CSS) else path


class HtmlPaths:
    """(name, place, value, markup) of every node that each named path finds, in the page's order; a null page has none.

    value is a node's text, or the attribute; markup is what an element is written
    as, null for texts and attributes. Links are absolute where an address of
    the page is given. A path that isn't understood finds nothing.
    """

    def eval(self, page: str | None, url: str | None, paths: dict[str, str] | None) -> Iterator[tuple]:
        if page is None or not paths:
            return
        root = dom.parse(page, base=url or "")
        for name, path in sorted(paths.items()):
            for place, x in enumerate(dom.xpath(root, as_path(path)) if path else (), 1):
                yield name, place, dom.as_text(x), x.html() if isinstance(x, dom.Element) else None


def html_paths(page: Column, url: Column, paths: Column):
    """The table function for DataFrame.lateralJoin; columns of the other side are given as outer()."""
    return F.udtf(HtmlPaths, returnType=SCHEMA, useArrow=True)(page, url, paths)


def register(spark: SparkSession, name: str = "html_paths") -> None:
    """Makes the function known to SQL."""
    spark.udtf.register(name, F.udtf(HtmlPaths, returnType=SCHEMA, useArrow=True))


def wanted(**paths: str) -> Column:
    """Paths by name, as the map that the function takes."""
    return F.create_map(*(F.lit(x) for kv in sorted(paths.items()) for x in kv))


def rewritten(*changes: Callable[[dom.Element], object]) -> Callable[[Column], Column]:
    """A column function: the page after these changes of its tree, all on one parse."""
    def one(page: str) -> str:
        root = dom.parse(page)
        for change in changes:
            change(root)
        return root.html()

    @arrow_function("string")
    def run(page: pd.Series) -> pd.Series:
        return page.map(one, na_action="ignore")

    return run


def dropping(path: str, with_tail: bool = False) -> Callable[[dom.Element], None]:
    """A change that takes out what a path finds, with the text behind it if asked."""

    def change(root: dom.Element) -> None:
        for e in dom.xpath(root, as_path(path)):
            if isinstance(e, dom.Element):
                e.drop(with_tail)

    return change
