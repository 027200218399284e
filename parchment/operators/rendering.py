"""HTML to text and links, over columns; pages are parsed in Arrow batches where they lie."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parchment.sources.html import field, parse, render, resolve
from parchment.sources.listing import is_link


def html_text(html: Column | str) -> Column:
    """The rendered text, line by line; null stays null."""

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: None if p is None else render(parse(p)))

    return run(html)


LINKS = "seq int, id string, url string, page int, link_text string"


def links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, seq, id, url, page, link_text) of every link in page order."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, base, page in batch.itertuples(index=False):
                for i, node in enumerate(filter(is_link, parse(page or "").iter("a"))):
                    try:
                        rows.append((k, i, *resolve(base or "", node.get("href")), field(node)))
                    except ValueError:  # an address that can't be read is no link
                        continue
            yield pd.DataFrame(rows, columns=[key, "seq", "id", "url", "page", "link_text"])

    return pages.select(key, url, html).mapInPandas(run, f"{key} {kind}, {LINKS}")


def resolved(url: Column | str) -> Column:
    """struct<id, url, page> of an absolute address."""

    @F.pandas_udf("id string, url string, page int")
    def run(urls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None, None) if u is None else resolve(u, u) for u in urls], columns=["id", "url", "page"])

    return run(url)
