"""Search-result pages to one metadata row per result."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from docstrata.functions.dates import iso_from_slashes, published_day
from docstrata.functions.text import join_stripped, strip, total_results
from docstrata.functions.urls import document_url, resolve_url
from docstrata.operators.html import check_size, error_text, in_slices
from docstrata.operators.markup import attributes, decode, walk

_ITEM = pa.struct(
    [
        ("title", pa.string()),
        ("href", pa.string()),
        ("date", pa.string()),
        ("ref_no", pa.string()),
        ("description", pa.list_(pa.string())),
    ]
)
_PAGE = pa.struct([("head", pa.string()), ("next_href", pa.string()), ("items", pa.list_(_ITEM))])
_SCANNED = pa.struct([("page", _PAGE), ("error", pa.string())])
def _has(element: tuple[str, frozenset[str]], tag: str, cls: str) -> bool:
    return element[0] == tag and cls in element[1]


def scan_page(source: str) -> dict:
    """Raw texts and links of a result page; cleaning them up is left to the JVM."""
    page: dict = {"head": None, "next_href": None, "items": []}
    stack: list[tuple[str, frozenset[str]]] = []
    open_items: list[tuple[int, dict]] = []  # (depth, item)
    titles: list[int] = []  # places of open titles
    pagers = 0
    for kind, value, raw in walk(source):
        if kind == "open":
            attrs = attributes(raw) if raw else {}
            element = (value, frozenset(attrs.get("class", "").split()))
            if _has(element, "li", "each-item"):
                item = {"title": None, "href": None, "date": None, "ref_no": None, "description": []}
                page["items"].append(item)
                open_items.append((len(stack), item))
            elif value == "a" and "href" in attrs:
                for depth, item in open_items:
                    if item["href"] is None and titles and titles[-1] > depth:
                        item["href"] = attrs["href"]
                if page["next_href"] is None and pagers and "next" in element[1]:
                    page["next_href"] = attrs["href"]
            if _has(element, "h2", "title"):
                titles.append(len(stack))
            pagers += _has(element, "ul", "pager")
            stack.append(element)
        elif kind == "close":
            element = stack.pop()
            if titles and titles[-1] == len(stack):
                titles.pop()
            pagers -= _has(element, "ul", "pager")
            if open_items and open_items[-1][0] == len(stack):
                open_items.pop()
        elif kind == "text" and stack:
            top = stack[-1]
            if page["head"] is None and _has(top, "div", "searchhead"):
                page["head"] = value
            for depth, item in open_items:
                if len(stack) - 1 == depth:
                    continue
                if _has(top, "p", "description"):
                    item["description"].append(value)
                elif item["date"] is None and _has(top, "span", "date"):
                    item["date"] = value
                elif item["ref_no"] is None and _has(top, "span", "refNO"):
                    item["ref_no"] = value
                elif item["title"] is None and top[0] == "a":
                    if titles and titles[-1] > depth:
                        item["title"] = value
    return page


def _scan(html: Column, max_bytes: int | None) -> Column:
    def one(source: str | bytes | None) -> dict:
        if source is None:
            return {"page": None, "error": None}
        try:
            check_size(source, max_bytes)
            return {"page": scan_page(source if isinstance(source, str) else decode(source)), "error": None}
        except Exception as error:  # counted by the jobs, whatever it is
            return {"page": None, "error": error_text(error)}

    @F.arrow_udf(from_arrow_type(_SCANNED))
    def stage(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for docs in batches:
            yield from in_slices(docs, one, lambda found: pa.array(found, type=_SCANNED))

    # Later filters look at the parsed page; as a deterministic expression it would be
    # pushed below the projection and every page parsed twice.
    return stage.asNondeterministic()(html)


def scan_search_pages(search_pages: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Parse each captured result page once; failed captures give a null ``page``.

    Adds ``page struct<head, next_href, items>``, ``page_total`` (first page only counts),
    ``next_url``, and ``parse_error`` of a page that the parser fails on or that is longer than
    ``max_bytes`` (its ``page`` is null); the HTML column is dropped.
    """
    scanned = search_pages.withColumn("page", _scan(F.when(F.col("error").isNull(), F.col("html")), max_bytes)).drop("html")
    parsed = scanned.withColumns({"page": F.col("page.page"), "parse_error": F.col("page.error")})
    has_items = F.size(F.coalesce(F.col("page.items"), F.array())) > 0
    next_href = F.col("page.next_href")
    return parsed.withColumns(
        {
            "page_total": total_results(F.col("page.head")),
            # A page without results ends the pagination, whatever links it carries.
            "next_url": F.when(has_items & (next_href != ""), resolve_url(F.col("url"), next_href)),
        }
    )


def _text(col: Column) -> Column:
    return strip(F.coalesce(col, F.lit("")))


def listing_rows(scanned: DataFrame, site: str, run_ts: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per result of the scanned pages, in page order, empty identifiers included.

    ``keep`` names further columns of the pages that the rows get.
    """
    pages = scanned.select("body", "partition_start", "partition_end", "page_number", "captured_at", "page", *keep)
    items = pages.select(
        "body", "partition_start", "partition_end", "page_number", "captured_at", *keep,
        F.posexplode("page.items").alias("pos", "item"),
    )
    published = _text(F.col("item.date"))
    return items.select(
        _text(F.col("item.title")).alias("identifier"),
        join_stripped(F.col("item.description")).alias("description"),
        published.alias("published_date"),
        iso_from_slashes(published).alias("published_date_iso"),
        published_day(published).alias("published_dt"),
        _text(F.col("item.ref_no")).alias("ref_no"),
        document_url(site, F.col("item.href")).alias("doc_url"),
        "body",
        F.date_format("partition_start", "yyyy-MM-dd").alias("partition_date"),
        F.date_format("partition_end", "yyyy-MM-dd").alias("partition_end"),
        "page_number",
        "pos",
        "captured_at",
        F.lit(run_ts).alias("scraped_at"),
        *keep,
    )


def result_texts(scanned: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Position and text of each result of the scanned pages; the other fields are not read."""
    found = scanned.select(*keep, F.posexplode("page.items.description").alias("pos", "parts"))
    return found.select(*keep, "pos", join_stripped(F.col("parts")).alias("description"))


def extract_listing(search_pages: DataFrame, site: str, run_ts: str) -> DataFrame:
    """Captured result pages to metadata rows; rows without identifier are dropped."""
    return with_identifier(listing_rows(scan_search_pages(search_pages), site, run_ts))


def with_identifier(rows: DataFrame) -> DataFrame:
    """Identifier guard, used after extraction and again before the sink."""
    return rows.filter(F.coalesce(F.col("identifier"), F.lit("")) != "")


def without_identifier(rows: DataFrame) -> DataFrame:
    """The rows ``with_identifier`` drops, for audit."""
    return rows.filter(F.coalesce(F.col("identifier"), F.lit("")) == "")


def next_page_requests(scanned: DataFrame, captured_urls: DataFrame) -> DataFrame:
    """Result pages still to fetch: next links that no captured page answers yet."""
    wanted = (
        scanned.filter(F.col("next_url").isNotNull())
        .select(
            F.col("next_url").alias("url"), "body", "partition_start", "partition_end",
            (F.col("page_number") + 1).alias("page_number"),
        )
        .dropDuplicates(["url", "body", "partition_start"])
    )
    return wanted.join(captured_urls.select("url").distinct(), "url", "left_anti")
