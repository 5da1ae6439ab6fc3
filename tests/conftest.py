"""Shared session and small captured-page fixtures."""

from __future__ import annotations

import datetime as dt
from html import escape

import pytest

from docstrata import build_session, schemas

SITE = "https://decisions.example.org"
TS = dt.datetime(2024, 2, 1, 8, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def listing_html(items: list[dict], total: int | None = None, next_href: str | None = None) -> str:
    """A search-result page of the captured shape."""
    rows = []
    for item in items:
        link = f'<a href="{escape(item["href"])}"> {escape(item["id"])} </a>' if item.get("href") else f"<a> {escape(item['id'])} </a>"
        rows.append(
            f'<li class="each-item"><h2 class="title">{link}</h2><span class="date">{item.get("date", "05/01/2024")}</span>'
            f'<p class="description">{item.get("description", "A v B")}</p><span class="refNO">{escape(item["id"])}</span></li>'
        )
    head = f'<div class="searchhead">Shows 1 to 10 of {total} results</div>' if total is not None else ""
    pager = f'<ul class="pager"><li><a class="next" href="{next_href}">next</a></li></ul>' if next_href else ""
    return f'<html><body>{head}<div class="item-list"><ul>{"".join(rows)}</ul></div>{pager}</body></html>'


def page_row(body, start, end, items, total=None, number=1, at=TS, error=None, next_href=None):
    html = None if error else listing_html(items, total, next_href)
    url = f"{SITE}/en/search/?body={body}&from={start}&pageNumber={number}"
    return (url, body, dt.date.fromisoformat(start), dt.date.fromisoformat(end), number, at, html, error)


def doc_row(href, content=b"<html><body><div id='main'>text</div></body></html>", content_type="text/html", error=None, at=TS):
    return (SITE + href, content_type, None if error else bytearray(content), error, at)


@pytest.fixture
def captures(spark):
    """Factory: (page rows, response rows) to the two capture DataFrames."""

    def make(pages, responses):
        return (
            spark.createDataFrame(pages, schemas.SEARCH_PAGES),
            spark.createDataFrame(responses, schemas.DOC_RESPONSES),
        )

    return make
