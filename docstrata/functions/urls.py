"""Search URLs and link resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docstrata.functions.dates import format_search_date


def query_string(params: dict[str, Column]) -> Column:
    """``k=v`` pairs joined by ``&``, values form-encoded."""
    return F.concat_ws("&", *[F.concat(F.lit(f"{k}="), F.url_encode(v)) for k, v in params.items()])


def search_url(search_base: str, body_id: Column, start: Column, end: Column, page: Column) -> Column:
    """URL of one result page of a (body, date partition) search."""
    params = {
        "decisions": F.lit("1"),
        "body": body_id,
        "from": format_search_date(start),
        "to": format_search_date(end),
        "pageNumber": page.cast("string"),
    }
    return F.concat(F.lit(search_base + "?"), query_string(params))


def document_url(site: str, href: Column) -> Column:
    """Site prefix plus link path; plain concatenation, '' when there is no link."""
    return F.when(F.coalesce(href, F.lit("")) != "", F.concat(F.lit(site), href)).otherwise("")


def _drop_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` of an absolute path."""
    parts = F.split(F.substring(path, F.lit(2), F.length(path)), "/")
    last = F.element_at(parts, -1)
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == ".", acc)
        .when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(p))),
    )
    # A trailing dot segment names a folder.
    tail = F.when(last.isin(".", "..") & (F.size(folded) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(folded, "/"), tail)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on the page ``base``."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    no_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(F.when(path == "", "/").otherwise(path), r"^(.*/)", 1)
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    href_rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(origin, _drop_dot_segments(href_path), href_rest))
        .when(F.startswith(href, F.lit("?")), F.concat(no_query, href))
        .when(F.startswith(href, F.lit("#")), F.concat(no_fragment, href))
        .otherwise(F.concat(origin, _drop_dot_segments(F.concat(folder, href_path)), href_rest))
    )
