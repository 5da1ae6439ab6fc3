"""HTML stages: removal rules, text, cleaned content, hashes, listings."""

from __future__ import annotations

import datetime as dt
import hashlib
import html as stdlib_html
import html.parser
import random
import time
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docstrata import schemas
from docstrata.operators import html as stages
from docstrata.operators import listing
from docstrata.operators.markup import decode, prune, walk
from tests.conftest import SITE, TS, listing_html, page_row

DOCUMENT = """<html><head><title>T</title></head><body><header>h</header><nav>n</nav><div class="cookie-banner">c</div>
<div id="main"><a href="/s">Return to Search</a><a href="/s"><i>x</i> Return to Search</a>
<input type="hidden" value="t1"><p>One&nbsp; two</p><script>var t="</p>";</script></div><footer>f</footer></body></html>"""


def text(source):
    return prune(source, stages.HASHING, keep_html=False)[0]


def clean(source):
    return prune(source, stages.CLEANING, keep_html=True)[1]


def test_fixture_document():
    assert text(DOCUMENT) == "T x Return to Search One two"
    assert clean(DOCUMENT).startswith('<div id="main"><a href="/s"><i>x</i> Return to Search</a>')
    changed = DOCUMENT.replace("t1", "t2")
    assert text(changed) == text(DOCUMENT) and clean(changed) != clean(DOCUMENT)


@pytest.mark.parametrize("markup", [
    *(f"<{t}>gone</{t}>" for t in ("script", "style", "nav", "footer", "header", "noscript", "iframe")),
    *(f'<div class="x {c} y"><b>gone</b></div>' for c in (
        "cookie-banner", "navbar", "footer-one", "footer-two", "footer-nav", "social-banner", "no-print",
        "return-to-search", "ptools-pager")),
    *(f'<div id="{i}">gone<p>too</p></div>' for i in ("binderFixed", "advancedSearchControls", "searchPnl")),
    '<a href="/">« Return to Search</a>', "<a><b>Return to Search</b></a>", "<a>Return to Search<script>x</script></a>",
])
def test_removed_from_both(markup):
    page = f"<html><body><p>kept</p>{markup}<p>end</p></body></html>"
    assert text(page) == "kept end"
    assert clean(page) == "<body><p>kept</p><p>end</p></body>"


@pytest.mark.parametrize("markup, seen", [
    ('<div class="navbars">s</div>', "s"), ('<p class="cookie">s</p>', "s"), ('<p id="main2">s</p>', "s"),
    ("<a>Return<br>to Search</a>", "Return to Search"), ("<a>Return to Search <i>s</i></a>", "Return to Search s"),
    ("<p>Return to Search</p>", "Return to Search"), ("<title>s</title>", "s"), ("<template>s</template>", ""),
    ("<!-- s -->", ""), ("<ruby>r<rt>s</rt></ruby>", "r"),
])
def test_kept_or_without_text(markup, seen):
    assert text(f"<body>a {markup}</body>") == f"a {seen}".strip()


def test_hidden_fields_differ_between_the_sets():
    page = '<body><div class="aspNetHidden">t</div><input type="hidden" value="v"><input type="text"></body>'
    assert text(page) == ""
    assert clean(page) == ('<body><div class="aspNetHidden">t</div><input type="hidden" value="v"/>'
                           '<input type="text"/></body>')


def test_main_content_choice():
    assert clean('<body>x<div id="main">a</div><div id="main">b</div></body>') == '<div id="main">a</div>'
    assert clean('<body><div id="main">a<div id="main">b</div></div></body>') == '<div id="main">a<div id="main">b</div></div>'
    assert clean('<body><nav><div id="main">a</div></nav>rest</body>') == "<body>rest</body>"
    assert clean("<html><head><title>t</title></head><p>x") == "<body><p>x</p></body>"
    assert clean("") == "" and text("") == ""


def test_serialisation():
    source = "<body class=\"a  b\"><P title='say \"hi\"'>x &amp; y &lt; z<BR>é&nbsp;</p><img src=a.png alt=\"1 &gt; 0\"><!-- c --></body>"
    assert clean(source) == ('<body class="a  b"><p title=\'say "hi"\'>x &amp; y &lt; z<br/>é </p>'
                             '<img src="a.png" alt="1 &gt; 0"/><!-- c --></body>')
    assert clean(clean(source)) == clean(source)


@pytest.mark.parametrize("source, expected", [
    ("<p>a<p>b", "<body><p>a</p><p>b</p></body>"),
    ("<ul><li>a<li>b</ul>c", "<body><ul><li>a</li><li>b</li></ul>c</body>"),
    ("<p><b>a<p>b", "<body><p><b>a</b></p><p>b</p></body>"),
    ("<div>a</b>b</p></div>", "<body><div>ab</div></body>"),
    ("<div><b>a</div>b", "<body><div><b>a</b></div>b</body>"),
    ("<b><div>a</b>b</div>c", "<body><b><div>ab</div>c</b></body>"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "<body><table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table></body>"),
    ('<p title="a > b">c', '<body><p title="a &gt; b">c</p></body>'),
    ("a < b && c", "<body>a &lt; b &amp;&amp; c</body>"),
    ("a<p", "<body>a</body>"),
    ("a<!-- open", "<body>a</body>"),
    ("<p title='x>a</p>b", "<body><p title=\"'x\">a</p>b</body>"),
])
def test_repair(source, expected):
    assert clean(source) == expected


def test_events_balance_on_random_markup():
    rng = random.Random(3)
    parts = ["<p>", "</p>", "<b>", "</b>", "<div id=main>", "</div>", "<a href='x'>", "</a>", "<br>", "text ", "&amp;", "<!--c-->",
             "<script>x<y</script>", "<", ">", "<li>", "</ul>", "<nav>", "</nav>", "'", '"', "<td", "</"]
    for _ in range(2000):
        source = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        stack = []
        for kind, value, _attrs in walk(source):
            if kind == "open":
                stack.append(value)
            elif kind == "close":
                assert stack.pop() == value
        assert not stack
        assert prune(source, stages.CLEANING, True)[0] == text(source) or "hidden" in source


def test_deep_nesting_and_length():
    deep = "<div>" * 50_000 + "x" + "</div>" * 50_000
    assert text(deep) == "x"
    assert text("<p>a " * 100_000).startswith("a a")
    assert text("<" * 200_000 + ">") != ""
    assert text("<a '" * 50_000) is not None


class _Reference(html.parser.HTMLParser):
    """Text collector on the standard parser, for flat pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in stages.CLEAN_TAGS

    def handle_endtag(self, tag):
        self.depth -= tag in stages.CLEAN_TAGS

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def test_table_stage_on_pages_equals_standard_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = stages.normalize_html(pages, "html").select("html", "normalized_text").collect()
    for row in rows:
        parser = _Reference()
        parser.feed(row.html)
        parser.close()
        assert row.normalized_text == " ".join(" ".join(parser.out).split())


def test_decode():
    assert decode("é".encode()) == "é"
    assert decode(b'<meta charset="iso-8859-1">\xe9') == '<meta charset="iso-8859-1">é'
    assert decode(b'<?xml version="1.0" encoding="latin-1"?>\xe9').endswith("é")
    assert decode(b"\xef\xbb\xbfa") == "a" and decode("a".encode("utf-16")) == "a"
    assert decode(b"\x93q\x94") == "“q”"
    assert decode(b'<meta charset="nonsense">\xc3\xa9').endswith("é")
    late = b"<html><head><!--" + b"x" * 5000 + b'--><meta charset="iso-8859-1"></head><body>\x80\xe9'
    assert decode(late).endswith("\x80é")
    # A declaration inside the body is text.
    assert decode(b'<head></head><body><meta charset="iso-8859-1">\xc3\xa9').endswith("é")


@pytest.mark.parametrize("name", [b"undefined", b"utf-7", b"unicode_escape", b"rot13", b"a\x00b", b"idna", b"hex", b"x" * 300])
def test_strange_charsets_count_as_undeclared(name):
    assert decode(b'<meta charset="' + name + b'">caf\xc3\xa9 +AGE- \\ud800').endswith("café +AGE- \\ud800")


def test_stray_end_tags_take_linear_time():
    source = "<b>" * 60_000 + "x" + "</i>" * 200_000
    begin = time.perf_counter()
    assert text(source) == "x"
    assert time.perf_counter() - begin < 20


def sha(value):
    return hashlib.sha256(value).hexdigest()


def test_content_hash_and_transformed_content(spark):
    rows = [("html", bytearray(DOCUMENT.encode())), ("pdf", bytearray(b"\x00raw")), ("doc", bytearray(b"doc")),
            ("unknown", bytearray(b"<p>u</p>")), ("html", None), ("html", bytearray(b"")), (None, bytearray(b"<b>n</b>"))]
    frame = spark.createDataFrame(rows, "t string, c binary")
    got = [r.h for r in frame.select(stages.content_hash(F.col("c"), F.col("t")).alias("h")).collect()]
    assert got == [sha(b"T x Return to Search One two"), sha(b"\x00raw"), sha(b"doc"), sha(b"u"), None, sha(b""), sha(b"n")]
    out = [r.c and bytes(r.c) for r in frame.select(stages.transformed_content(F.col("c"), F.col("t")).alias("c")).collect()]
    assert out[0] == clean(DOCUMENT).encode() and out[1:4] == [b"\x00raw", b"doc", b"<p>u</p>"]


def test_scripts_and_hidden_fields_do_not_change_the_hash():
    noisy = DOCUMENT.replace("<p>One", '<script>track()</script><input type="hidden" name="k"><style>x</style><p>One')
    assert text(noisy) == text(DOCUMENT)


LISTING = """<div class="searchhead">Shows 1 to 2 of 12 results</div>
<div class="item-list"><ul>
 <li class="each-item"><h2 class="title"><a href="/en/cases/x-1.html"> X-00000001 </a></h2>
  <span class="date">31/03/2023</span><p class="description"> A <b>v</b> B </p>
  <span class="refNO">X-00000001</span></li>
 <li class="each-item"><h2 class="title"><a href="/en/cases/x-2.html"></a></h2></li>
</ul></div>
<ul class="pager"><li><a class="next" href="/en/search/?pageNumber=2">next</a></li></ul>"""


def captured(spark, html, number=1, error=None):
    row = (f"{SITE}/en/search/?pageNumber={number}", "B", dt.date(2024, 1, 15), dt.date(2024, 1, 31), number, TS, html, error)
    return spark.createDataFrame([row], schemas.SEARCH_PAGES)


def test_extract_listing(spark):
    rows = listing.extract_listing(captured(spark, LISTING), SITE, "t").collect()
    assert len(rows) == 1
    row = rows[0].asDict()
    assert row == {
        "identifier": "X-00000001", "description": "A B", "published_date": "31/03/2023", "published_date_iso": "2023-03-31",
        "published_dt": dt.date(2023, 3, 31), "ref_no": "X-00000001", "doc_url": SITE + "/en/cases/x-1.html", "body": "B",
        "partition_date": "2024-01-15", "partition_end": "2024-01-31", "page_number": 1, "pos": 0, "captured_at": TS,
        "scraped_at": "t",
    }
    page = listing.scan_search_pages(captured(spark, LISTING)).first()
    assert (page.page_total, page.next_url) == (12, SITE + "/en/search/?pageNumber=2")
    rejected = listing.without_identifier(listing.listing_rows(listing.scan_search_pages(captured(spark, LISTING)), SITE, "t"))
    assert [r.doc_url for r in rejected.collect()] == [SITE + "/en/cases/x-2.html"]


def test_page_without_items_ends_pagination(spark):
    page = listing.scan_search_pages(captured(spark, listing_html([], 0, "?p=2"))).first()
    assert page.next_url is None and page.page_total == 0
    assert listing.extract_listing(captured(spark, None, error="timeout"), SITE, "t").count() == 0


def test_listing_edge_cases():
    page = listing.scan_page(
        '<li class="each-item"><h2 class="title x"><a>no link</a><a href="/second">2</a></h2><span class="date big">d</span>'
        '<h2><a href="/wrong">w</a></h2><p class="description">one<br>two</p><p class="description"> three </p></li>'
        '<li class="each-items"><h2 class="title"><a href="/no">n</a></h2></li><a class="next" href="/not-in-pager">x</a>'
        '<ul class="pager"><li><a class="next btn" href="?p=2&amp;q=1">n</a></li></ul>'
    )
    assert page["items"] == [{"title": "no link", "href": "/second", "date": "d", "ref_no": None,
                              "description": ["one", "two", " three "]}]
    assert page["next_href"] == "?p=2&q=1" and page["head"] is None


def test_pages_are_parsed_once(spark):
    frame = listing.extract_listing(captured(spark, LISTING), SITE, "t").filter("identifier <> 'x' and page_number = 1")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_next_page_requests(spark):
    pages = spark.createDataFrame(
        [page_row("B", "2024-01-01", "2024-01-31", [{"id": "A", "href": "/a"}], 20, 1, next_href="/en/search/?n=2"),
         page_row("B", "2024-02-01", "2024-02-29", [{"id": "C", "href": "/c"}], 20, 3, next_href="/en/search/?n=4")],
        schemas.SEARCH_PAGES)
    captured_urls = spark.createDataFrame([(SITE + "/en/search/?n=2",)], "url string")
    todo = listing.next_page_requests(listing.scan_search_pages(pages), captured_urls).collect()
    assert [(r.url, r.page_number, r.partition_start.isoformat()) for r in todo] == [(SITE + "/en/search/?n=4", 4, "2024-02-01")]


def test_entities_in_titles(spark):
    row = listing.extract_listing(captured(spark, listing_html([{"id": "A&B <1>", "href": "/x?a=1&b=2"}], 1)), SITE, "t").first()
    assert (row.identifier, row.doc_url) == ("A&B <1>", SITE + "/x?a=1&b=2")
    assert stdlib_html.escape("A&B <1>") == "A&amp;B &lt;1&gt;"


def test_sql_functions(spark):
    from docstrata.sql import register_functions

    register_functions(spark)
    spark.createDataFrame([("html", bytearray(DOCUMENT.encode())), ("pdf", bytearray(b"raw"))], "t string, c binary").createOrReplaceTempView("d")
    rows = spark.sql("SELECT compute_content_hash(c, t), normalize_html_content(c), clean_html(c) FROM d ORDER BY t").collect()
    assert tuple(rows[0]) == (sha(text(DOCUMENT).encode()), text(DOCUMENT), clean(DOCUMENT))
    assert rows[1][0] == sha(b"raw")
    assert spark.sql("SELECT format_search_date(DATE'2024-02-01')").first()[0] == "01/02/2024"
    spans = spark.sql("SELECT * FROM monthly_partitions(DATE'2024-01-15', DATE'2024-03-01')").collect()
    assert [(str(a), str(b)) for a, b in spans] == [
        ("2024-01-15", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-01")]
    assert spark.sql("SELECT * FROM weekly_partitions(DATE'2024-01-03', DATE'2024-01-12')").count() == 2
    assert spark.sql("SELECT * FROM quarterly_partitions(DATE'2024-02-15', DATE'2024-08-01')").count() == 3
    assert spark.sql("SELECT * FROM weekly_partitions(DATE'2024-01-03', DATE'2024-01-02')").count() == 0


@pytest.mark.parametrize("source", [
    "<b><table>" + "<i>" * 150_000 + "</b>" * 150_000, "<b>" * 150_000 + "<hr>" * 150_000, "<li>" * 250_000, "<p><b>" * 170_000,
    "<a><table>" * 100_000 + "t" * 1000, "<div>" * 200_000 + "</p>" * 3, "<meta " * 170_000, "<meta charset" * 80_000 + ">" + "<x>",
])
def test_a_megabyte_of_open_elements_is_linear(source):
    begin = time.process_time()
    prune(decode(source.encode()), stages.CLEANING, keep_html=True)
    assert time.process_time() - begin < 6


def test_a_bad_document_does_not_touch_the_others(spark):
    rows = spark.createDataFrame([("<p>a</p>",), (None,), ("<p>" + "b" * 50 + "</p>",), ("<p>é</p>",)], "h string").coalesce(1)

    def fails(source):
        if "é" in source:
            raise RecursionError("too deep")
        return source.upper()

    got = [tuple(r.c) if r.c else None for r in rows.select(stages.document_udf(fails, max_bytes=20)(F.col("h")).alias("c")).collect()]
    assert got == [("<P>A</P>", None), (None, None), (None, "ValueError: 57 bytes, more than 20"), (None, "RecursionError: too deep")]
    assert [r.v for r in rows.select(stages.value_udf(fails)(F.col("h")).alias("v")).collect()] == ["<P>A</P>", None, "<P>" + "B" * 50 + "</P>", None]


def test_a_batch_is_not_held_as_python_objects():
    batch = pa.array([f"<p>{n} {'x' * 2000}</p>" for n in range(8000)])
    stage = {"value": stages.value_udf(str.upper).func, "checked": stages.document_udf(str.upper).func}
    run = {"value": lambda: stage["value"](batch), "checked": lambda: pa.concat_arrays(stage["checked"](iter([batch])))}
    for kind, made in run.items():
        tracemalloc.start()
        got = made()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        values = got if kind == "value" else got.field("value")
        assert values.to_pylist() == [text.upper() for text in batch.to_pylist()]
        assert peak < 6e6, kind  # the batch has 16 MB
    assert len(stage["value"](batch[:0])) == 0
