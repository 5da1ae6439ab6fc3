"""Named queries over the standard tables.

Each takes (spark, sf_dir) and returns a DataFrame.  The tables stand in for captures:
``pages`` for document responses, ``documents`` for texts, listing pages and copies,
``labels`` for what an earlier run stored, ``events`` for outcomes, arrivals and log
lines, ``orders`` / ``lineitem`` for dates.  ``oracle`` holds the same queries as SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata import functions as fn
from docstrata.functions.logs import LANDING_KEYWORDS, format_summary
from docstrata.operators import frontier, html, listing, logs, reconcile, stats
from docstrata.plans.landing import LandingRun, land
from docstrata.plans.transform import TransformRun, transform
from docstrata.session import scratch_dir, ship_package
from docstrata.sources.captures import BODIES, ResponseLog
from docstrata.sources.store import LANDING, TRANSFORMED, Lake
from docstrata.sql import register_functions
from docstrata.streaming.jobs import stream_landing, stream_transform

Query = Callable[[SparkSession, str], DataFrame]
SITE = "https://site.example"
RUN_TS = "2024-07-01T00:00:00"
_REGISTRY: dict[str, Query] = {}


def _query(run: Query) -> Query:
    """Register under the function's name; the workers get the package first."""

    def with_package(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    _REGISTRY[run.__name__] = with_package
    return run


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(day: str) -> Column:
    return F.col(day).cast("string").alias(day)


# -- frontier ------------------------------------------------------------------


def _supplier_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One date range per supplier: first to last shipping day."""
    day = F.col("l_shipdate").cast("date")
    return _table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("range_id")).agg(
        F.min(day).alias("range_start"), F.max(day).alias("range_end")
    )


def _user_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("ts").cast("date")
    return _table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("range_id")).agg(
        F.min(day).alias("range_start"), F.max(day).alias("range_end")
    )


def _requests(ranges: DataFrame, size: str) -> DataFrame:
    rows = frontier.frontier(ranges, BODIES, SITE + "/en/search/", size)
    return rows.select(
        "range_id", "body", "body_id", _text("partition_start"), _text("partition_end"), "partition_key", "url"
    )


@_query
def frontier_monthly(spark, sf_dir):
    return _requests(_supplier_ranges(spark, sf_dir), "monthly")


@_query
def frontier_quarterly(spark, sf_dir):
    return _requests(_supplier_ranges(spark, sf_dir), "quarterly")


@_query
def frontier_weekly(spark, sf_dir):
    return _requests(_user_ranges(spark, sf_dir), "weekly")


@_query
def frontier_size(spark, sf_dir):
    """Number of body x partition combinations per range."""
    pairs = frontier.combinations(frontier.generate_partitions(_supplier_ranges(spark, sf_dir), "monthly"), BODIES)
    return pairs.groupBy("range_id").agg(F.count(F.lit(1)).alias("combinations"))


@_query
def check_ranges(spark, sf_dir):
    """Validity of date ranges given as text."""
    ship = F.date_format("l_shipdate", "yyyy-MM-dd")
    start = (
        F.when(F.col("l_returnflag") == "R", F.date_format("l_shipdate", "dd/MM/yyyy"))
        .when(F.col("l_linenumber") == 1, "")
        .otherwise(ship)
    )
    end = F.when(F.col("l_linenumber") == 2, F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("-02-30"))).otherwise(
        F.date_format(F.date_add(F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int") - 25), "yyyy-MM-dd")
    )
    ranges = _table(spark, sf_dir, "lineitem").select(start.alias("start_date"), end.alias("end_date"))
    error = F.coalesce("range_error", F.lit("ok")).alias("range_error")
    return frontier.check_ranges(ranges).groupBy(error).agg(F.count(F.lit(1)).alias("n_ranges"))


@_query
def partition_assign_orders(spark, sf_dir):
    """Orders per partition of a series that starts mid-month, for each size."""
    anchor = F.lit("1994-12-15").cast("date")
    day = F.col("o_orderdate").cast("date")
    orders = _table(spark, sf_dir, "orders").select(
        "o_totalprice",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(size).alias("size"),
                        fn.partition_start_of(day, anchor, size).cast("string").alias("partition_start"),
                    )
                    for size in ("monthly", "weekly", "quarterly")
                ]
            )
        ).alias("p"),
    )
    return orders.groupBy("p.size", "p.partition_start").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price")
    )


@_query
def partition_counts_events(spark, sf_dir):
    """Events per type and week."""
    start = fn.partition_start_of(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"), "weekly")
    return (
        _table(spark, sf_dir, "events")
        .groupBy("event_type", start.cast("string").alias("partition_start"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


@_query
def sql_partitions(spark, sf_dir):
    """Monthly partitions and search dates through the registered SQL functions."""
    register_functions(spark)
    _supplier_ranges(spark, sf_dir).createOrReplaceTempView("supplier_ranges")
    return spark.sql(
        """SELECT range_id, CAST(p.partition_start AS STRING) AS partition_start,
             format_search_date(p.partition_end) AS search_to
           FROM supplier_ranges, LATERAL monthly_partitions(range_start, range_end) AS p"""
    )


# -- scalar projections ----------------------------------------------------------


@_query
def iso_dates(spark, sf_dir):
    """Textual date reorder on well-formed and odd inputs."""
    priority = F.substring("o_orderpriority", 1, 1)
    text = (
        F.when(priority == "1", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(priority == "2", F.date_format("o_orderdate", "d/M/yyyy"))
        .when(priority == "3", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(priority == "4", F.concat_ws("/", "o_orderstatus", F.lit("x"), F.lit("y")))
        .otherwise("")
    )
    return (
        _table(spark, sf_dir, "orders")
        .select("o_orderkey", text.alias("published_date"))
        .withColumns(
            {
                "published_date_iso": fn.iso_from_slashes(F.col("published_date")),
                "published_dt": fn.published_day(F.col("published_date")).cast("string"),
            }
        )
    )


@_query
def total_results(spark, sf_dir):
    """Result counts parsed from header lines of several shapes."""
    key = F.col("o_orderkey").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("\n Shows 1 to\n 10\n  of  "), key, F.lit("  results\n")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("1 to 10 of "), key, F.lit(",000 results")))
        .otherwise(F.concat(F.lit("no results for "), key))
    )
    return _table(spark, sf_dir, "orders").select("o_orderkey", fn.total_results(text).alias("total_results"))


def _page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as captured documents with listing fields."""
    url = F.col("url")
    published = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7 % 366).cast("int"))
    content_type = (
        F.when(F.contains(url, F.lit("?page=")), "APPLICATION/PDF")
        .when(F.endswith(url, F.lit("#top")), "application/msword")
        .when(F.endswith(url, F.lit("/")), "application/vnd.openxmlformats-officedocument.wordprocessingml.document")
        .when(F.endswith(url, F.lit(".html")), "text/html; charset=utf-8")
    )
    return _table(spark, sf_dir, "pages").select(
        F.concat(F.lit("PG/ "), F.lpad(F.col("page_id").cast("string"), 8, "0")).alias("identifier"),
        F.concat(F.lit("Body "), F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1)).alias("body"),
        F.date_format(published, "dd/MM/yyyy").alias("published_date"),
        F.trunc(published, "MM").cast("string").alias("partition_date"),
        url.alias("doc_url"),
        content_type.alias("content_type"),
        "html",
    ).withColumn("file_type", fn.file_type(F.col("content_type")))


@_query
def classify_and_key(spark, sf_dir):
    """File type, MIME type, landing key and transformed name of each page."""
    ftype, identifier = F.col("file_type"), F.col("identifier")
    return _page_rows(spark, sf_dir).select(
        "identifier", "file_type",
        fn.mime_type(ftype).alias("mime_type"),
        fn.landing_key(F.col("body"), F.col("partition_date"), identifier, ftype).alias("file_path"),
        fn.transformed_name(identifier, ftype).alias("file_name"),
    )


# -- HTML and hashes ---------------------------------------------------------------


@_query
def normalize_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return html.normalize_html(pages, "html").select("page_id", "normalized_text")


@_query
def content_hash(spark, sf_dir):
    """Stable hash: normalised text for html, raw bytes for pdf and doc."""
    rows = _page_rows(spark, sf_dir).withColumn("content", F.encode("html", "UTF-8"))
    return rows.select("identifier", "file_type", html.content_hash(F.col("content"), F.col("file_type")).alias("file_hash"))


@_query
def clean_main(spark, sf_dir):
    """Cleaned page and the hash of its bytes."""
    cleaned = html.clean_html(_table(spark, sf_dir, "pages"), "html").select("page_id", "cleaned_html")
    return cleaned.withColumn("file_hash", fn.sha256_hex(F.encode("cleaned_html", "UTF-8")))


@_query
def transformed_bytes(spark, sf_dir):
    """Transformed-zone bytes by file type: html cleaned, the rest unchanged."""
    rows = _page_rows(spark, sf_dir).select(
        "identifier", "file_type",
        html.transformed_content(F.encode("html", "UTF-8"), F.col("file_type")).alias("content"),
    )
    return rows.select(
        "identifier", "file_type", F.octet_length("content").cast("bigint").alias("length"),
        fn.sha256_hex(F.col("content")).alias("file_hash"),
    )


def _document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as landed records."""
    return _table(spark, sf_dir, "documents").select(
        F.concat(F.lit("D-"), F.col("doc_id").cast("string")).alias("identifier"),
        "doc_id", "lang", "source",
        fn.sha256_hex(F.col("text")).alias("file_hash"),
        fn.sha256_hex(F.concat(F.lit("old "), F.col("text"))).alias("other_hash"),
    )


@_query
def duplicate_content(spark, sf_dir):
    """Hashes shared by several documents, whitespace differences ignored."""
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", fn.sha256_hex(fn.collapse(F.col("text"))).alias("file_hash")
    )
    return reconcile.duplicate_content(rows, key="doc_id")


@_query
def duplicate_identifiers(spark, sf_dir):
    """Identifiers that break uniqueness when texts serve as identifiers."""
    rows = _table(spark, sf_dir, "documents").select(fn.sha256_hex(F.col("text")).alias("identifier"))
    return reconcile.duplicate_keys(rows)


@_query
def name_collisions(spark, sf_dir):
    """Object names that several documents map to."""
    rows = _table(spark, sf_dir, "documents").select(
        # Every tenth identifier occurs twice: a repeated identifier is no collision.
        F.floor(F.col("doc_id") / 10).cast("string").alias("identifier"),
        fn.transformed_name(F.concat_ws("/", "source", "lang"), F.lit("html")).alias("file_path"),
    )
    return reconcile.name_collisions(rows)


# -- joins and change classification --------------------------------------------------


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run stored of the labelled documents: same, other or no hash."""
    labels = _table(spark, sf_dir, "labels").join(_document_rows(spark, sf_dir), "doc_id")
    stored_hash = F.when((F.col("quality") == 1) & (F.col("toxic") == 1), F.col("other_hash")).when(
        (F.col("quality") == 1) | (F.col("toxic") == 1), F.col("file_hash")
    )
    return labels.select("identifier", stored_hash.alias("file_hash"), "source")


@_query
def skip_known(spark, sf_dir):
    rows = _document_rows(spark, sf_dir).select("identifier", "source")
    return reconcile.skip_known(rows, _stored(spark, sf_dir))


@_query
def skipped_known(spark, sf_dir):
    rows = _document_rows(spark, sf_dir).select("identifier", "source")
    return reconcile.skipped_known(rows, _stored(spark, sf_dir))


@_query
def known_counts(spark, sf_dir):
    """Known and new documents per source, flagged in one pass."""
    rows = _document_rows(spark, sf_dir).select("identifier", "source")
    flagged = reconcile.flag_known(rows, _stored(spark, sf_dir), unique=True)
    return flagged.groupBy("source").agg(
        F.count_if("is_known").alias("records_skipped"), F.count_if(~F.col("is_known")).alias("records_scraped")
    )


@_query
def dedup_first(spark, sf_dir):
    """First document of each distinct text."""
    rows = _document_rows(spark, sf_dir).select("file_hash", "doc_id", "lang", "source")
    return reconcile.first_per_key(rows, "file_hash", ["doc_id"])


@_query
def classify_changes(spark, sf_dir):
    rows = _document_rows(spark, sf_dir).select("identifier", "file_hash")
    return reconcile.classify_changes(rows, _stored(spark, sf_dir))


@_query
def classify_repairs(spark, sf_dir):
    """The same decision with the repairing rule; French downloads failed this time."""
    rows = _document_rows(spark, sf_dir).select(
        "identifier", F.when(F.col("lang") != "fr", F.col("file_hash")).alias("file_hash")
    )
    return reconcile.classify_changes(rows, _stored(spark, sf_dir), repair_failed=True)


@_query
def apply_changes(spark, sf_dir):
    """State after the run: stored rows, overwritten by inserts and updates."""
    stored = _stored(spark, sf_dir).select("identifier", "file_hash", F.lit(0).alias("version"))
    rows = _document_rows(spark, sf_dir).select("identifier", "file_hash")
    applied = reconcile.classify_changes(rows, stored).filter(F.col("action").isin("insert", "update"))
    changed = applied.select("identifier", "file_hash", F.lit(1).alias("version"))
    return reconcile.last_per_key(stored.unionByName(changed), "identifier", ["version"])


@_query
def sink_counts(spark, sf_dir):
    rows = _document_rows(spark, sf_dir).select("identifier", "file_hash")
    return stats.sink_counts(reconcile.classify_changes(rows, _stored(spark, sf_dir)))


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as arrivals of a user's record: the type is its hash, errors have none."""
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("identifier"),
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("file_hash"),
    )


def _stored_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a non-negative balance as the users stored before."""
    return (
        _table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") >= 0)
        .select(F.col("c_custkey").alias("identifier"), F.when(F.col("c_acctbal") > 5000, "view").alias("file_hash"))
    )


@_query
def fold_changes(spark, sf_dir):
    """Decision for each of many arrivals per key, in order."""
    return reconcile.fold_changes(_arrivals(spark, sf_dir), _stored_users(spark, sf_dir), ["event_id"])


@_query
def fold_final(spark, sf_dir):
    """The arrival that is left of each key."""
    folded = reconcile.fold_changes(_arrivals(spark, sf_dir), _stored_users(spark, sf_dir), ["event_id"])
    return reconcile.last_applied(folded, ["event_id"])


def _transformed_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transformed rows of an earlier run over the first half of the year.

    Pages of blog hosts had other content then.
    """
    rows = _page_rows(spark, sf_dir).filter(F.col("partition_date").between("2024-01-01", "2024-06-30"))
    other = F.when(F.contains(F.col("doc_url"), F.lit("://blog.")), fn.sha256_hex(F.col("doc_url")))
    return rows.select(
        "identifier", F.coalesce(other, fn.sha256_hex(F.col("html"))).alias("file_hash"),
    ).withColumn("original_file_hash", F.col("file_hash"))


def _page_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_rows(spark, sf_dir).withColumn("file_hash", fn.sha256_hex(F.col("html"))).drop("html")


@_query
def transform_upsert(spark, sf_dir):
    """Transformed records with their insert / update / skip status."""
    identifier, ftype = F.col("identifier"), F.col("file_type")
    rows = _page_hashes(spark, sf_dir).select(
        "identifier", "published_date", "doc_url", "body", "partition_date", "file_type", "file_hash",
        fn.transformed_name(identifier, ftype).alias("file_path"),
        fn.landing_key(F.col("body"), F.col("partition_date"), identifier, ftype).alias("original_file_path"),
    )
    return reconcile.classify_upserts(rows, _transformed_before(spark, sf_dir))


@_query
def transform_counts(spark, sf_dir):
    rows = _page_hashes(spark, sf_dir).select("identifier", "file_hash")
    statuses = reconcile.classify_upserts(rows, _transformed_before(spark, sf_dir))
    # PDFs have no stored object in this scenario.
    failed = _page_hashes(spark, sf_dir).filter("file_type = 'pdf'").select("identifier", F.lit("missing_blob").alias("_f"))
    status = F.coalesce("_f", "status").alias("status")
    return stats.transform_counts(statuses.join(failed, "identifier", "left").select("identifier", status))


@_query
def source_hash_skip(spark, sf_dir):
    """Landed pages whose source changed since the last transform."""
    rows = _page_hashes(spark, sf_dir).select("identifier", "file_hash", "partition_date")
    return reconcile.changed_sources(rows, _transformed_before(spark, sf_dir))


def _zones(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Landing rows, transformed rows and stored object keys of the documents."""
    landing = _document_rows(spark, sf_dir).select(
        "identifier", "source",
        F.when(F.col("lang") != "es", F.concat(F.col("lang"), F.lit("/"), F.col("identifier"))).alias("file_path"),
    )
    labelled = _table(spark, sf_dir, "labels").select(F.concat(F.lit("D-"), F.col("doc_id").cast("string")).alias("identifier"))
    orphans = _table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("B-"), F.col("item_id").cast("string")).alias("identifier")
    )
    transformed = labelled.unionByName(orphans).withColumn("file_path", F.concat("identifier", F.lit(".html")))
    blobs = landing.filter("source <> 'src3' and file_path is not null").select("file_path")
    return landing, transformed, blobs


@_query
def reconcile_zones(spark, sf_dir):
    return reconcile.reconcile_zones(*_zones(spark, sf_dir))


@_query
def dangling_paths(spark, sf_dir):
    """Landing rows whose path has no object."""
    landing, _, blobs = _zones(spark, sf_dir)
    return reconcile.blobs_missing(landing, blobs).select("identifier", "file_path")


@_query
def present_paths(spark, sf_dir):
    """Landing rows whose object exists."""
    landing, _, blobs = _zones(spark, sf_dir)
    return reconcile.blobs_present(landing, blobs).select("identifier", "file_path")


# -- statistics ------------------------------------------------------------------------

EVENT_BODIES = {t: t for t in ("click", "error", "purchase", "refund", "signup", "view")}


def _event_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as outcome rows; the type is the body, the week the partition."""
    first = F.lit("2024-01-01").cast("date")
    start = fn.partition_start_of(F.col("ts").cast("date"), first, "weekly")
    value = F.col("value")
    outcome = (
        F.when(value < 1, "request_failed").when(value < 3, "failed").when(value < 5, "no_url")
        .when(value < 20, "skipped").otherwise("landed")
    )
    return _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("body"),
        start.alias("partition_start"),
        F.date_add(start, 6).alias("partition_end"),
        F.concat(F.lit("E-"), F.col("event_id").cast("string")).alias("identifier"),
        outcome.alias("outcome"),
        F.concat(F.lit(SITE + "/"), F.col("event_id").cast("string")).alias("url"),
        F.col("props").alias("error"),
        "user_id", "value",
    )


def _event_stats(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    outcomes = _event_outcomes(spark, sf_dir)
    # One captured result page per user and partition; the page of user 0 is the first.
    pages = outcomes.groupBy(*stats.PARTITION, (F.col("user_id") + 1).alias("page_number")).agg(
        (F.count(F.lit(1)) * 100).alias("page_total"), F.when(F.min("value") < 0.1, "timeout").alias("error")
    )
    # The range ends with the last event's week, as the partitions of the outcomes do.
    first = F.lit("2024-01-01").cast("date")
    last = F.date_add(fn.partition_start_of(F.max(F.col("ts").cast("date")), first, "weekly"), 6)
    days = _table(spark, sf_dir, "events").agg(first.alias("range_start"), last.alias("range_end"))
    requests = frontier.frontier(days, EVENT_BODIES, SITE + "/en/search/", "weekly")
    return stats.partition_stats(requests, pages, outcomes), outcomes


def _stat_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumns({d: F.col(d).cast("string") for d in ("partition_start", "partition_end") if d in rows.columns})


@_query
def partition_stats(spark, sf_dir):
    """Counters per body and week with completeness; empty partitions show zeros."""
    return _stat_rows(stats.completeness(_event_stats(spark, sf_dir)[0]))


@_query
def crawl_rollup(spark, sf_dir):
    return _stat_rows(stats.rollup_stats(_event_stats(spark, sf_dir)[0]))


@_query
def crawl_summary(spark, sf_dir):
    return stats.crawl_summary(_event_stats(spark, sf_dir)[0])


@_query
def failed_urls(spark, sf_dir):
    return _stat_rows(stats.failed_urls(_event_outcomes(spark, sf_dir)))


@_query
def failed_urls_top3(spark, sf_dir):
    first = stats.first_failed_urls(_event_outcomes(spark, sf_dir), 3)
    flat = F.array_join(F.transform("failed_urls", lambda f: F.concat(f["url"], F.lit(" "), f["error"])), "; ")
    return _stat_rows(first.withColumn("failed_urls", flat))


@_query
def unfinished_partitions(spark, sf_dir):
    """Partitions to run again: failures, or nothing captured."""
    done, _ = _event_stats(spark, sf_dir)
    requests = done.select(*stats.PARTITION)
    return _stat_rows(frontier.unfinished(requests, done))


@_query
def failure_events(spark, sf_dir):
    return _stat_rows(stats.failure_events(_event_outcomes(spark, sf_dir)))


@_query
def summary_format(spark, sf_dir):
    """Readable form of the partition and run summaries."""
    per_partition, outcomes = _event_stats(spark, sf_dir)
    messages = stats.partition_messages(per_partition, outcomes).select("message")
    both = messages.unionByName(stats.crawl_summary(per_partition).select("message"))
    return both.select(format_summary(F.col("message")).alias("summary"))


@_query
def partition_history(spark, sf_dir):
    """Every failure recovered from partition summary messages, with the partition's counters."""
    messages = stats.partition_summaries(*_event_stats(spark, sf_dir), chunk_rows=7).select("message")
    return logs.partition_failures(logs.partition_history(messages))


@_query
def cleaning_rules(spark, sf_dir):
    """Banner classes, ids, hidden inputs and return links around the main content of each page."""
    number = F.col("page_id").cast("string")
    classes = (
        "cookie-banner", "navbar", "footer-one", "footer-two", "footer-nav", "social-banner", "no-print", "return-to-search", "ptools-pager",
    )
    ids = ("binderFixed", "advancedSearchControls", "searchPnl")
    pick = lambda names: F.get(F.array(*[F.lit(n) for n in names]), (F.col("page_id") % len(names)).cast("int"))
    page = F.concat(
        F.lit('<html><body><header>h</header><noscript>n</noscript><div class="wide '), pick(classes), F.lit('">gone <b>too</b></div><p id="'), pick(ids),
        F.lit('">gone</p><div id="main"><a href="/s">Return to Search</a><a href="/s"><i>x</i> Return to Search</a><input type="hidden" value="'), number,
        F.lit('"><p>Page '), number, F.lit("</p></div><iframe>f</iframe></body></html>"),
    )
    return _table(spark, sf_dir, "pages").select("page_id", html.normalized_text(page).alias("text"), html.cleaned_html(page).alias("main"))


@_query
def sql_html_functions(spark, sf_dir):
    """The registered hash, text and cleaning functions, called from SQL."""
    register_functions(spark)
    _table(spark, sf_dir, "pages").createOrReplaceTempView("sql_html_pages")
    return spark.sql(
        """SELECT page_id, compute_content_hash(doc, 'html') AS html_hash, compute_content_hash(doc, 'pdf') AS pdf_hash,
             compute_content_hash(doc, CAST(NULL AS STRING)) AS other_hash, normalize_html_content(doc) AS text, clean_html(doc) AS main
           FROM (SELECT page_id, encode('<html><body><script>s</script><p>Page <b>' || page_id || '</b></p></body></html>', 'UTF-8') AS doc
                 FROM sql_html_pages)"""
    )


@_query
def late_charset(spark, sf_dir):
    """Text of pages in ISO 8859-1 whose charset is declared behind a long comment."""
    page = F.concat(
        F.lit("<html><head><!--"), F.repeat(F.lit("x"), 3000), F.lit('--><meta charset="iso-8859-1"></head><body><p>'), "url",
        F.lit(" \u00e9\u00fc\u0091</p></body></html>"),
    )
    return _table(spark, sf_dir, "pages").select("page_id", html.normalized_text(F.encode(page, "ISO-8859-1")).alias("text"))


@_query
def strange_charsets(spark, sf_dir):
    """Text of pages that declare charsets which are none, or not for web pages."""
    names = F.array(*[F.lit(n) for n in ("undefined", "utf-7", "unicode_escape", "rot13", "a\x00b", "utf-8")])
    name = F.get(names, (F.col("page_id") % 6).cast("int"))
    page = F.concat(F.lit('<html><head><meta charset="'), name, F.lit('"></head><body><p>'), "url", F.lit(" é +AGE- \\ud800</p></body></html>"))
    return _table(spark, sf_dir, "pages").select("page_id", html.normalized_text(F.encode(page, "UTF-8")).alias("text"))


@_query
def run_history(spark, sf_dir):
    """Typed rows recovered from crawl summary messages, one run per body."""
    per_partition, _ = _event_stats(spark, sf_dir)
    per_body = per_partition.groupBy("body").agg(
        F.sum("total_results").alias("total_expected"), F.sum("records_scraped").alias("total_scraped"),
        F.sum("records_skipped").alias("total_skipped"), F.sum("records_failed").alias("total_failed"),
        F.count(F.lit(1)).alias("partitions_processed"),
    )
    fields = [F.lit("crawl_complete").alias("event"), F.col("body").alias("reason"), *per_body.columns[1:]]
    messages = per_body.select(F.concat(F.lit("Crawl summary: "), F.to_json(F.struct(*fields))).alias("message"))
    return logs.run_history(messages).drop("message")


# -- logs --------------------------------------------------------------------------------


def _log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines of one run per user, in several formats."""
    kind, value, number = F.col("event_type"), F.col("value"), F.col("event_id").cast("string")
    counter = (
        F.when(value < 5, "item_scraped_count").when(value < 10, "downloader/request_count")
        .when(value < 15, "retry/count").when(value < 20, "log_count/ERROR").otherwise("elapsed_time_seconds")
    )
    text = (
        F.when(kind == "view", F.concat(F.lit('{"timestamp": "t", "level": "WARNING", "message": "Found '), number, F.lit(' results"}')))
        .when((kind == "click") & (value < 2), F.lit('{"a": 1}'))
        .when(kind == "click", F.concat(F.lit("2024-01-01 10:00:00 [spider] INFO: Queueing: body="), number, F.lit("  ")))
        .when(kind == "error", F.concat(F.lit("  [spider]  ERROR: \t Request failed: "), "props"))
        .when(kind == "purchase", F.concat(F.lit(" '"), counter, F.lit("': "), number, F.lit(",")))
        .when(value < 5, F.lit("5")).when(value < 10, F.lit("   ")).otherwise("[spider] DEBUG: noise")
    )
    return _table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("file"), F.col("event_id").alias("seq"), text.alias("value")
    )


@_query
def parse_logs(spark, sf_dir):
    return logs.parse_lines(_log_lines(spark, sf_dir)).select("seq", "level", "message")


@_query
def shown_logs(spark, sf_dir):
    parsed = logs.parse_lines(_log_lines(spark, sf_dir)).select("seq", "level", "message")
    return logs.shown_lines(parsed, LANDING_KEYWORDS)


@_query
def log_levels(spark, sf_dir):
    return logs.level_counts(logs.parse_lines(_log_lines(spark, sf_dir)))


@_query
def log_stats(spark, sf_dir):
    return logs.run_stats(_log_lines(spark, sf_dir), ["seq"])


# -- listing pages and whole jobs ----------------------------------------------------------


def _listing_items(spark: SparkSession, sf_dir: str, identifier: Column) -> DataFrame:
    """Documents as results on pages of up to ten, per language."""
    documents = _table(spark, sf_dir, "documents")
    page = F.floor(F.col("doc_id") / 10).cast("int")
    month = F.add_months(F.lit("2024-01-01").cast("date"), page % 12)
    published = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 366).cast("int")), "dd/MM/yyyy")
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    item = F.concat(
        F.lit('<li class="each-item even"><h2 class="title"><a href="/cases/'), F.col("doc_id").cast("string"), F.lit('.html"> '),
        identifier, F.lit(' </a></h2><span class="date">'),
        F.when(F.col("source") == "src5", F.lit("n/a")).otherwise(published),
        F.lit('</span>\n<p class="description"> '), escaped, F.lit(' <b>more</b></p><span class="refNO">'),
        F.col("source"), F.lit("</span></li>"),
    )
    return documents.select(
        "doc_id", F.col("lang").alias("body"), page.alias("page"), month.alias("partition_start"),
        F.last_day(month).alias("partition_end"), item.alias("item"),
    )


def _search_pages(items: DataFrame) -> DataFrame:
    """Result pages holding the items; every page links to the next number."""
    number = (F.col("page") + 1).cast("string")
    base = F.concat(F.lit(SITE + "/en/search/?body="), F.col("body"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "item"))), lambda r: r["item"]), "\n")
    grouped = items.groupBy("body", "page", "partition_start", "partition_end").agg(
        listed.alias("items"), F.count(F.lit(1)).alias("n_items")
    )
    page_html = F.concat(
        F.lit('<html><body><div class="searchhead">Shows 1 to 10 of '), F.col("n_items").cast("string"),
        F.lit(' results</div><div class="item-list"><ul>'), F.col("items"),
        F.lit('</ul></div><ul class="pager"><li><a class="btn next" href="?body='), F.col("body"), F.lit("&amp;pageNumber="),
        (F.col("page") + 2).cast("string"), F.lit('">next</a></li></ul></body></html>'),
    )
    return grouped.select(
        F.concat(base, F.lit("&pageNumber="), number).alias("url"),
        "body", "partition_start", "partition_end",
        (F.col("page") + 1).alias("page_number"),
        F.timestamp_seconds(F.lit(1717200000) + F.col("page")).alias("captured_at"),
        page_html.alias("html"),
        F.lit(None).cast("string").alias("error"),
    )


@_query
def extract_listing(spark, sf_dir):
    """Result pages back to metadata rows; results without an identifier drop out."""
    identifier = F.when(F.col("source") == "src7", "").otherwise(F.concat(F.lit("D-"), F.col("doc_id").cast("string")))
    pages = _search_pages(_listing_items(spark, sf_dir, identifier))
    return listing.extract_listing(pages, SITE, RUN_TS).select(
        "identifier", "description", "published_date", "published_date_iso", "ref_no", "doc_url", "body",
        "partition_date", "page_number", "pos", "scraped_at",
    )


@_query
def rejected_items(spark, sf_dir):
    """Results without an identifier."""
    identifier = F.when(F.col("source") == "src7", "").otherwise(F.col("source"))
    pages = _search_pages(_listing_items(spark, sf_dir, identifier))
    rows = listing.listing_rows(listing.scan_search_pages(pages), SITE, RUN_TS)
    return listing.without_identifier(rows).select("doc_url", "body", "partition_date", "pos")


@_query
def page_totals(spark, sf_dir):
    """Announced totals and resolved next links of the result pages."""
    pages = _search_pages(_listing_items(spark, sf_dir, F.col("source")))
    return listing.scan_search_pages(pages).select("url", "page_number", "page_total", "next_url")


@_query
def next_page_frontier(spark, sf_dir):
    """Next pages that have not been captured."""
    pages = _search_pages(_listing_items(spark, sf_dir, F.col("source")))
    todo = listing.next_page_requests(listing.scan_search_pages(pages), pages)
    return todo.select("url", "body", _text("partition_start"), "page_number")


def _captures(spark: SparkSession, sf_dir: str, captured: str = "source <> 'src9'") -> tuple[DataFrame, DataFrame]:
    """Listing pages and document responses; equal texts share an identifier.

    Source src3 fails, src9 has not been captured, French and Spanish texts are html.
    """
    identifier = F.concat(F.lit("H-"), fn.sha256_hex(F.col("text")))
    pages = _search_pages(_listing_items(spark, sf_dir, identifier))
    failed = F.col("source") == "src3"
    content_type = F.when(F.col("lang") == "en", "application/pdf").when(F.col("lang") == "de", "application/msword")
    responses = _table(spark, sf_dir, "documents").filter(captured).select(
        F.concat(F.lit(SITE + "/cases/"), F.col("doc_id").cast("string"), F.lit(".html")).alias("url"),
        content_type.alias("content_type"),
        F.when(~failed, F.encode("text", "UTF-8")).alias("content"),
        F.when(failed, "HTTP 503").alias("error"),
        F.timestamp_seconds(F.lit(1717300000)).alias("captured_at"),
    )
    return pages, responses


def _new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, f"{scratch_dir(spark)}/lake-{uuid.uuid4().hex}")


def _run(start: str, end: str, version: int = 1) -> LandingRun:
    return LandingRun(start, end, SITE, version, RUN_TS, bodies={b: b for b in ("de", "en", "es", "fr")})


def _landed(lake: Lake) -> DataFrame:
    return lake.current(LANDING).select(
        "identifier", "description", "published_date_iso", "ref_no", "doc_url", "body", "partition_date",
        "file_path", "file_hash", "file_type",
    )


@_query
def landing_state(spark, sf_dir):
    """Landing zone after one run over all captured pages."""
    lake = _new_lake(spark)
    land(lake, *_captures(spark, sf_dir), _run("2024-01-01", "2024-12-31"))
    return _landed(lake)


@_query
def objects_by_key(spark, sf_dir):
    """Objects of one source's paths, and of a path that has none."""
    lake = _new_lake(spark)
    land(lake, *_captures(spark, sf_dir), _run("2024-01-01", "2024-12-31"))
    paths = lake.current(LANDING, columns=["file_path", "ref_no"]).filter("ref_no = 'src2'").select("file_path")
    none = spark.range(1).select(F.lit("en/2024-01-01/none.pdf").alias("file_path"))
    found = lake.objects(LANDING, paths.unionByName(none))
    return found.select("file_path", fn.sha256_hex(F.col("content")).alias("content_hash"), "content_type", "length")


@_query
def landing_increment(spark, sf_dir):
    """Outcomes of a whole-year run after one over its first half."""
    lake = _new_lake(spark)
    captures = _captures(spark, sf_dir)
    land(lake, *captures, _run("2024-01-01", "2024-06-30"))
    result = land(lake, *captures, _run("2024-01-01", "2024-12-31", version=2))
    return result.outcomes.groupBy("body", "outcome").agg(F.count(F.lit(1)).alias("n_rows"))


@_query
def landing_range(spark, sf_dir):
    """Landed rows of the second quarter's partitions."""
    lake = _new_lake(spark)
    land(lake, *_captures(spark, sf_dir), _run("2024-01-01", "2024-12-31"))
    lake.compact(LANDING, RUN_TS)
    return lake.in_range(LANDING, "2024-04-01", "2024-06-30", columns=["file_hash", "partition_date"]).select("identifier", "partition_date", "file_hash")


@_query
def hash_update_counts(spark, sf_dir):
    """Sink counters when every arrival of a second run is compared in order."""
    lake = _new_lake(spark)
    captures = _captures(spark, sf_dir)
    land(lake, *captures, _run("2024-01-01", "2024-06-30"))
    again = replace(_run("2024-01-01", "2024-12-31", version=2), policy="hash_update")
    return land(lake, *captures, again).counts()


@_query
def transform_rerun(spark, sf_dir):
    """Statuses of a source-hash transform of the year after one of its first half."""
    lake = _new_lake(spark)
    land(lake, *_captures(spark, sf_dir), _run("2024-01-01", "2024-12-31"))
    transform(lake, TransformRun("2024-01-01", "2024-06-30", 1, RUN_TS))
    again = transform(lake, TransformRun("2024-01-01", "2024-12-31", 2, RUN_TS, mode="source_hash"))
    return again.statuses.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


@_query
def transform_stream(spark, sf_dir):
    """Transformed zone kept up to date from the landing commits, version by version."""
    lake = _new_lake(spark)
    captures = _captures(spark, sf_dir)
    for version, (start, end) in enumerate((("2024-01-01", "2024-06-30"), ("2024-07-01", "2024-12-31")), 1):
        land(lake, *captures, _run(start, end, version))
        follow = TransformRun("2024-01-01", "2024-12-31", 1, RUN_TS)
        stream_transform(lake, follow, lake.path("checkpoint")).awaitTermination()
    return lake.current(TRANSFORMED, columns=["partition_date", "file_type"]).groupBy("partition_date", "file_type").agg(F.count(F.lit(1)).alias("n_rows"))


@_query
def transformed_state(spark, sf_dir):
    """Transformed zone after landing and transforming the whole year."""
    lake = _new_lake(spark)
    land(lake, *_captures(spark, sf_dir), _run("2024-01-01", "2024-12-31"))
    transform(lake, TransformRun("2024-01-01", "2024-12-31", 1, RUN_TS))
    return lake.current(TRANSFORMED).select(
        "identifier", "description", "ref_no", "doc_url", "body", "partition_date", "file_type", "file_hash",
        "file_path", "original_file_path", "original_file_hash",
    )


@_query
def landing_stream(spark, sf_dir):
    """The landing run fed by a file stream of captured pages."""
    lake = _new_lake(spark)
    pages, responses = _captures(spark, sf_dir)
    pages.write.option("compression", "zstd").parquet(lake.path("captured"))
    stream = spark.readStream.schema(pages.schema).parquet(lake.path("captured"))
    stream_landing(lake, stream, responses, _run("2024-01-01", "2024-12-31"), lake.path("checkpoint")).awaitTermination()
    return _landed(lake)


@_query
def landing_stream_late(spark, sf_dir):
    """The landing stream when half of the documents are captured after their result pages."""
    lake = _new_lake(spark)
    pages, _ = _captures(spark, sf_dir)
    pages.write.option("compression", "zstd").parquet(lake.path("captured"))
    stream = spark.readStream.schema(pages.schema).parquet(lake.path("captured"))
    captured = ResponseLog(spark, lake.path("documents"))
    for half in (0, 1):  # all copies of a text come in the same half
        _, responses = _captures(spark, sf_dir, f"source <> 'src9' AND crc32(text) % 2 = {half}")
        responses.write.mode("append").option("compression", "zstd").parquet(captured.path)
        stream_landing(lake, stream, captured, _run("2024-01-01", "2024-12-31"), lake.path("checkpoint")).awaitTermination()
    return _landed(lake)


@_query
def bad_documents(spark, sf_dir):
    """Documents that a landing and a transform put aside, and the counts of both runs."""
    lake = _new_lake(spark)
    landed = land(lake, *_captures(spark, sf_dir), replace(_run("2024-01-01", "2024-12-31"), max_bytes=4000))
    done = transform(lake, TransformRun("2024-01-01", "2024-12-31", 1, RUN_TS, max_bytes=2000))
    fields = ("identifier", "url", "body", "partition_date", "error")
    none = [F.lit(None).cast("string").alias(c) for c in fields]
    counts = [
        rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(zone).alias("zone"), F.col(kind).alias("kind"), "n_rows", *none)
        for zone, rows, kind in ((LANDING, landed.outcomes, "outcome"), (TRANSFORMED, done.statuses, "status"))
    ]
    aside = [
        lake.quarantine(zone).select(F.lit(zone).alias("zone"), F.lit("quarantined").alias("kind"), F.lit(1).cast("bigint").alias("n_rows"), *fields)
        for zone in (LANDING, TRANSFORMED)
    ]
    return reduce(DataFrame.unionByName, counts + aside)


@_query
def flagship(spark, sf_dir):
    """New pages of each body and month, with their distinct contents.

    Known pages are skipped before any page is parsed.
    """
    known = _transformed_before(spark, sf_dir)
    fresh = reconcile.skip_known(_page_rows(spark, sf_dir), known)
    hashed = fresh.withColumn("file_hash", html.content_hash(F.encode("html", "UTF-8"), F.col("file_type")))
    return hashed.groupBy("body", "partition_date").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count_distinct("file_hash").alias("n_contents"),
        F.min("file_hash").alias("min_hash"),
    )
