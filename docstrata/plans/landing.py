"""The landing job: captured pages and documents into the landing zone."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata import schemas
from docstrata.functions.files import file_type, landing_key, mime_type
from docstrata.operators import stats
from docstrata.operators.frontier import frontier, range_row, validate_range
from docstrata.operators.html import checked_hash
from docstrata.operators.listing import listing_rows, scan_search_pages, with_identifier
from docstrata.operators.reconcile import (
    ARRIVAL_ORDER, classify_changes, flag_known, fold_changes, last_applied, spread_nulls,
)
from docstrata.sources.captures import BODIES, ResponseLog
from docstrata.sources.store import LANDING, Lake

POLICIES = ("default", "write_once", "hash_update")


@dataclass(frozen=True)
class LandingRun:
    """Parameters of one landing run.

    ``policy``: ``default`` skips identifiers landed in the requested range and compares
    hashes for the others; ``write_once`` skips every landed identifier; ``hash_update``
    skips none and folds all arrivals in order.  ``repair_failed`` lets a good download
    replace a failed one and never the other way round.

    ``keep_pending``: results whose document has not been captured are kept, and those that
    earlier runs kept are taken up again with this run's results.  HTML documents of more than
    ``max_bytes`` and pages of more than ``max_page_bytes`` are put aside unread.
    """

    start_date: str
    end_date: str
    site: str
    version: int
    run_ts: str
    search_path: str = "/en/search/"
    size: str = "monthly"
    bodies: Mapping[str, str] = field(default_factory=lambda: BODIES)
    policy: str = "default"
    repair_failed: bool = False
    keep_pending: bool = False
    max_bytes: int | None = None
    max_page_bytes: int | None = None


@dataclass(frozen=True)
class LandingResult:
    """What a run did; all lazy views over tables the run has written."""

    version: int
    outcomes: DataFrame
    actions: DataFrame
    stats: DataFrame
    arrivals: DataFrame

    def counts(self) -> DataFrame:
        return stats.sink_counts(self.actions)

    def summaries(self) -> DataFrame:
        return stats.partition_summaries(self.stats, self.outcomes)

    def summary(self) -> DataFrame:
        return stats.crawl_summary(self.stats)

    def pending(self) -> DataFrame:
        """Document URLs that no captured response answers yet."""
        return pending_documents(self.arrivals)


def land(lake: Lake, search_pages: DataFrame, responses: DataFrame | ResponseLog, run: LandingRun) -> LandingResult:
    """Land the captured pages of a date range.  Running a version again rewrites it.

    A page or document that cannot be read ends as ``bad_item`` in the outcomes and in the
    quarantine; all others land.
    """
    if run.policy not in POLICIES:
        raise ValueError(f"policy {run.policy!r} is none of {', '.join(POLICIES)}")
    start, end = validate_range(run.start_date, run.end_date)
    in_range = search_pages.filter(F.col("partition_start").between(F.lit(start), F.lit(end)))

    # Each page is parsed once; everything later reads the parsed table.
    scanned = scan_search_pages(in_range, run.max_page_bytes)
    pages = lake.write_pages(scanned, run.version)
    repeated = _repeated_captures(pages)
    if not repeated.isEmpty():
        pages = _one_capture(pages, lake.stage(repeated, "repeated_captures", run.version))
    stored = lake.current(LANDING, run.version, schemas.FILE_FIELDS)
    # Decisions are taken on rows without the results' texts, which stay on the pages kept.
    items, described = _items(lake, pages, run)
    # The lookup sides are written first: see ``operators.reconcile`` on hot keys.
    known = lake.stage(_known(lake, run), "known", run.version)
    wanted = lake.stage(_wanted_urls(items, known), "wanted", run.version)
    seen = lake.heads(responses, run.version) if isinstance(responses, ResponseLog) else responses
    heads = lake.stage(_best_responses(seen.join(wanted, "url", "left_semi")), "responses", run.version)
    arrivals = lake.stage(_arrivals(items, known, heads), "arrivals", run.version)
    if run.policy != "hash_update":
        repeated = lake.stage(_repeated(arrivals), "repeated", run.version)
        arrivals = lake.stage(_skip_repeats(arrivals, repeated), "distinct_arrivals", run.version)

    blobs = _store_documents(lake, arrivals, responses, seen, run)
    bad = blobs.filter(F.col("error").isNotNull()).select(F.col("blob_id").alias("_bad"), F.col("error").alias("_why"))
    records = _records(arrivals, blobs)
    if run.policy == "hash_update":
        # Both steps sort or use their input twice, so it is written once.
        records = lake.stage(records, "records", run.version)
        folded = lake.stage(_fold(records, stored, run), "folded", run.version)
        decided = lake.stage(_mark_final(folded), "decided", run.version)
    else:
        decided = lake.stage(_decide(records, stored, run), "decided", run.version)
    lake.write_log(_named(lake, _log_rows(decided, stored, run), described, run), LANDING, run.version)
    outcomes = _outcomes(arrivals, pages, bad)
    lake.write_quarantine(_quarantined(outcomes), LANDING, run.version)
    if run.keep_pending:
        lake.write_pending(_named(lake, arrivals.filter(F.col("outcome") == "pending"), described, run), run.version)
    lake.commit(LANDING, run.version, run.run_ts)

    requests = frontier(
        range_row(lake.spark, run.start_date, run.end_date), run.bodies, run.site + run.search_path, run.size
    )
    return LandingResult(run.version, outcomes, decided, stats.partition_stats(requests, pages, outcomes), arrivals)


_FILES = "struct<" + ",".join(f"{c}:string" for c in schemas.FILE_FIELDS) + ">"
# One result: the number of its page, or of its row in the queue, and its position there.
_PLACE = ["_page", "pos"]
_CAPTURE = ["url", "body", "partition_start", "page_number", "captured_at"]


def _repeated_captures(pages: DataFrame) -> DataFrame:
    """Captures that occur more than once, as after a repeated ingestion."""
    counted = pages.groupBy(*_CAPTURE).agg(F.count(F.lit(1)).alias("n"), F.min("_page").alias("first"))
    return counted.filter("n > 1")


def _one_capture(pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """Pages without the further copies of a capture: the first page kept of each counts."""
    # Only the numbers of repeated captures are compared; no page moves for it unless they are many.
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _CAPTURE]
    firsts = repeated.select(*[F.col(c).alias(f"_{c}") for c in _CAPTURE], "first")
    return pages.join(firsts, same, "left").filter(F.col("first").isNull() | (F.col("first") == F.col("_page"))).select(*pages.columns)


def _known(lake: Lake, run: LandingRun) -> DataFrame:
    """Identifiers the run skips."""
    stored = lake.current(LANDING, run.version, ["partition_date"])
    if run.policy == "hash_update":
        stored = stored.limit(0)
    elif run.policy == "default":
        start, end = (day.isoformat() for day in validate_range(run.start_date, run.end_date))
        stored = stored.filter(F.col("partition_date").between(start, end))
    return stored.select("identifier")


def _best_responses(responses: DataFrame) -> DataFrame:
    """One response per URL: a good one if there is any, then the earliest.  No bytes."""
    # Rows of one capture first: only copies of the capture chosen need grouping by content.
    captures = responses.groupBy("url", "captured_at", "error", "content_type").agg(F.count(F.lit(1)).alias("copies"))
    by_time = captures.groupBy("url", "captured_at").agg(
        F.min(F.struct(F.col("error").isNotNull(), "error", "content_type")).alias("least"),
        F.sum(F.when(F.col("error").isNull(), F.col("copies"))).alias("copies"),
    )
    best = F.min(F.struct("least.col1", "captured_at", "least.error", "least.content_type", "copies"))
    picked = by_time.groupBy("url").agg(best.alias("best"))
    return picked.select(
        F.col("url").alias("_url"), F.col("best.captured_at").alias("response_at"), "best.error", "best.content_type",
        (F.coalesce("best.copies", F.lit(0)) > 1).alias("several"),
    )


def _items(lake: Lake, pages: DataFrame, run: LandingRun) -> tuple[DataFrame, DataFrame | None]:
    """Results of the pages, and those of earlier pages that still wait for their document.

    Without their texts.  The second table has those that the queue itself holds, by place:
    queues name the places of texts as logs do, but may have been written before they did.
    """
    fields = [c for c in schemas.PENDING.fieldNames() if c != "description"]
    rows = with_identifier(listing_rows(pages, run.site, run.run_ts, ["_page"]))
    items = rows.withColumn("text_id", F.lit(None).cast("string")).select(*fields, "_page")
    if not run.keep_pending:
        return items, None
    start, end = (day.isoformat() for day in validate_range(run.start_date, run.end_date))
    waiting = lake.pending(run.version, texts=False).filter(F.col("partition_date").between(start, end))
    queued = lake.stage(waiting.withColumn("_page", -1 - F.monotonically_increasing_id()), "queued", run.version)
    # A page that is delivered again has its results in the queue already.
    place = ["identifier", *ARRIVAL_ORDER]
    fresh = items.join(queued.select(*place), place, "left_anti")
    described = queued.filter(F.col("description").isNotNull()).select(*_PLACE, "description")
    return fresh.unionByName(queued.drop("description")), None if described.isEmpty() else described


def _named(lake: Lake, rows: DataFrame, described: DataFrame | None, run: LandingRun) -> DataFrame:
    """Rows with the names of their texts, and with the texts that the queue itself held."""
    named = rows.withColumn("text_id", F.when(F.col("_page") >= 0, lake.text_id(run.version)).otherwise(F.col("text_id")))
    return named.withColumn("description", F.lit(None).cast("string")) if described is None else named.join(described, _PLACE, "left")


def _wanted_urls(items: DataFrame, known: DataFrame) -> DataFrame:
    """Document URLs of the items that are not known yet."""
    fresh = items.filter(F.col("doc_url") != "").join(known, "identifier", "left_anti")
    return fresh.select(F.col("doc_url").alias("url")).distinct()


def _arrivals(items: DataFrame, known: DataFrame, heads: DataFrame) -> DataFrame:
    """Listing items with their outcome; document bytes are not read here."""
    flagged = flag_known(items, known, unique=True)
    download = ~F.col("is_known") & (F.col("doc_url") != "")
    wanted = spread_nulls(F.when(download, F.col("doc_url")), "identifier", "captured_at", "body", "page_number", "pos")
    joined = flagged.withColumn("_wanted", wanted).join(heads, F.col("_wanted") == F.col("_url"), "left")
    outcome = (
        F.when(F.col("is_known"), "skipped")
        .when(F.col("doc_url") == "", "no_url")
        .when(F.col("response_at").isNull(), "pending")
        .when(F.col("error").isNotNull(), "failed")
        .otherwise("landed")
    )
    return joined.withColumn("outcome", outcome).drop("_wanted", "_url", "is_known")


def _repeated(arrivals: DataFrame) -> DataFrame:
    """Identifiers that arrive several times, and where the first landed arrival is."""
    landed_at = F.min(F.when(F.col("outcome") == "landed", F.struct(*ARRIVAL_ORDER)))
    return (
        arrivals.groupBy("identifier")
        .agg(F.count(F.lit(1)).alias("_n"), landed_at.alias("_landed_at"))
        .filter("_n > 1 and _landed_at is not null")
        .select("identifier", "_landed_at")
    )


def _skip_repeats(arrivals: DataFrame, repeated: DataFrame) -> DataFrame:
    """In-run duplicates: once an identifier has landed, its later arrivals are skipped."""
    late = F.coalesce(F.struct(*ARRIVAL_ORDER) > F.col("_landed_at"), F.lit(False))
    return (
        arrivals.join(repeated, "identifier", "left")
        .withColumn("outcome", F.when(late, "skipped").otherwise(F.col("outcome")))
        .drop("_landed_at")
    )


def _store_documents(lake: Lake, arrivals: DataFrame, responses: DataFrame | ResponseLog, heads: DataFrame, run: LandingRun) -> DataFrame:
    """Type, hash and store each downloaded document once; returns the stored table.

    ``arrivals`` has just been written, so the planner knows its size: a small one is
    broadcast and no document bytes are shuffled.  A document that cannot be hashed has an
    error instead of its content.
    """
    landed = arrivals.filter(F.col("outcome") == "landed")
    needed = landed.groupBy(F.col("doc_url").alias("url"), F.col("response_at").alias("captured_at")).agg(
        F.bool_or("several").alias("several"), F.min("partition_date").alias("day")
    )
    # Microseconds, not datetimes: those pass through the driver's local time zone.
    at = F.unix_micros("captured_at")
    span = needed.agg(F.min(at).alias("first"), F.max(at).alias("last"), F.max("several").alias("several")).first()
    first, last = (F.timestamp_micros(F.lit(v).cast("bigint")) for v in (span.first, span.last))
    # Captures accumulate in time order, so these literals prune files and row groups of
    # older and later captures before their content is read.
    if isinstance(responses, ResponseLog):
        # The index knows the files: the others are not opened.
        held = heads.join(needed, [heads.url == needed.url, heads.captured_at == needed.captured_at], "left_semi")
        responses = responses.read(row["file"] for row in held.select("file").distinct().collect())
    documents = responses.filter(
        F.col("error").isNull() & F.col("captured_at").between(first, last)
    )

    def fetch(wanted: DataFrame) -> DataFrame:
        return documents.join(wanted, ["url", "captured_at"]).select("url", "content_type", "content", "day")

    fetched = fetch(needed.filter(~F.col("several")))
    if span.several:
        # Only URLs with several captures can have copies of one; only those are grouped.
        one = F.min_by(F.struct("content_type", "content"), F.struct("content_type", F.sha2("content", 256)))
        copies = fetch(needed.filter("several")).groupBy("url").agg(one.alias("one"), F.min("day").alias("day")).select("url", "one.*", "day")
        fetched = fetched.unionByName(copies)
    typed = fetched.select(
        F.col("url").alias("blob_id"),
        file_type(F.col("content_type")).alias("file_type"),
        F.coalesce("content", F.lit(b"")).alias("content"),
        "day",
    )
    hashed = typed.withColumn("hashed", checked_hash(F.col("content"), F.col("file_type"), run.max_bytes))
    stored = hashed.withColumns(
        {
            "file_hash": F.col("hashed.value"),
            "error": F.col("hashed.error"),
            "content_type": mime_type(F.col("file_type")),
            "length": F.octet_length("content").cast("bigint"),
            "content": F.when(F.col("hashed.error").isNull(), F.col("content")),
        }
    )
    return lake.write_blobs(stored, LANDING, run.version)


def _records(arrivals: DataFrame, blobs: DataFrame) -> DataFrame:
    """Metadata records of the processed arrivals with their file fields."""
    files = blobs.select(F.col("blob_id").alias("_blob"), "file_type", "file_hash", "length", "day", F.col("error").alias("_why"))
    processed = arrivals.filter(F.col("outcome").isin("landed", "failed", "no_url"))
    landed = F.col("outcome") == "landed"
    link = spread_nulls(F.when(landed, F.col("doc_url")), "identifier", *ARRIVAL_ORDER)
    return (
        processed.withColumn("_link", link)
        .join(files, F.col("_link") == F.col("_blob"), "left")
        .filter(F.col("_why").isNull())
        .withColumn("file_type", F.when(F.col("outcome") == "failed", "unknown").otherwise(F.col("file_type")))
        .withColumns(
            {
                "file_path": F.when(
                    landed,
                    landing_key(F.col("body"), F.col("partition_date"), F.col("identifier"), F.col("file_type")),
                ),
                # An empty document keeps its path but is not an object.
                "blob_id": F.when(F.col("length") > 0, F.col("_blob")),
                "blob_day": F.when(F.col("length") > 0, F.col("day")),
            }
        )
        .drop("_blob", "_link", "length", "day", "_why")
    )


def _fold(records: DataFrame, stored: DataFrame, run: LandingRun) -> DataFrame:
    """Every arrival compared with the one before it."""
    if run.repair_failed:
        records = records.filter(F.col("outcome") == "landed")
    return fold_changes(records, stored)


def _decide(records: DataFrame, stored: DataFrame, run: LandingRun) -> DataFrame:
    """The record of each identifier that counts, with the action taken."""
    # After _skip_repeats an identifier has some failures and then at most one landed row.
    # Only its first row can change the metadata: what follows a failure is an insert
    # without effect.  The landed row still stores its document.
    order, landed = F.struct(*ARRIVAL_ORDER, "_page"), F.col("outcome") == "landed"
    row = F.struct(*[c for c in records.columns if c != "identifier"])
    picked = records.groupBy("identifier").agg(
        F.min_by(row, order).alias("first"),
        F.min_by(F.when(landed, row), F.when(landed, order)).alias("landed"),
    )
    lead = F.coalesce("landed", "first") if run.repair_failed else F.col("first")
    rows = (
        picked.select("identifier", F.array_distinct(F.array(lead, F.coalesce("landed", lead))).alias("rows"))
        .select("identifier", F.posexplode("rows").alias("_nth", "row"))
        .select("identifier", "_nth", "row.*")
    )
    classified = classify_changes(rows, stored, repair_failed=run.repair_failed).drop("stored_hash")
    action = F.when(F.col("_nth") > 0, "insert_noop").otherwise(F.col("action"))
    return classified.withColumn("action", action).drop("_nth")


def _mark_final(folded: DataFrame) -> DataFrame:
    """Of several applied rows per key only the last one stays an applied row in the log.

    A last row without a link keeps the file fields of the applied row before it
    (``carried``), if there is one in this run.
    """
    applied = folded.filter(F.col("action").isin("insert", "update"))
    final = last_applied(folded, ARRIVAL_ORDER).select("identifier", *ARRIVAL_ORDER, F.lit(True).alias("_final"))
    files = F.when(F.col("outcome") != "no_url", F.struct(*schemas.FILE_FIELDS))
    carried = applied.groupBy(F.col("identifier").alias("_id")).agg(
        F.max_by(files, F.when(files.isNotNull(), F.struct(*ARRIVAL_ORDER))).alias("carried")
    )
    marked = folded.join(final, ["identifier", *ARRIVAL_ORDER], "left").withColumn(
        "action",
        F.when(F.col("action").isin("insert", "update") & F.col("_final").isNull(), F.concat(F.lit("superseded "), "action"))
        .otherwise(F.col("action")),
    )
    no_link = F.when((F.col("outcome") == "no_url") & F.col("_final"), F.col("identifier"))
    key = spread_nulls(no_link, "identifier", *ARRIVAL_ORDER)
    return (
        marked.withColumn("_key", key).join(carried, F.col("_key") == F.col("_id"), "left").drop("_key", "_id", "_final")
    )


def _log_rows(decided: DataFrame, stored: DataFrame, run: LandingRun) -> DataFrame:
    """Log rows: applied changes, and uploads that changed no metadata."""
    rows = decided.filter(F.col("action").isin("insert", "update") | F.col("blob_id").isNotNull())
    if "carried" not in rows.columns:
        rows = rows.withColumn("carried", F.lit(None).cast(_FILES))
    # A record without a link carries no file fields: an update leaves the ones before it.
    no_link = F.col("outcome") == "no_url"
    key = spread_nulls(F.when(no_link, F.col("identifier")), "identifier", *ARRIVAL_ORDER)
    old = stored.select(F.col("identifier").alias("_id"), F.struct(*schemas.FILE_FIELDS).alias("_old"))
    before = F.coalesce("carried", "_old")
    kept = {c: F.when(no_link, before[c]).otherwise(F.col(c)) for c in schemas.FILE_FIELDS}
    return (
        rows.withColumn("_key", key)
        .join(old, F.col("_key") == F.col("_id"), "left")
        .withColumns({**kept, "updated_at": F.lit(run.run_ts), "arrived": F.col("captured_at")})
    )


def _outcomes(arrivals: DataFrame, pages: DataFrame, bad: DataFrame) -> DataFrame:
    """Outcome rows for the statistics: items, and result pages that failed.

    Items whose document cannot be read, and pages that cannot, are ``bad_item``.
    """
    day = F.col("partition_date").cast("date")
    link = F.when(F.col("outcome") == "landed", F.col("doc_url"))
    items = (
        arrivals.filter(F.col("outcome") != "pending")
        .withColumn("_link", spread_nulls(link, "identifier", *ARRIVAL_ORDER))
        .join(bad, F.col("_link") == F.col("_bad"), "left")
        .select(
            "body", day.alias("partition_start"), F.col("partition_end").cast("date").alias("partition_end"), "identifier",
            F.when(F.col("_why").isNotNull(), "bad_item").otherwise(F.col("outcome")).alias("outcome"),
            F.col("doc_url").alias("url"), F.coalesce("_why", "error").alias("error"),
        )
    )
    failed_pages = pages.filter(F.col("error").isNotNull() | F.col("parse_error").isNotNull()).select(
        *stats.PARTITION, F.lit(None).cast("string").alias("identifier"),
        F.when(F.col("error").isNotNull(), "request_failed").otherwise("bad_item").alias("outcome"), "url",
        F.coalesce("error", "parse_error").alias("error"),
    )
    return items.unionByName(failed_pages)


def _quarantined(outcomes: DataFrame) -> DataFrame:
    bad = outcomes.filter(F.col("outcome") == "bad_item")
    return bad.select("identifier", "url", "body", F.col("partition_start").cast("string").alias("partition_date"), "error")


def pending_documents(arrivals: DataFrame) -> DataFrame:
    """Document URLs that no captured response answers yet."""
    return arrivals.filter(F.col("outcome") == "pending").select(F.col("doc_url").alias("url")).distinct()


def write_reports(lake: Lake, result: LandingResult) -> None:
    """Run summaries and failure events of a run as JSON files."""
    reports = {
        "partition_summaries": result.summaries().drop("message"),
        "crawl_summary": result.summary().drop("message"),
        "failures": stats.failure_events(result.outcomes),
    }
    for name, rows in reports.items():
        rows.write.mode("overwrite").option("ignoreNullFields", "false").json(lake.path("reports", name, f"version={result.version}"))
