"""Per-partition and per-run accounting.

Input is an outcome table: one row per listing item with ``outcome`` in
skipped / landed / failed / no_url / bad_item / request_failed, and ``url`` / ``error``
for the failed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTITION = ("body", "partition_start", "partition_end")
# A failed download counts as scraped and as failed.
SCRAPED = ("landed", "failed", "no_url")
FAILED = ("failed", "bad_item", "request_failed")


def _outcome_counts() -> list[Column]:
    outcome = F.col("outcome")
    return [
        F.count_if(outcome.isin(*SCRAPED)).alias("records_scraped"),
        F.count_if(outcome == "skipped").alias("records_skipped"),
        F.count_if(outcome.isin(*FAILED)).alias("records_failed"),
    ]


def page_totals(pages: DataFrame) -> DataFrame:
    """Result count of each partition, from its first page only, and its captured pages."""
    first_page = F.when(F.col("page_number") == 1, F.col("page_total"))
    return pages.groupBy(*PARTITION).agg(
        F.max(first_page).alias("total_results"),
        F.count_if(F.col("error").isNull()).alias("pages_captured"),
    )


def partition_stats(frontier_rows: DataFrame, pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Counters of every partition of the frontier; partitions without items show zeros."""
    counted = outcomes.groupBy(*PARTITION).agg(*_outcome_counts())
    base = frontier_rows.select(*PARTITION).distinct()
    joined = base.join(page_totals(pages), list(PARTITION), "left").join(counted, list(PARTITION), "left")
    counters = ["total_results", "records_scraped", "records_skipped", "records_failed", "pages_captured"]
    return joined.select(
        *PARTITION, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counters]
    )


def completeness(stats: DataFrame) -> DataFrame:
    """Adds ``missing_results``: announced but neither scraped nor skipped."""
    seen = F.col("records_scraped") + F.col("records_skipped")
    return stats.withColumn("missing_results", F.col("total_results") - seen)


def failed_urls(outcomes: DataFrame) -> DataFrame:
    """Every failure as a row; this is the complete list."""
    return outcomes.filter(F.col("outcome").isin(*FAILED)).select(*PARTITION, "url", "error")


def first_failed_urls(outcomes: DataFrame, limit: int = 3) -> DataFrame:
    """The first ``limit`` failures of each partition as an array, by (url, error).

    The rank filter is applied before the shuffle too (window group limit), so a
    partition with very many failures sends only ``limit`` rows per task.
    """
    ranked = failed_urls(outcomes).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*PARTITION).orderBy("url", "error"))
    )
    return (
        ranked.filter(F.col("_rank") <= limit)
        .groupBy(*PARTITION)
        .agg(F.sort_array(F.collect_list(F.struct("url", "error"))).alias("failed_urls"))
    )


def partition_summaries(stats: DataFrame, outcomes: DataFrame, chunk_rows: int = 1000) -> DataFrame:
    """Partition statistics with all of their failures and the JSON summary message.

    A partition with more than ``chunk_rows`` failures has several rows, numbered by
    ``chunk``, so that no row grows without bound: each repeats the counters and holds the
    failures that hash to it.  A partition without failures has one.
    """
    counted = stats.withColumn("chunks", F.greatest(F.ceil(F.col("records_failed") / chunk_rows), F.lit(1)))
    chunks = counted.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk"))
    number = F.pmod(F.xxhash64("url", "error"), F.col("chunks"))
    failures = (
        failed_urls(outcomes).join(counted.select(*PARTITION, "chunks"), list(PARTITION))
        .groupBy(*PARTITION, number.alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("url", "error"))).alias("failed_urls"))
    )
    return _with_message(chunks.join(failures, [*PARTITION, "chunk"], "left"), ["chunk", "chunks"])


def partition_messages(stats: DataFrame, outcomes: DataFrame, shown: int = 3) -> DataFrame:
    """Partition statistics with the first failures only, for display; store ``partition_summaries``."""
    return _with_message(stats.join(first_failed_urls(outcomes, shown), list(PARTITION), "left"), [])


def _with_message(rows: DataFrame, more: list[str]) -> DataFrame:
    no_failures = F.array().cast("array<struct<url:string,error:string>>")
    full = rows.withColumn("failed_urls", F.coalesce("failed_urls", no_failures))
    fields = [
        "body", _iso("partition_start"), _iso("partition_end"), "total_results", "records_scraped",
        "records_skipped", "records_failed", "failed_urls", *more,
    ]
    return full.withColumn("message", F.concat(F.lit("Partition summary: "), _json(*fields)))


def _json(*fields) -> Column:
    """Fields as JSON text; null fields are written as null."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _iso(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def crawl_summary(stats: DataFrame, reason: str = "finished") -> DataFrame:
    """Totals over all partitions, one row, with the JSON summary message."""
    totals = stats.agg(
        *[
            F.coalesce(F.sum(source), F.lit(0)).alias(target)
            for source, target in (
                ("total_results", "total_expected"),
                ("records_scraped", "total_scraped"),
                ("records_skipped", "total_skipped"),
                ("records_failed", "total_failed"),
            )
        ],
        F.count(F.lit(1)).alias("partitions_processed"),
    )
    row = totals.select(F.lit("crawl_complete").alias("event"), F.lit(reason).alias("reason"), "*")
    return row.withColumn("message", F.concat(F.lit("Crawl summary: "), _json(*row.columns)))


def rollup_stats(stats: DataFrame) -> DataFrame:
    """Per partition, per body and grand total in one pass (nulls mark the totals)."""
    return stats.rollup("body", "partition_start").agg(
        *[F.sum(c).alias(c) for c in ("total_results", "records_scraped", "records_skipped", "records_failed")],
        F.count(F.lit(1)).alias("partitions"),
    )


def transform_counts(statuses: DataFrame) -> DataFrame:
    """inserted / updated / skipped / failed of a transform run; one status per row."""
    status = F.col("status")
    known = ("inserted", "updated", "skipped")
    return statuses.agg(
        *[F.count_if(status == s).alias(s) for s in known],
        F.count_if(~status.isin(*known)).alias("failed"),
    )


def sink_counts(actions: DataFrame) -> DataFrame:
    """inserted / updated / skipped of a landing run; inserts without effect count too."""
    # Changes that a later one of the same run replaced were made all the same.
    action = F.regexp_replace("action", "^superseded ", "")
    return actions.agg(
        F.count_if(action.isin("insert", "insert_noop")).alias("inserted"),
        F.count_if(action == "update").alias("updated"),
        F.count_if(action == "skip").alias("skipped"),
    )


def observed(rows: DataFrame, name: str) -> DataFrame:
    """Attach a row-count metric that is filled in by whatever action runs ``rows``."""
    return rows.observe(name, F.count(F.lit(1)).alias("rows"))


def failure_events(outcomes: DataFrame) -> DataFrame:
    """Failures as JSON log messages with the fields of a structured error record."""
    document = F.col("outcome") == "failed"
    event = F.when(document, "document_download_failed").otherwise("request_failed")
    common = [
        F.col("url"), F.col("error"), F.col("body"), F.col("partition_start").cast("string").alias("partition"),
    ]
    with_id = _json(event.alias("event"), F.coalesce("identifier", F.lit("unknown")).alias("identifier"), *common)
    without_id = _json(event.alias("event"), *common)
    text = F.when(document, F.concat(F.lit("Document download failed: "), with_id)).otherwise(
        F.concat(F.lit("Request failed: "), without_id)
    )
    return (
        outcomes.filter(F.col("outcome").isin("failed", "request_failed"))
        .select(*PARTITION, F.lit("ERROR").alias("level"), text.alias("message"))
    )
