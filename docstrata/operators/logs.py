"""Log analytics over line tables (batch or streaming)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata import schemas
from docstrata.functions.logs import (
    RUN_COUNTERS, format_summary, json_object, level_and_message, route_level, should_show,
)
from docstrata.functions.text import strip


def parse_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``level`` and ``message`` to log lines; both null when unparsable.

    The one-element ``inline`` keeps the parse a step of its own: as plain columns it
    would be repeated in every later filter and projection.
    """
    text, obj = F.col("_text"), F.col("_obj")
    return (
        lines.withColumn("_text", strip(F.col(value_col)))
        .withColumn("_obj", json_object(text))
        .select(*lines.columns, F.inline(F.array(level_and_message(text, obj))))
    )


def shown_lines(parsed: DataFrame, keywords: Sequence[str], format_messages: bool = False) -> DataFrame:
    """Lines with a message that matches a keyword, with level default and channel."""
    kept = parsed.filter((F.col("message") != "") & should_show(F.col("message"), keywords))
    level = F.coalesce("level", F.lit("INFO"))
    out = kept.withColumns({"level": level, "channel": route_level(level)})
    return out.withColumn("message", format_summary(F.col("message"))) if format_messages else out


def level_counts(parsed: DataFrame) -> DataFrame:
    """Messages per channel."""
    return (
        parsed.filter(F.col("message") != "")
        .groupBy(route_level(F.col("level")).alias("channel"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


def run_stats(lines: DataFrame, order: Sequence[str], run_col: str = "file") -> DataFrame:
    """Closing counters of each run: first match per counter, null when it never occurs.

    Works line by line, so the size of a single log does not matter.
    """
    found = lines.select(
        run_col, *order,
        *[F.nullif(F.regexp_extract("value", p, 1), F.lit("")).alias(k) for k, p in RUN_COUNTERS.items()],
    )
    position = F.struct(*order)
    return found.groupBy(run_col).agg(
        *[F.min_by(F.col(k), F.when(F.col(k).isNotNull(), position)).alias(k) for k in RUN_COUNTERS]
    )


def _json_part(message: str):
    col = F.col(message)
    return F.when(F.instr(col, "{") > 0, F.substring(col, F.instr(col, "{"), F.length(col)))


def partition_history(messages: DataFrame, message_col: str = "message") -> DataFrame:
    """Partition summaries found in messages, back as typed rows."""
    parsed = messages.filter(F.contains(F.col(message_col), F.lit("Partition summary"))).withColumn(
        "_summary", F.from_json(_json_part(message_col), schemas.PARTITION_SUMMARY)
    )
    return parsed.filter(F.col("_summary.body").isNotNull()).select(*messages.columns, "_summary.*")


def partition_failures(history: DataFrame) -> DataFrame:
    """One row per failure of ``partition_history`` rows, of all chunks of a partition.

    A partition without failures keeps one row with null ``url`` and ``error``.
    """
    first_chunk = F.coalesce("chunk", F.lit(0)) == 0
    return history.filter(first_chunk | (F.size("failed_urls") > 0)).select(
        "body", "partition_start", "partition_end", "total_results", "records_scraped", "records_skipped", "records_failed",
        F.inline_outer("failed_urls"),
    )


def run_history(messages: DataFrame, message_col: str = "message") -> DataFrame:
    """Crawl summaries found in messages, back as typed rows."""
    parsed = messages.filter(F.contains(F.col(message_col), F.lit("Crawl summary"))).withColumn(
        "_summary", F.from_json(_json_part(message_col), schemas.CRAWL_SUMMARY)
    )
    return parsed.filter(F.col("_summary.event").isNotNull()).select(*messages.columns, "_summary.*")
