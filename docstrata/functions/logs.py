"""Log-line parsing and summary formatting as Column expressions (batch and streaming)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docstrata.functions.text import WHITESPACE_CLASS, strip

# Messages shown for the two kinds of run.
LANDING_KEYWORDS = [
    "Spider opened", "Spider closed", "Starting crawl", "Loaded", "Queueing:", "Found", "No results",
    "MongoDB pipeline ready", "MongoDB summary", "MinIO pipeline ready", "Partition summary",
    "Crawl summary", "Request failed", "Document download failed", "Crawled",
]
TRANSFORM_KEYWORDS = [
    "Starting transformation", "Found", "Preloaded", "Transformation complete", "Done", "ERROR", "Failed",
]
# Counters in a run's closing statistics dump.
RUN_COUNTERS = {
    "items": r"'item_scraped_count':\s*(\d+)",
    "elapsed": r"'elapsed_time_seconds':\s*([\d.]+)",
    "requests": r"'downloader/request_count':\s*(\d+)",
    "retries": r"'retry/count':\s*(\d+)",
    "errors": r"'log_count/ERROR':\s*(\d+)",
}

_TEXT_LINE = rf"\]{WHITESPACE_CLASS}+(INFO|ERROR|WARNING):{WHITESPACE_CLASS}+([^\n]+)$"
_JSON_OPTIONS = {"allowSingleQuotes": "false"}


def _field(obj: Column, key: str, default: str) -> Column:
    """Value of ``key``; the default applies to an absent key, not to a null value."""
    return F.when(F.map_contains_key(obj, key), F.element_at(obj, key)).otherwise(default)


def json_object(text: Column) -> Column:
    """A JSON object as map<string,string>; null for anything else, scalars included."""
    looks_like = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))
    return F.from_json(F.when(looks_like, text), "map<string,string>", _JSON_OPTIONS)


def level_and_message(text: Column, obj: Column) -> Column:
    """``struct<level, message>`` of a stripped line and its ``json_object``."""
    from_json = F.struct(
        _field(obj, "level", "INFO").alias("level"), _field(obj, "message", "").alias("message")
    )
    from_text = F.struct(
        F.nullif(F.regexp_extract(text, _TEXT_LINE, 1), F.lit("")).alias("level"),
        F.nullif(F.regexp_extract(text, _TEXT_LINE, 2), F.lit("")).alias("message"),
    )
    return F.when(obj.isNotNull(), from_json).otherwise(from_text)


def parse_log_line(line: Column) -> Column:
    """``struct<level, message>``: JSON object lines first, then ``] LEVEL: message`` text.

    Both fields are null when the line is neither.  ``operators.logs.parse_lines`` does
    the same for a table and evaluates each step once.
    """
    text = strip(line)
    return level_and_message(text, json_object(text))


def should_show(message: Column, keywords: Sequence[str]) -> Column:
    """Whether the message contains any of the keywords."""
    pattern = "|".join(re.sub(r"([^A-Za-z0-9 ])", r"\\\1", k) for k in keywords)
    return message.rlike(pattern)


def route_level(level: Column) -> Column:
    """error / warning / info channel of a level; unknown levels are info."""
    return F.when(level == "ERROR", "error").when(level == "WARNING", "warning").otherwise("info")


def format_summary(message: Column) -> Column:
    """Partition and crawl summaries as a readable line; other messages unchanged."""
    start = F.instr(message, "{")
    obj = json_object(F.when(start > 0, strip(F.substring(message, start, F.length(message)))))

    def show(key: str, default: str) -> Column:
        return F.coalesce(_field(obj, key, default), F.lit("None"))

    failures = F.from_json(F.element_at(obj, "failed_urls"), "array<map<string,string>>", _JSON_OPTIONS)
    failed_lines = F.transform(
        F.slice(F.coalesce(failures, F.array().cast("array<map<string,string>>")), 1, 3),
        lambda f: F.concat(
            F.lit("\n    FAILED: "),
            F.coalesce(_field(f, "url", "?"), F.lit("None")),
            F.lit(" — "),
            F.coalesce(_field(f, "error", "?"), F.lit("None")),
        ),
    )
    # The wording of the readable lines, here and below.
    counts = "found: %s, new: %s, skipped: %s, failed: %s"
    by_partition = F.concat(
        F.format_string(
            f"%s | %s to %s | {counts}",
            show("body", "?"), show("partition_start", "?"), show("partition_end", "?"),
            show("total_results", "0"), show("records_scraped", "0"),
            show("records_skipped", "0"), show("records_failed", "0"),
        ),
        F.array_join(failed_lines, ""),
    )
    by_run = F.format_string(
        f"Crawl complete | partitions: %s, {counts}",
        show("partitions_processed", "0"), show("total_expected", "0"), show("total_scraped", "0"),
        show("total_skipped", "0"), show("total_failed", "0"),
    )
    return (
        F.when(F.map_contains_key(obj, "body"), by_partition)
        .when(F.map_contains_key(obj, "event"), by_run)
        .otherwise(message)
    )
