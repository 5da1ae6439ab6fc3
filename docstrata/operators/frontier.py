"""Search frontier: date partitions x bodies, one request row each."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.functions.dates import date_partitions
from docstrata.functions.urls import search_url


def validate_range(start_date: str | None, end_date: str | None) -> tuple[date, date]:
    """Check the two range parameters of a job: present, real ISO dates, in order.

    Compare with ``isoformat()`` of the result, not with the text given: ISO has other forms.
    """
    days = {"start_date": start_date, "end_date": end_date}
    for name, value in days.items():
        if not value:
            raise ValueError(f"{name} is missing")
        try:
            days[name] = date.fromisoformat(value)
        except ValueError:
            raise ValueError(f"{name} is not a calendar day in the form YYYY-MM-DD: {value!r}") from None
    first, last = days.values()
    if last < first:
        raise ValueError(f"the range ends ({last}) before it starts ({first})")
    return first, last


def check_ranges(ranges: DataFrame) -> DataFrame:
    """The same checks for a table of ranges: typed columns plus ``range_error`` (null = good)."""
    start = F.try_to_date("start_date", "yyyy-MM-dd")
    end = F.try_to_date("end_date", "yyyy-MM-dd")
    missing = (F.coalesce("start_date", F.lit("")) == "") | (F.coalesce("end_date", F.lit("")) == "")
    return ranges.withColumns(
        {
            "range_start": start,
            "range_end": end,
            "range_error": F.when(missing, "missing date")
            .when(start.isNull(), "invalid start_date")
            .when(end.isNull(), "invalid end_date")
            .when(end < start, "end before start"),
        }
    )


def generate_partitions(ranges: DataFrame, size: str = "monthly") -> DataFrame:
    """One row per date partition of each ``range_start`` .. ``range_end`` row.

    Other columns of ``ranges`` are kept.
    """
    spans = date_partitions(F.col("range_start"), F.col("range_end"), size)
    keep = [c for c in ranges.columns if c not in ("range_start", "range_end")]
    return ranges.select(*keep, F.inline(spans))


def range_row(spark: SparkSession, start_date: str, end_date: str) -> DataFrame:
    """The requested range as a one-row DataFrame; validates it first."""
    start, end = validate_range(start_date, end_date)
    return spark.range(1).select(F.lit(start).alias("range_start"), F.lit(end).alias("range_end"))


def combinations(partitions: DataFrame, bodies: Mapping[str, str]) -> DataFrame:
    """Every body with every partition.

    The bodies are job parameters, so the product is an array literal per partition: no
    join and no shuffle.
    """
    listed = F.array(
        *[F.struct(F.lit(name).alias("body"), F.lit(value).alias("body_id")) for name, value in bodies.items()]
    )
    return partitions.select(*partitions.columns, F.inline(listed))


def with_requests(pairs: DataFrame, search_base: str) -> DataFrame:
    """Partition key and first-page URL of each (body, partition)."""
    start, end = F.col("partition_start"), F.col("partition_end")
    page = F.lit(1)
    return pairs.withColumns(
        {
            "partition_key": F.concat_ws("|", "body", F.date_format(start, "yyyy-MM-dd")),
            "page_number": page,
            "url": search_url(search_base, F.col("body_id"), start, end, page),
        }
    )


def frontier(ranges: DataFrame, bodies: Mapping[str, str], search_base: str, size: str = "monthly") -> DataFrame:
    """First-page search requests of every body and date partition of ``ranges``."""
    return with_requests(combinations(generate_partitions(ranges, size), bodies), search_base)


def unfinished(frontier_rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Frontier rows to run again: no statistics yet, or with failures.

    ``stats`` is the output of ``stats.partition_stats`` of the earlier run.
    """
    done = stats.filter((F.col("pages_captured") > 0) & (F.col("records_failed") == 0)).select(
        "body", F.to_date("partition_start").alias("partition_start")
    )
    return frontier_rows.join(done, ["body", "partition_start"], "left_anti")
