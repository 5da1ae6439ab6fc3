"""Date text, date partitions and partition assignment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIZES = ("monthly", "weekly", "quarterly")


def format_search_date(d: Column) -> Column:
    """DD/MM/YYYY, the form search parameters use."""
    return F.date_format(d, "dd/MM/yyyy")


def iso_from_slashes(text: Column) -> Column:
    """Textual reorder of ``d/m/y`` to ``y-m-d``; no padding, no validation.

    Anything that does not have exactly three parts gives null.
    """
    parts = F.split(text, "/")
    return F.when(
        (text != "") & (F.size(parts) == 3),
        F.concat_ws("-", F.get(parts, 2), F.get(parts, 1), F.get(parts, 0)),
    )


def published_day(text: Column) -> Column:
    """Typed date of ``dd/MM/yyyy`` text, null when it is not a real day."""
    return F.try_to_date(text, "dd/MM/yyyy")


def date_partitions(start: Column, end: Column, size: str = "monthly") -> Column:
    """``array<struct<partition_start:date, partition_end:date>>`` covering [start, end].

    The first partition begins at ``start`` itself.  "quarterly" means the month of the
    partition's start plus two more months, "weekly" seven-day blocks anchored at
    ``start``; the last partition is clipped.  Empty when ``start > end``.
    """
    if size not in SIZES:
        raise ValueError(f"partition size {size!r} is none of {', '.join(SIZES)}")
    # sequence() would raise, or emit a wrong row, on a reversed range.
    last = F.greatest(start, end)
    if size == "weekly":
        starts = F.sequence(start, last, F.expr("interval 7 days"))
        full_end = lambda s: F.date_add(s, 6)
    else:
        months = 1 if size == "monthly" else 3
        starts = F.sequence(F.trunc(start, "MM"), last, F.expr(f"interval {months} months"))
        full_end = lambda s: F.date_sub(F.add_months(s, months), 1)
    spans = F.transform(
        starts,
        lambda s: F.struct(
            F.greatest(s, start).alias("partition_start"),
            F.least(full_end(s), end).alias("partition_end"),
        ),
    )
    return F.when(start <= end, spans).otherwise(F.filter(spans, lambda s: F.lit(False)))


def partition_start_of(day: Column, start: Column, size: str = "monthly") -> Column:
    """Start of the partition of a series anchored at ``start`` that holds ``day``.

    Plain arithmetic, so rows are assigned without a range join.
    """
    if size not in SIZES:
        raise ValueError(f"partition size {size!r} is none of {', '.join(SIZES)}")
    if size == "weekly":
        blocks = F.floor(F.datediff(day, start) / 7).cast("int")
        return F.date_add(start, blocks * 7)
    if size == "monthly":
        return F.greatest(F.trunc(day, "MM"), start)
    months = F.months_between(F.trunc(day, "MM"), F.trunc(start, "MM")).cast("int")
    return F.greatest(F.add_months(F.trunc(start, "MM"), (months - months % 3)), start)
