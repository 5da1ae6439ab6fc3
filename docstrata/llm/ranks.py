"""Ranks and running positions over a whole table without a window over a whole table.

Rows are dealt to buckets of bounded size by an even key; a bucket's rows are ranked in one
task and shifted by the counts of the buckets before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 50_000


def hash_order(seed: int, *keys: str | Column) -> Column:
    """A 60-bit number from a seed and keys, by MD5: the same on every engine and in every run.

    A null key differs from every value.
    """
    text = F.concat_ws("\x1f", F.lit(str(seed)), *[F.coalesce(F.concat(F.lit("="), (F.col(k) if isinstance(k, str) else k).cast("string")), F.lit("!")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def hash_fraction(seed: int, *keys: str | Column) -> Column:
    """``hash_order`` as a double in [0, 1)."""
    return F.shiftright(hash_order(seed, *keys), 8) / F.lit(float(1 << 52))


def bucket_count(frame: DataFrame, rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Enough buckets for bounded tasks and for all cores."""
    return max(4 * int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_bucket), 1)


def ranked(frame: DataFrame, groups: list[str], bucket: Column, order: list[str | Column], rank: str) -> DataFrame:
    """``frame`` with ``rank``: 0, 1, ... within ``groups`` by (bucket, order); ``{rank}_of`` has the group's size.

    ``bucket`` must not decrease along the order wanted.  Group keys may be null.
    """
    rows = frame.withColumn("_bucket", bucket)
    counts = rows.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    shifts = counts.select(
        *groups, "_bucket",
        (F.sum("_n").over(before.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")).alias("_shift"),
        F.sum("_n").over(before).alias(f"{rank}_of"),
    )
    keys = [*groups, "_bucket"]
    own = rows.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    right = shifts.select(*[F.col(k).alias(f"_r{k}") for k in keys], "_shift", f"{rank}_of")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_r{key}"))
    return own.join(right, same).withColumn(rank, F.col("_shift") + F.col("_place") - 1).drop("_bucket", "_shift", "_place", *[f"_r{k}" for k in keys])


@dataclass(frozen=True)
class Ranges:
    """Ranges of an ordered key: range k holds the keys from ``heads[k]`` to below the next head."""

    heads: list

    @property
    def count(self) -> int:
        return max(len(self.heads), 1)

    def of(self, key: str) -> Column:
        """The range of a key, by binary search; null keys come last."""
        if self.count == 1:
            return F.lit(0)
        n, heads, value = self.count, F.lit(self.heads), F.col(key)
        steps = F.lit([1 << k for k in reversed(range(n.bit_length()))])

        def step(low: Column, width: Column) -> Column:
            further = (low + width < n) & (F.get(heads, low + width) <= value)
            return F.when(further, low + width).otherwise(low)

        return F.when(value.isNull(), n - 1).otherwise(F.aggregate(steps, F.lit(0), step)).cast("int")


def key_ranges(frame: DataFrame, key: str, bytes_of: str, range_bytes: int, most: int = 20_000) -> Ranges:
    """Ranges of a numeric key with about ``range_bytes`` of ``bytes_of`` each, and enough for all cores.

    Their bounds are values of the key, so each range has a row.  One pass reads the key and
    the text's length; range partitioning would instead run all that stands below it twice.
    """
    total = frame.agg(F.sum(F.octet_length(bytes_of).cast("bigint")).alias("bytes"), F.min(key).alias("least")).first()
    if total["least"] is None:
        return Ranges([])
    n = min(max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), (total["bytes"] or 0) // range_bytes + 1), most)
    steps = [k / n for k in range(1, n)]
    bounds = frame.agg(F.percentile_approx(key, steps, 20 * n).alias("b")).first()["b"] if steps else []
    return Ranges([total["least"], *(b for b in sorted(set(bounds)) if b > total["least"])])
