"""Known-row skipping, deduplication, change classification and zone comparison.

Keys are assumed to be skewed: one identifier may hold a third of all rows.  So
per-key "first" and "last" are aggregates with map-side combining, never a window over
the whole key, and the one operator that needs neighbours in order (``previous_value``)
spreads a key over range partitions first.  Lookups are plain equi-joins: AQE splits a
hot key on the probe side when the other side is a table scan (an aggregate directly
below the join would prevent that, so the jobs write such sides first), and
``spread_nulls`` keeps rows without a key from meeting in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ARRIVAL_ORDER = ("captured_at", "partition_date", "body", "page_number", "pos")


def skip_known(rows: DataFrame, known: DataFrame, key: str = "identifier") -> DataFrame:
    """Rows whose key is not known yet."""
    return rows.join(known.select(key), key, "left_anti")


def skipped_known(rows: DataFrame, known: DataFrame, key: str = "identifier") -> DataFrame:
    """Rows whose key is known already."""
    return rows.join(known.select(key), key, "left_semi")


def spread_nulls(key: Column, *others: str) -> Column:
    """Join key that gives rows without one distinct values which match nothing.

    Null keys would all hash to the same task.
    """
    return F.coalesce(key, F.concat(F.lit("\0"), F.xxhash64(*others).cast("string")))


def flag_known(rows: DataFrame, known: DataFrame, key: str = "identifier", unique: bool = False) -> DataFrame:
    """All rows plus ``is_known``, in one pass; feeds the statistics.

    ``unique`` says that ``known`` holds each key once.
    """
    keys = known.select(key) if unique else known.select(key).distinct()
    keys = keys.withColumn("is_known", F.lit(True))
    return rows.join(keys, key, "left").withColumn("is_known", F.coalesce("is_known", F.lit(False)))


def first_per_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given total order."""
    return _extreme_per_key(rows, key, order, F.min_by)


def last_per_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key in the given total order."""
    return _extreme_per_key(rows, key, order, F.max_by)


def _extreme_per_key(rows: DataFrame, key: str, order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    best = pick(F.struct(*rest), F.struct(*order)).alias("best")
    return rows.groupBy(key).agg(best).select(key, "best.*").select(*rows.columns)


def change_action(has_stored: Column, stored_hash: Column, new_hash: Column) -> Column:
    """Landing decision for one row against the stored hash of its key.

    A stored null hash means "insert", which does nothing on an existing row
    (``insert_noop``); a null new hash over a stored one is an update.
    """
    return (
        F.when(~has_stored, "insert")
        .when(stored_hash.isNull(), "insert_noop")
        .when(stored_hash.eqNullSafe(new_hash), "skip")
        .otherwise("update")
    )


def repair_action(has_stored: Column, stored_hash: Column, new_hash: Column) -> Column:
    """Alternative decision that heals failed rows.

    A hash replaces a stored null, and a failed download never replaces a good row.
    """
    return (
        F.when(~has_stored, "insert")
        .when(new_hash.isNull() | stored_hash.eqNullSafe(new_hash), "skip")
        .otherwise("update")
    )


def classify_changes(
    rows: DataFrame, stored: DataFrame, key: str = "identifier", hash_col: str = "file_hash",
    repair_failed: bool = False,
) -> DataFrame:
    """Adds ``stored_hash`` and ``action`` by comparing with the stored (key, hash) pairs.

    ``stored`` has one row per key.
    """
    prior = stored.select(key, F.col(hash_col).alias("stored_hash"), F.lit(True).alias("_stored"))
    decide = repair_action if repair_failed else change_action
    has_stored = F.coalesce(F.col("_stored"), F.lit(False))
    return (
        rows.join(prior, key, "left")
        .withColumn("action", decide(has_stored, F.col("stored_hash"), F.col(hash_col)))
        .drop("_stored")
    )


def previous_value(rows: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """``lag(value)`` per key in order, plus ``is_first``, without one task per key.

    Rows are range-partitioned by (key, order), which cuts a hot key into chunks.  Lag is
    taken inside each chunk; a second window over only the first and last row of each
    chunk connects the chunks.  That window holds at most two rows per chunk of a key.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunked = rows.repartitionByRange(parts, key, *order).withColumn("_chunk", F.spark_partition_id())
    inside = Window.partitionBy(key, "_chunk").orderBy(*order)
    at_start = F.lag(F.lit(True)).over(inside).isNull()
    at_end = F.lead(F.lit(True)).over(inside).isNull()
    marked = chunked.withColumns(
        {"_start": at_start, "_edge": at_start | at_end, "_inner": F.lag(value).over(inside)}
    )
    # Edge rows of a key meet in one group; the others stay in the group of their chunk.
    group = F.when(F.col("_edge"), F.lit(-1)).otherwise(F.col("_chunk"))
    edges = Window.partitionBy(key, "_group").orderBy(*order)
    return (
        marked.withColumn("_group", group)
        .withColumns({"_outer": F.lag(value).over(edges), "_nothing_before": F.lag(F.lit(True)).over(edges).isNull()})
        .withColumns(
            {
                "previous": F.when(F.col("_start"), F.col("_outer")).otherwise(F.col("_inner")),
                "is_first": F.col("_start") & F.col("_nothing_before"),
            }
        )
        .drop("_chunk", "_start", "_edge", "_inner", "_group", "_outer", "_nothing_before")
    )


def fold_changes(
    rows: DataFrame, stored: DataFrame | None, order: Sequence[str] = ARRIVAL_ORDER,
    key: str = "identifier", hash_col: str = "file_hash",
) -> DataFrame:
    """Decision for each of several rows per key that arrive in one run.

    Every row is compared with the one before it (the stored row for the first): after a
    null hash a row is an insert, which only takes effect on a new key; a different hash
    is an update; an equal one is skipped.  Adds ``action``.
    """
    order = list(order)
    incoming = rows.withColumn("_seq", F.lit(1))
    if stored is not None:
        # Only stored rows of keys that occur take part.
        keys = rows.select(key).distinct()
        prior = stored.join(keys, key, "left_semi").select(key, hash_col).withColumn("_seq", F.lit(0))
        incoming = incoming.unionByName(prior, allowMissingColumns=True)
    chained = previous_value(incoming, key, ["_seq", *order], hash_col)
    action = (
        F.when(F.col("is_first"), "insert")
        .when(F.col("previous").isNull(), "insert_noop")
        .when(F.col("previous").eqNullSafe(F.col(hash_col)), "skip")
        .otherwise("update")
    )
    return chained.withColumn("action", action).filter("_seq = 1").drop("_seq", "previous", "is_first")


def last_applied(folded: DataFrame, order: Sequence[str] = ARRIVAL_ORDER, key: str = "identifier") -> DataFrame:
    """The row that is left of each key after ``fold_changes``; keys without a change drop out."""
    return last_per_key(folded.filter(F.col("action").isin("insert", "update")), key, order)


def upsert_action(has_stored: Column, stored_hash: Column, new_hash: Column) -> Column:
    """Transformed-zone decision: presence decides insert, the hash decides update."""
    return (
        F.when(~has_stored, "inserted")
        .when(stored_hash.eqNullSafe(new_hash), "skipped")
        .otherwise("updated")
    )


def classify_upserts(
    rows: DataFrame, stored: DataFrame, key: str = "identifier", hash_col: str = "file_hash"
) -> DataFrame:
    """Adds ``status`` (inserted / updated / skipped) against the stored transformed rows."""
    prior = stored.select(key, F.col(hash_col).alias("_stored_hash"), F.lit(True).alias("_stored"))
    has_stored = F.coalesce(F.col("_stored"), F.lit(False))
    return (
        rows.join(prior, key, "left")
        .withColumn("status", upsert_action(has_stored, F.col("_stored_hash"), F.col(hash_col)))
        .drop("_stored", "_stored_hash")
    )


def changed_sources(landing: DataFrame, transformed: DataFrame) -> DataFrame:
    """Landing rows whose source hash differs from the one already transformed.

    A null landing hash never matches, so such rows are always offered again.
    """
    done = transformed.select("identifier", F.col("original_file_hash").alias("file_hash"))
    return landing.join(done, ["identifier", "file_hash"], "left_anti")


def duplicate_keys(rows: DataFrame, key: str = "identifier") -> DataFrame:
    """Keys that occur more than once: the uniqueness check of both zones, and of names."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(rows: DataFrame, key: str = "identifier") -> DataFrame:
    """Return ``rows``; raise if a key occurs twice (runs one aggregation)."""
    if not duplicate_keys(rows, key).isEmpty():
        raise ValueError(f"duplicate values of {key}")
    return rows


def duplicate_content(rows: DataFrame, key: str = "identifier", hash_col: str = "file_hash") -> DataFrame:
    """Hashes shared by several keys, with the count and the smallest key."""
    return (
        rows.filter(F.col(hash_col).isNotNull())
        .groupBy(hash_col)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first_key"))
        .filter("n_rows > 1")
    )


def name_collisions(rows: DataFrame, path_col: str = "file_path") -> DataFrame:
    """Object names that different identifiers map to, with the number of identifiers."""
    named = rows.filter(F.col(path_col).isNotNull()).groupBy(path_col)
    return named.agg(F.count_distinct("identifier").alias("n_identifiers")).filter("n_identifiers > 1")


def blobs_missing(metadata: DataFrame, blob_keys: DataFrame) -> DataFrame:
    """Metadata rows whose path has no stored object."""
    return metadata.filter(F.col("file_path").isNotNull()).join(blob_keys.select("file_path"), "file_path", "left_anti")


def blobs_present(metadata: DataFrame, blob_keys: DataFrame) -> DataFrame:
    """Metadata rows whose object exists."""
    return metadata.join(blob_keys.select("file_path"), "file_path", "left_semi")


def reconcile_zones(landing: DataFrame, transformed: DataFrame, blob_keys: DataFrame) -> DataFrame:
    """One row per identifier of either zone with its state.

    no_path: landed without a file; missing_blob: path without an object; pending: not
    transformed yet; orphan: transformed without a landing row; ok: in both zones.
    """
    keys = blob_keys.select("file_path").distinct().withColumn("_blob", F.lit(True))
    left = (
        landing.select("identifier", F.col("file_path").alias("landing_path"))
        .withColumn("file_path", spread_nulls(F.col("landing_path"), "identifier"))
        .join(keys, "file_path", "left")
        .select("identifier", "landing_path", "_blob", F.lit(True).alias("_landed"))
    )
    right = transformed.select(
        "identifier", F.col("file_path").alias("transformed_path"), F.lit(True).alias("_transformed")
    )
    state = (
        F.when(F.col("_landed").isNull(), "orphan")
        .when(F.col("landing_path").isNull(), "no_path")
        .when(F.col("_blob").isNull(), "missing_blob")
        .when(F.col("_transformed").isNull(), "pending")
        .otherwise("ok")
    )
    return left.join(right, "identifier", "full_outer").select(
        "identifier", "landing_path", "transformed_path", state.alias("state")
    )
