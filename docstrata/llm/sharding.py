"""Shards by proportional stratified interleaving.

Within each source the rows are shuffled by a seeded hash and ranked.  Row r of a source
with n rows stands at (r + u) / n, u being the source's own seeded offset in [0, 1), so
small sources do not all fall on one spot.  All rows are sorted by that fraction and the
sorted line is cut into equal pieces: every shard then has each source's share to within
one or two rows, and row counts differ by at most one.

Defined cases: a null source is a source of its own; a null text has size 1 and the
checksum of the empty text.  Rows with equal ids are ordered by their other columns'
hashes; rows equal in all columns are interchangeable.  An empty table gives no rows.
Extra columns are left out by ``assign`` and kept by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm.ranks import bucket_count, hash_fraction, hash_order, ranked
from docstrata.llm.storage import free_name, staged, workspace


def assign(docs: DataFrame, shards: int, *, seed: int = 17, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """doc_id, source, size, text_crc32, position, shard and slot of every row."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    content = F.coalesce(F.col(text), F.lit(""))
    folder = workspace(docs.sparkSession, "shards")
    rows = staged(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            (F.octet_length(content) + 1).cast("bigint").alias("size"), F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
            hash_order(seed, doc_id).alias("order"),
        ),
        f"{folder}/rows",
    )
    n = rows.count()
    buckets = bucket_count(rows, n)
    by_hash = F.floor(F.col("order") / F.lit(float(1 << 60)) * buckets)
    line = ranked(rows, ["source"], by_hash, ["order", "doc_id", "text_crc32", "size"], "rank").withColumn(
        "fraction", (F.col("rank") + hash_fraction(seed, "source")) / F.col("rank_of")
    )
    placed = ranked(line, [], F.floor(F.col("fraction") * buckets), ["fraction", hash_order(seed, "source"), "source"], "position")
    shard = F.expr(f"position * {shards} div position_of")
    first = F.expr(f"(shard * position_of + {shards} - 1) div {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "source", "size", "text_crc32", "position", F.col("shard").cast("int").alias("shard"), (F.col("position") - first).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int, *, key: str = "doc_id", **options) -> None:
    """Write all columns as one folder per shard; ``key`` must be unique and not null.

    A file holds a range of slots, so that no task gets a whole shard.
    """
    shard, slot = free_name(docs.columns, "shard"), free_name(docs.columns, "slot")
    places = staged(assign(docs, shards, doc_id=key, **options), f"{workspace(docs.sparkSession, 'shard-places')}/places")
    placed = docs.join(places.select(F.col("doc_id").alias(key), F.col("shard").alias(shard), F.col("slot").alias(slot)), key)
    placed.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.mode("overwrite").partitionBy(shard).parquet(path)
