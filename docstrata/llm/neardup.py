"""Near-duplicate documents by MinHash with tensored banding, verified on full shingle sets.

``m`` half keys are made from ``m * r`` minhashes for each of two hash collections; table
(i, j) has the pair of half key i of the first and j of the second collection as its key.
So ``2 * m * r`` minhashes serve ``m * m`` tables of band width ``2 * r``.  A pair of
likeness s is a candidate with probability ``(1 - (1 - s**r)**m)**2``; with m = 18 and
r = 3 that misses 1 pair in 10,000 at 0.75 and 1 in 100,000 at 0.8.

Steps, all on Spark:

1. one pass over the texts: shingle set, its digest (the *class*), its half keys;
2. documents of one class are linked by definition and go on as one row;
3. half keys that only one class has can give no common table key, so only the others are
   combined: documents without near copies cost ``2 * m`` rows, not ``m * m``;
4. in each table bucket every class is verified against the bucket's smallest class (a
   star, not all pairs), and links are contracted to components;
5. buckets still holding several components are finished exactly: the classes outside the
   family's largest component are a query set, compared in blocks with all members of the
   family.  No link between candidates is lost and no block exceeds ``block`` sets a side.

Defined cases: null or wordless text has an empty set, is linked with nothing, is its own
component.  A null doc_id counts as the largest id.  Rows that repeat a doc_id are rows of
that id: each gets its own set, and ``kept`` holds for all rows whose id is the component's.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm.storage import passing_workspaces, settings, staged, workspace
from docstrata.llm.words import mix, shingle_sets

WIDTH, HALVES, ROWS, BLOCK = 5, 18, 3, 512
_PASS_SHINGLES = 1 << 18
_BLOOM = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def half_keys(sets: list[np.ndarray], halves: int, rows: int) -> np.ndarray:
    """The ``2 * halves`` half keys of each nonempty set, as signed 64-bit integers."""
    sizes = np.array([len(s) for s in sets])
    flat, starts = np.concatenate(sets), np.cumsum(sizes) - sizes
    scratch = np.empty_like(flat)
    keys = np.empty((len(sets), 2 * halves), dtype=np.uint64)
    seeds = _seeds(2 * halves * rows)
    for half in range(2 * halves):
        key = np.full(len(sets), half + 1, dtype=np.uint64)
        for seed in seeds[half * rows : (half + 1) * rows]:
            np.multiply(flat, seed, out=scratch)
            key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + np.minimum.reduceat(scratch, starts))
        keys[:, half] = key
    return keys.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch], width: int, halves: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Class digest, set size and half keys beside the id and the text's key."""

    def emit(begin: int, sets: list[np.ndarray], batch: pa.RecordBatch) -> pa.RecordBatch:
        full = [i for i, s in enumerate(sets) if len(s)]
        offsets = np.zeros(len(sets) + 1, dtype=np.int32)
        flat = np.zeros(0, dtype=np.int64)
        if full:
            offsets[1:][full] = 2 * halves
            offsets, flat = np.cumsum(offsets, dtype=np.int32), half_keys([sets[i] for i in full], halves, rows).ravel()
        digests = [_digest(s) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).slice(begin, len(sets)), batch.column(1).slice(begin, len(sets)),
                pa.array(digests, pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            ],
            names=["doc_id", "text_key", "class", "n", "halves"],
        )

    for batch in batches:
        begin, held, sets = 0, 0, []
        for s in shingle_sets(batch.column(2), width):
            sets.append(s)
            held += len(s)
            if held >= _PASS_SHINGLES:
                yield emit(begin, sets, batch)
                begin, held, sets = begin + len(sets), 0, []
        if sets:
            yield emit(begin, sets, batch)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), width))
        rows = [(c, s) for c, s in found if _digest(s) == c]  # the join key is a hash
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([c for c, _ in rows], pa.binary()),
                pa.array([s.view(np.int64) for _, s in rows], pa.list_(pa.int64())),
            ],
            names=["class", "shingles"],
        )


def components(links: DataFrame, folder: str) -> DataFrame:
    """Connected components of (a, b) rows as (node, component), by large and small stars.

    The least node names a component.  Each step is a grouped minimum and a join, both safe
    for a hub with most of the links; every step is a written table.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{folder}/0")

    def mark(frame: DataFrame) -> tuple:
        row = frame.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    step, before, after = 0, None, mark(edges)
    while before != after:
        step, before = step + 1, after
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(large.where("a <> b").distinct(), f"{folder}/{step}a")
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = staged(small.where("a <> b").distinct(), f"{folder}/{step}b")
        after = mark(edges)
    heads = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads)


def _alike(common, n_a, n_b):
    return 100 * common >= 75 * (n_a + n_b - common)


def _compare_blocks(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Links between the queries and the members of one block pair of a family.

    Members' shingles are sorted once; a query finds its common shingles with all members
    by one search and one count.
    """
    queries, members = group[group["query"]], group[~group["query"]]
    if queries.empty or members.empty:
        return pd.DataFrame({"a": [], "b": []})
    sets = list(members["shingles"])
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    component = members["component"].to_numpy()
    ids, out = members["class"].to_numpy(), []
    for one, comp, s in zip(queries["class"], queries["component"], queries["shingles"]):
        s = np.asarray(s)
        low, high = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
        width = high - low
        total = int(width.sum())
        if not total:
            continue
        spots = np.repeat(low - (np.cumsum(width) - width), width) + np.arange(total)
        common = np.bincount(owner[spots], minlength=len(sets))
        for k in np.flatnonzero(_alike(common, len(s), sizes)):
            if component[k] != comp:
                out.append((one, ids[k]))
    return pd.DataFrame(out, columns=["a", "b"])


def near_duplicates(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, halves: int = HALVES, rows: int = ROWS, block: int = BLOCK
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs``."""
    spark = docs.sparkSession
    folder = workspace(spark, "neardup")
    id_type = docs.schema[doc_id].dataType.simpleString()
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    signed = staged(
        plain.mapInArrow(
            partial(_signed, width=width, halves=halves, rows=rows),
            f"doc_id {id_type}, text_key bigint, class binary, n bigint, halves array<bigint>",
        ),
        f"{folder}/signed",
    )
    classes = staged(
        signed.where("n > 0").groupBy("class").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "text_key")).alias("first"),
            F.first("n").alias("n"), F.first("halves").alias("halves"),
        ).select("class", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("text_key"), "n", "halves"),
        f"{folder}/classes",
    )

    # Half keys that several classes have, and the table keys that these make.
    half_rows = classes.select("class", F.posexplode("halves").alias("slot", "half"))
    shared = staged(half_rows.groupBy("half").agg(F.count("*").alias("k")).where("k > 1").select("half"), f"{folder}/halves")
    kept_halves = half_rows.join(shared, "half").groupBy("class").agg(
        F.collect_list(F.when(F.col("slot") < halves, F.col("half"))).alias("u"),
        F.collect_list(F.when(F.col("slot") >= halves, F.col("half"))).alias("v"),
    )
    table_rows = staged(
        kept_halves.where("size(u) > 0 and size(v) > 0").select("class", F.explode("u").alias("u"), "v")
        .select("class", "u", F.explode("v").alias("v")).select("class", "u", F.xxhash64("u", "v").alias("key")),
        f"{folder}/tables",
    )
    stars = staged(
        table_rows.groupBy("key").agg(F.count("*").alias("members"), F.min("class").alias("least")).where("members > 1"), f"{folder}/stars"
    )
    bucketed = staged(table_rows.join(stars, "key").select("class", "u", "key", "members", "least"), f"{folder}/buckets")

    # Shingle sets of the classes that have candidates, from the text of one document each.
    # A Bloom filter on the join key keeps the texts of all others out of the shuffle.
    wanted = staged(
        bucketed.select("class").distinct().join(classes.drop("halves"), "class").select("class", "n", F.xxhash64("text_key", "first_id").alias("pick")), f"{folder}/wanted"
    )
    found = plain.select("text", F.xxhash64("text_key", "doc_id").alias("pick")).join(wanted.where("n > 0"), "pick").select("class", "text")
    with settings(spark, _BLOOM):
        # Rows that repeat both id and text would give a set twice.
        sets = staged(found.mapInArrow(partial(_sets, width=width), "class binary, shingles array<bigint>").dropDuplicates(["class"]), f"{folder}/sets")

    sizes = wanted.select("class", "n")
    pairs = staged(
        bucketed.where("class <> least").select(F.col("class").alias("a"), F.col("least").alias("b")).distinct()
        .join(sizes.select(F.col("class").alias("a"), F.col("n").alias("n_a")), "a")
        .join(sizes.select(F.col("class").alias("b"), F.col("n").alias("n_b")), "b")
        .where("100 * least(n_a, n_b) >= 75 * greatest(n_a, n_b)"),
        f"{folder}/pairs",
    )
    common = F.size(F.array_intersect("s_a", "s_b")).cast("bigint")
    links = staged(
        pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("s_a")), "a")
        .join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("s_b")), "b")
        .where(_alike(common, F.col("n_a"), F.col("n_b"))).select("a", "b"),
        f"{folder}/links",
    )
    first = staged(components(links, f"{folder}/first"), f"{folder}/first/result")

    # Buckets of three or more classes in several components; their families by first half key.
    labelled = bucketed.where("members > 2").join(first.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    family = staged(
        labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
        .join(labelled, "key").select("u", "class", "component").distinct(),
        f"{folder}/family",
    )
    bulk = family.groupBy("u", "component").agg(F.count("*").alias("k")).groupBy("u").agg(
        F.max(F.struct("k", "component")).alias("top"), F.sum("k").alias("members")
    ).select("u", F.col("top.component").alias("bulk"), (F.col("members") - F.col("top.k")).alias("queries"), "members")
    spread = lambda n: F.pmod(F.xxhash64("class"), F.ceil(F.col(n) / block))
    blocks_of = lambda n: F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col(n) / block) - 1)
    placed = family.join(staged(bulk, f"{folder}/bulk"), "u")
    asked = placed.where("component <> bulk").select("u", "class", "component", F.lit(True).alias("query"), spread("queries").alias("q"), F.explode(blocks_of("members")).alias("t"))
    told = placed.select("u", "class", "component", F.lit(False).alias("query"), F.explode(blocks_of("queries")).alias("q"), spread("members").alias("t"))
    late = (
        asked.unionByName(told.select(*asked.columns)).join(sets, "class")
        .groupBy("u", "q", "t").applyInPandas(_compare_blocks, "a binary, b binary").distinct()
    )
    found_late = staged(late, f"{folder}/late")
    final = components(links.unionByName(found_late), f"{folder}/final")

    members = classes.select("class", "first_id").join(final.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    heads = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = staged(members.join(heads, "component").select("class", "component_id"), f"{folder}/named")
    result = signed.select("doc_id", "class", F.col("n").alias("n_shingles")).join(named, "class", "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def distinct_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row, with all columns, for each near-duplicate group of ``docs``.

    It is a row of the group's smallest id; of several, the one with the least text.
    """
    folder = workspace(docs.sparkSession, "distinct")
    with passing_workspaces(docs.sparkSession):  # nothing of the search is needed once the names are written
        kept = near_duplicates(docs, doc_id=doc_id, text=text, **options).where("kept").groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("n_shingles").alias("n"))
        names = staged(kept.select("doc_id", ((F.col("rows") > 1) & (F.col("n") > 0)).alias("repeated")), f"{folder}/kept").alias("k")
    # The document goes through as one column, so its names meet no others.
    rows = docs.select(F.col(doc_id).alias("id"), F.struct(*docs.columns).alias("row")).alias("d")
    found = rows.join(names, F.col("d.id").eqNullSafe(F.col("k.doc_id"))).select("id", "row", "repeated")
    # Rows that repeat an id with texts: the least text, by a grouped minimum.
    own = F.col(f"row.{_quoted(text)}")
    least = F.min(F.struct(own.isNull().alias("none"), own.alias("text"), F.xxhash64("row").alias("hash"), "row")).alias("least")
    again = found.where("repeated").groupBy("id").agg(least).select("least.row")
    return found.where("not repeated").select("row").unionByName(again).select("row.*")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
