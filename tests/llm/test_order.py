"""Shards, fingerprints, mixes and their shared ordering helpers."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docstrata.llm import fingerprints as fp
from docstrata.llm import mixing, sharding
from docstrata.llm.ranks import Ranges, key_ranges
from docstrata.llm.storage import workspace

SCHEMA = "doc_id bigint, text string, source string, position int, shard string, _bucket int"


def rows_of(n):
    rows = []
    for i in range(n):
        source = None if i % 11 == 0 else f"s{i % 5 if i % 3 else 0}"
        text = None if i % 17 == 0 else "" if i % 19 == 0 else " ".join(f"w{(i * k) % 23}é" for k in range(i % 37 + 1))
        rows.append((i * 7 % n, text, source, 1, "x", 2))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(230), SCHEMA).repartition(3).cache()


def test_shards_follow_the_mixture(docs):
    rows = sharding.assign(docs, 7).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r)
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    assert sorted(by_shard) == list(range(7)) and len(rows) == 230
    sizes = [len(x) for x in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    whole = Counter(sources.values())
    for part in by_shard.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
        for source, n in Counter(sources[r["doc_id"]] for r in part).items():
            assert abs(n - whole[source] / 7) < 2
    assert sorted(rows) == sorted(sharding.assign(docs.repartition(5), 7).collect())
    assert sorted(rows) != sorted(sharding.assign(docs, 7, seed=3).collect())


def test_shards_of_repeated_and_no_rows(spark):
    same = spark.createDataFrame([(None, "t", None, 1, "x", 2)] * 10, SCHEMA)
    assert sorted((r["shard"], r["slot"]) for r in sharding.assign(same, 4).collect()) == sorted((p * 4 // 10, p - -(-(p * 4 // 10) * 10 // 4)) for p in range(10))
    assert sharding.assign(same.limit(0), 4).collect() == []
    with pytest.raises(ValueError):
        sharding.assign(same, 0)


def test_written_shards_hold_all_columns(docs, spark):
    path = workspace(spark, "shards-test")
    sharding.write_shards(docs, path, 3)
    back = spark.read.parquet(path)
    assert back.count() == 230 and {"shard", "position", "_bucket"} <= set(back.columns)
    assert max(n for _, n in Counter(r["_shard"] for r in back.select("_shard").collect()).items()) == 77


def brute_sketch(text):
    points = [ord(c) for c in text]
    width = min(len(points), fp.SHINGLE)
    if not width:
        return set()
    mask, out = (1 << 64) - 1, set()
    for i in range(len(points) - width + 1):
        x = len(points) if len(points) < fp.SHINGLE else 0
        for p in points[i : i + width]:
            x = (x * 0x9E3779B97F4A7C15 + p) & mask
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & mask
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & mask
        out.add((x ^ x >> 31) >> 24)
    low = {h for h in out if h < (1 << 40) // fp.SCALE}
    return low or {min(out)}


def test_fingerprints_match_brute_force_over_many_ranges(docs):
    ordered = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    for size in (1 << 20, 200):
        got = {r["doc_id"]: r for r in fp.fingerprints(docs, chunk_bytes=size).collect()}
        assert len(got) == 230
        for k, (doc_id, text) in enumerate(ordered):
            following = ordered[(k + 1) % len(ordered)][1]
            edited, row = fp.edit(text, following), got[doc_id]
            assert edited == text[: len(text) - len(text) // 4] + following[: len(text) // 4]
            assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            a, b, c = brute_sketch(text), brute_sketch(edited), brute_sketch(following)
            assert set(fp.from_string(row["fingerprint"]).tolist()) == a and set(fp.from_string(row["edited_fingerprint"]).tolist()) == b
            assert row["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
            assert row["near_next"] == pytest.approx(len(a & c) / len(a | c) if a | c else 1.0)


def test_fingerprint_edge_cases(spark):
    one = spark.createDataFrame([(5, "abc def ghi jkl", None, 1, "x", 2)], SCHEMA)
    row = fp.fingerprints(one).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"abc def ghi abc").hexdigest()
    nulls = spark.createDataFrame([(None, "x" * 40, None, 1, "", 2), (3, None, None, 1, "", 2), (3, "b" * 40, None, 1, "", 2)], SCHEMA)
    got = {(r["doc_id"], r["n_chars"]): r["edited_sha256"] for r in fp.fingerprints(nulls).collect()}
    assert got[(None, 40)] == hashlib.sha256(b"x" * 30).hexdigest()  # the last row's next is the first, whose text is null
    assert got[(3, 40)] == hashlib.sha256(b"b" * 30 + b"x" * 10).hexdigest()
    all_null = spark.createDataFrame([(None, "x" * 8, None, 1, "", 2)] * 3, SCHEMA)
    assert [r["near_next"] for r in fp.fingerprints(all_null).collect()] == [1.0] * 3
    assert fp.fingerprints(one.limit(0)).collect() == []


def test_sketches_merge_and_contain():
    small, large = "the quick brown fox jumps over the lazy dog " * 3, "".join(map(chr, np.random.default_rng(0).integers(97, 123, 5000)))
    a, b, both = fp.sketch(small), fp.sketch(large), fp.sketch(small + large)
    merged = fp.merge(a, b)
    assert len(np.setdiff1d(merged, both)) == 0 and len(both) - len(merged) < 8
    assert fp.containment(a, merged) == 1.0 and fp.likeness(a, merged) < 0.3


def test_ranges_find_keys(spark):
    heads = [2, 5, 6, 40, 41, 99]
    keys = spark.createDataFrame([(k,) for k in (None, 1, 2, 4, 5, 6, 7, 40, 41, 98, 99, 1000)], "k bigint")
    got = [r["r"] for r in keys.select(Ranges(heads).of("k").alias("r")).collect()]
    assert got == [5, 0, 0, 0, 1, 2, 2, 3, 4, 4, 5, 5]
    found = key_ranges(spark.range(1000).withColumn("t", F.lit("x" * 100)), "id", "t", 5000)
    assert found.heads[0] == 0 and found.count >= 20


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, budget, free = {}, share * sum(sizes.values()), set(names)
    while free:
        level = (budget - sum(most * sizes[s] for s in names if s not in free)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            break
        free -= over
    return {s: weight[s] * level if s in free else float(most * sizes[s]) for s in names}


@pytest.mark.parametrize("sizes", [{"b": 100, "a": 5, None: 40}, {"a": 1}, {f"s{i}": (i * i) % 97 for i in range(23)}, {"x": 0, "y": 9}])
def test_targets_match_a_filling_loop(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_meets_targets(docs):
    rows = mixing.mix(docs).collect()
    sizes = {r["doc_id"]: len((r["text"] or "").split()) for r in docs.collect()}
    assert len(rows) == 230 and all(r["size"] == sizes[r["doc_id"]] and r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2 for r in rows)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 3
        got = sum(r["rate"] * r["size"] for r in own)
        assert got == pytest.approx(own[0]["target"], rel=1e-4)
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(4)).collect())


def test_mixed_documents_repeat_rows(docs, spark):
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({k: n for k, n in copies.items() if n})
    same = spark.createDataFrame([(1, "a b c", "s", 1, "x", 2)] * 7, SCHEMA)
    assert mixing.mixed_documents(same).count() in (10, 11)
    assert mixing.mixed_documents(same.limit(0)).collect() == []
