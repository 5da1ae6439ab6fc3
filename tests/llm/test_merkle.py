"""The Merkle manifest against a plain tree, with odd tables and every fanout boundary."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from docstrata.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row) -> str:
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The root, and for each node the siblings before and after it, level by level."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + 16] for k in range(0, len(nodes), 16)]
        for way, k in zip(ways, at):
            run = runs[k // 16]
            way.append((run[: k % 16], run[k % 16 + 1 :]))
        at, nodes = [k // 16 for k in at], [H(*run) for run in runs]
    return nodes[0], ways


def brute_force(rows, tampered=lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0):
    sources: dict = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row, leaf_of(row)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    found = {}
    for s in order:
        members = sorted(sources[s], key=lambda x: (x[0][0] is None, x[0][0] or 0, x[1]))
        found[s] = (members, *tree([h for _, h in members]))
    root, ways = tree([found[s][1] for s in order])
    out = []
    for s, above in zip(order, ways):
        members, subroot, own = found[s]
        for (row, h), way in zip(members, own):
            way = way + above
            now = leaf_of((*row[:4], lowered(row[4]))) if tampered(row[0]) else h
            proof = H(*[x for pre, post in way for x in pre + post])
            for pre, post in way:
                now = H(*pre, now, *post)
            out.append((row[0], h, subroot, root, proof, now, now == root))
    return out


def run(spark, rows, schema=SCHEMA):
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    frame = spark.createDataFrame(rows, schema).repartition(3)
    got = merkle.manifest(frame, changed={"text": merkle.lower_ascii(F.col("text"))}, tampered=tampered)
    return got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()


def same(got, want):
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_every_level_and_boundary(spark):
    sizes = {"one": 1, "s15": 15, "s16": 16, "s17": 17, "s256": 256, "s257": 257, None: 40, "": 3, "é": 18, "Z": 2}
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i * 7 - 50, s, None if i % 3 else "en", i if i % 4 else None, None if i % 11 == 0 else f"Text ÄB {i} {'x' * (i % 50)}"))
            i += 1
    got = run(spark, rows)
    same(got, brute_force(rows))
    assert {r["verified"] for r in got} == {True, False}


def test_many_sources(spark):
    rows = [(k, f"s{k % 290}", "en", 3, f"T{k}") for k in range(400)]
    same(run(spark, rows), brute_force(rows))


def test_single_rows_and_repeats(spark):
    same(run(spark, [(5, "a", "en", 1, "A")]), brute_force([(5, "a", "en", 1, "A")]))
    rows = [(1, "a", "en", 1, "same")] * 60 + [(None, "a", None, None, None)] * 40 + [(1, "a", "en", 1, "Other")] * 20 + [(2, None, None, None, "")]
    same(run(spark, rows), brute_force(rows))


def test_empty_and_clashing_columns(spark):
    assert run(spark, [], SCHEMA) == []
    names = SCHEMA + ", g string, h0 string, h string, `rank` int, size int, up string, pre string, run long, now string, id long, row long, task int, line int"
    rows = [(k, "a", "en", 1, "T") for k in range(20)]
    got = run(spark, [(*r, "g", "h", "h", 1, 2, "u", "p", 3, "n", 4, 5, 6, 7) for r in rows], names)
    same(got, brute_force(rows))


def test_other_id_types(spark):
    rows = spark.createDataFrame([(f"d{k:02d}", "a", "en", 1, "T") for k in range(20)], "doc_id string, source string, lang string, n_chars int, text string")
    assert merkle.manifest(rows).where("verified").count() == 20


@pytest.mark.parametrize("text", ["A", "ÀB", None])
def test_lower_ascii(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(merkle.lower_ascii(F.col("t"))).first()[0] == lowered(text)
