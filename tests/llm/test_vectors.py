"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from docstrata.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, threshold=0.93):
    good = []
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.append(k)
    links = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], dtype=np.float32).astype(float) for k in (a, b))
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        ids = [rows[s][0] for s in seen]
        head = min((x for x in ids if x is not None), default=None)
        out.append((i, len(links[k]), head, i == head))
    return sorted(out, key=str)


def run(spark, rows, schema=SCHEMA, **options):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    return sorted((tuple(r) for r in vectors.near_vectors(frame, **options).collect()), key=str)


def planted(n, d, seed, labels=3):
    """Random vectors, chains and clusters of near copies, and exact copies."""
    random = np.random.default_rng(seed)
    base = random.normal(size=(n, d))
    for k in range(n // 3):
        base[k] = base[k % 5] + random.normal(size=d) * random.choice([0.05, 0.2, 0.37, 0.5])
    for k in range(n // 3, n // 3 + n // 8):
        base[k] = base[k - 1] + random.normal(size=d) * 0.25 * np.abs(base[k - 1]).mean()
    base[-20:] = base[:20] * random.choice([1.0, 2.0, 0.5], size=(20, 1))
    return [(k, [float(np.float32(x)) for x in v], int(k * 7 % labels)) for k, v in enumerate(base)]


@pytest.mark.parametrize("n, d, labels, least", [(300, 16, 3, 1024), (400, 64, 1, 40), (200, 3, 2, 10), (120, 1, 1, 7)])
def test_matches_all_pairs(spark, monkeypatch, n, d, labels, least):
    monkeypatch.setattr(vectors, "_LEAST_ROWS", least)
    monkeypatch.setattr(vectors, "_MOST_ROWS", 4 * least)
    rows = planted(n, d, n, labels)
    want = brute_force(rows)
    assert sum(r[1] > 0 for r in want) > n // 8
    assert run(spark, rows) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    one, two = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [
        (5, one, 1), (4, two, 1), (3, one, 2), (2, one, None), (1, None, 1), (10, [], 1), (11, [0.0, 0.0, 0.0], 1), (12, [nan, 1.0, 1.0], 1), (13, [inf, 1.0, 1.0], 1),
        (14, [1.0, None, 1.0], 1), (15, [1.0, 2.0], 1), (16, [2.0, 4.0], 1), (None, one, 1), (None, [9.0, -1.0, 0.0], 3), (5, one, 1), (7, [-1.0, -2.0, -3.0], 1),
        (20, [1e30, 2e30, 3e30], 1), (21, [1e-30, 2e-30, 3e-30], 1), (22, [-0.0, 1.0, 0.0], 4), (23, [0.0, 1.0, -0.0], 4),
    ]
    assert run(spark, rows) == brute_force(rows)


def test_empty_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = [(k, [1.0, float(k % 2)], 1) for k in range(6)]
    names = SCHEMA + ", class string, copies int, d int, x0 string, tile string, `range` int, n_links int, vector string, q int, bounds int"
    assert run(spark, [(*r, "c", 1, 2, "x", "t", 3, 4, "v", 5, 6) for r in rows], names) == brute_force(rows)


def test_strings_as_ids_and_labels(spark):
    rows = [(f"v{k}", [1.0, float(k)], "a") for k in (1, 1, 50, 51)]
    got = run(spark, rows, "vec_id string, embedding array<double>, label string")
    assert [r[1] for r in got] == [1, 1, 1, 1]


def test_equal_coordinates_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(vectors, "_LEAST_ROWS", 5)
    monkeypatch.setattr(vectors, "_MOST_ROWS", 5)
    rows = [(k, [float(k // 30), *(float(j == k % 30) for j in range(30))], 1) for k in range(60)]
    assert run(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("dense", [0.0, 1.1])
def test_blocks_of_both_kinds(monkeypatch, dense):
    monkeypatch.setattr(vectors, "_DENSE", dense)
    monkeypatch.setattr(vectors, "_ROWS", 16)
    monkeypatch.setattr(vectors, "_COLUMNS", 32)
    monkeypatch.setattr(vectors, "_GATHER", 10)
    random = np.random.default_rng(5)
    raw = random.normal(size=(150, 24))
    raw[50:100] = raw[:50] + 0.3 * random.normal(size=(50, 24))
    x = vectors.units(raw)
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.93, 1)))}
    found = [p for i, j in vectors.linked_pairs(x, x, True, 0.93, lambda i, j: vectors.cosines(raw[i], raw[j])) for p in zip(i, j)]
    assert len(want) > 20 and len(found) == len(set(found)) and set(found) == want
    crossed = [p for i, j in vectors.linked_pairs(x[:60], x[60:], False, 0.93, lambda i, j: vectors.cosines(raw[i], raw[60 + j])) for p in zip(i, j)]
    assert sorted(crossed) == sorted((i, j - 60) for i, j in want if i < 60 <= j)
