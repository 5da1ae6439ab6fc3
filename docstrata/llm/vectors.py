"""Near-duplicate vectors by PCA-ordered tiled comparison, exact at a cosine threshold.

Vectors are compared only within equal labels (and equal lengths).  The second moments of
all unit vectors, summed on Spark, give an orthogonal basis with the leading directions
first; in it a product of two vectors is known from its leading part to within the product
of the norms of what is left.  So a tile of rows is compared with another by accumulating
the leading dimensions of all pairs, and a pair goes on to the next dimensions only while
its partial product plus that bound reaches the threshold.  What remains is decided by the
whole product, and within rounding of the threshold by the original vectors.

Rows of a label are cut into tiles along the first direction, by quantiles, so that each
task compares about the same area and holds two tiles.  Two tiles meet only if their boxes
in the first directions are near enough for a link.  A pair of tiles emits one row for each
vector that has links: the number of them, and the first vector of its local component; the
components of all tiles are then joined.  Pairs are never written.

The work grows with the square of a label's distinct vectors, as exact comparison does when
neither the boxes nor the leading dimensions tell vectors apart; memory does not.

Defined cases: equal vectors of a label are one row of the comparison, with their number.
Null labels, and vectors that are null, empty, zero or hold null or non-finite components,
link with nothing.  Vectors of different lengths do not link.  A null id counts as the
largest; rows that repeat an id are vectors of that id.  An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm.neardup import components
from docstrata.llm.storage import staged, workspace

THRESHOLD, BOXES = 0.93, 4
_SLACK = 1e-9  # far above the rounding of a product of unit vectors
_LEAST_ROWS, _MOST_ROWS, _SPLIT_BITS = 1_024, 32_768, 24
_ROWS, _COLUMNS, _DENSE, _GATHER = 512, 2_048, 0.05, 1 << 16


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat components (null: NaN) of a list column, and each row's begin and length (null: 0)."""
    column = column.cast(pa.large_list(pa.float64())) if not pa.types.is_large_list(column.type) or column.type.value_type != pa.float64() else column
    flat = column.values.to_numpy(zero_copy_only=False)
    offsets = np.asarray(column.offsets)
    lengths = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
    return flat, offsets[:-1], lengths


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By length: the row numbers and rows of all vectors that can link, as doubles."""
    flat, begins, lengths = _values(column)
    for d in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        matrix = flat[begins[rows][:, None] + np.arange(d)]
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        if good.any():
            yield rows[good], matrix[good]


def units(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1; very large and very small components are scaled first."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of label and vector beside each row, null where it links with nothing."""
    for batch in batches:
        labels, digests = batch.column(1).to_pylist(), [None] * batch.num_rows
        for rows, matrix in matrices(batch.column(2)):
            for k, vector in zip(rows.tolist(), matrix + 0.0):  # -0.0 is 0.0
                if labels[k] is not None:
                    digests[k] = hashlib.blake2b(f"{labels[k]}\0".encode() + vector.tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], names=["vec_id", "label", "vector", "class"])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's sum of outer products of unit vectors, by length and row of the matrix."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, matrix in matrices(batch.column(0)):
            x = units(matrix)
            sums[x.shape[1]] = sums.get(x.shape[1], 0.0) + x.T @ x
    for d, moment in sums.items():
        yield pa.RecordBatch.from_pydict({"d": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()), "row": pa.array(list(moment))})


def _summed(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    total = np.sum(np.stack(rows["row"].to_numpy()), axis=0)
    return pa.table({"d": rows["d"].slice(0, 1), "i": rows["i"].slice(0, 1), "row": pa.array([total])})


def bases(classes: DataFrame) -> dict[int, np.ndarray]:
    """By vector length, the orthogonal basis of the second moments, leading directions first.

    One d x d matrix a length reaches the driver, whatever the number of vectors.
    """
    partial_sums = classes.select("vector").mapInArrow(_moments, "d int, i int, row array<double>")
    rows = partial_sums.groupBy("d", "i").applyInArrow(_summed, "d int, i int, row array<double>").collect()
    found: dict[int, np.ndarray] = {}
    for row in rows:
        found.setdefault(row["d"], np.zeros((row["d"], row["d"])))[row["i"]] = row["row"]
    return {d: np.ascontiguousarray(np.linalg.eigh((m + m.T) / 2)[1][:, ::-1]) for d, m in found.items()}


def _projected(batches: Iterator[pa.RecordBatch], basis: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The first coordinates of each vector, and its length."""
    for batch in batches:
        lead, sizes = np.zeros((batch.num_rows, BOXES)), np.zeros(batch.num_rows, np.int32)
        for rows, matrix in matrices(batch.column(0)):
            d = matrix.shape[1]
            own = units(matrix) @ basis[d][:, :BOXES]
            lead[rows, : own.shape[1]], sizes[rows] = own, d
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes), *map(pa.array, lead.T)], names=[*batch.schema.names, "d", *[f"x{k}" for k in range(BOXES)]])


class Roots:
    """Components of local links, each named by its smallest member."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.of[i], self.of[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.of, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(above := self.of[self.of], self.of):
                self.of = above


def linked_pairs(x: np.ndarray, y: np.ndarray, same: bool, threshold: float, exact) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (rows of x, rows of y) whose product reaches the threshold; i < j if ``same``.

    Rows are unit vectors in the basis.  ``exact(i, j)`` decides pairs within rounding.
    """
    d = x.shape[1]
    cuts = sorted({min(d, max(1, c)) for c in (d // 4, d // 2, d)})
    left = lambda m, cut: np.sqrt(np.maximum((m[:, cut:] ** 2).sum(axis=1), 0.0)) if cut < d else np.zeros(len(m))
    rest_x, rest_y = {c: left(x, c) for c in cuts}, {c: left(y, c) for c in cuts}
    head = cuts[0]
    for r in range(0, len(x), _ROWS):
        xs = x[r : r + _ROWS]
        for c in range(r - r % _COLUMNS if same else 0, len(y), _COLUMNS):
            ys = y[c : c + _COLUMNS]
            products = xs[:, :head] @ ys[:, :head].T
            reach = products + np.multiply.outer(rest_x[head][r : r + _ROWS], rest_y[head][c : c + _COLUMNS])
            alive = reach >= threshold - _SLACK
            if same:
                alive &= np.arange(r, r + len(xs))[:, None] < np.arange(c, c + len(ys))
            if np.count_nonzero(alive) > _DENSE * alive.size:
                products += xs[:, head:] @ ys[:, head:].T
                i, j = np.nonzero(alive & (products >= threshold - _SLACK))
                i, j, value = i + r, j + c, products[i, j]
                yield _decide(i, j, value, threshold, exact)
                continue
            some_i, some_j = np.nonzero(alive)
            for k in range(0, len(some_i), _GATHER):
                i, j = some_i[k : k + _GATHER], some_j[k : k + _GATHER]
                value = products[i, j]
                i, j = i + r, j + c
                for low, high in zip(cuts[:-1], cuts[1:]):
                    value = value + np.einsum("ij,ij->i", x[i, low:high], y[j, low:high])
                    on = value + rest_x[high][i] * rest_y[high][j] >= threshold - _SLACK
                    i, j, value = i[on], j[on], value[on]
                yield _decide(i, j, value, threshold, exact)


def _decide(i: np.ndarray, j: np.ndarray, value: np.ndarray, threshold: float, exact) -> tuple[np.ndarray, np.ndarray]:
    keep = value >= threshold
    near = np.flatnonzero(np.abs(value - threshold) <= _SLACK)
    if len(near):
        keep[near] = exact(i[near], j[near]) >= threshold
    return i[keep], j[keep]


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of paired rows in double precision."""
    scale = lambda m: m / np.abs(m).max(axis=1, keepdims=True)
    x, y = scale(x), scale(y)
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def _compare(rows: pa.Table, first: int, second: int, basis: dict[int, np.ndarray], threshold: float) -> pa.Table:
    """class, links and root of the vectors of two tiles (or of one) that have links."""
    tiles, classes = np.asarray(rows["tile"]), rows["class"].combine_chunks()
    vectors = rows["vector"].combine_chunks()
    numbers, raw = next(matrices(vectors))
    order = np.argsort(tiles[numbers] != first, kind="stable")  # the first tile's rows come first
    numbers, raw = numbers[order], raw[order]
    weights = np.asarray(rows["copies"]).astype(np.int64)[numbers]
    cut, same = int(np.count_nonzero(tiles[numbers] == first)), first == second
    turned = units(raw) @ basis[raw.shape[1]]
    x, y, base = (turned, turned, 0) if same else (turned[:cut], turned[cut:], cut)
    counts, roots = np.zeros(len(turned), np.int64), Roots(len(turned))
    for i, j in linked_pairs(x, y, same, threshold, lambda i, j: cosines(raw[i], raw[base + j])):
        j = j + base
        counts += np.bincount(i, weights[j], minlength=len(turned)).astype(np.int64)
        counts += np.bincount(j, weights[i], minlength=len(turned)).astype(np.int64)
        roots.link(i, j)
    some = np.flatnonzero(counts)
    return pa.table({"class": classes.take(pa.array(numbers[some])), "links": counts[some], "root": classes.take(pa.array(numbers[roots.of[some]]))})


def _tiled(classes: DataFrame, folder: str) -> DataFrame:
    """Classes with their tile: ranges of the first coordinate within label and length."""
    groups = staged(classes.groupBy("label", "d").agg(F.count("*").alias("n")), f"{folder}/groups")
    # About as many equal areas as there are tasks, each a tile squared.
    area = groups.agg(F.sum(F.col("n").cast("double") ** 2).alias("area"), F.max("n").alias("most")).first()
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = min(max(int(((area["area"] or 0) / (2 * tasks)) ** 0.5), _LEAST_ROWS), _MOST_ROWS)
    steps = -(-(area["most"] or 1) // side)
    bounds = groups.withColumn("tiles", F.ceil(F.col("n") / side))
    if steps > 1:
        found = classes.groupBy("label", "d").agg(F.percentile_approx("x0", [k / steps for k in range(1, steps)], 20 * steps).alias("q"))
        own = F.when(F.col("tiles") > 1, F.transform(F.sequence(F.lit(1), F.col("tiles") - 1), lambda k: F.element_at("q", F.greatest(F.floor(k * steps / F.col("tiles")), F.lit(1)).cast("int"))))
        bounds = bounds.join(found, ["label", "d"]).withColumn("bounds", F.coalesce(own, F.array().cast("array<double>")))
    else:
        bounds = bounds.withColumn("bounds", F.array().cast("array<double>"))
    ranges = classes.join(staged(bounds.select("label", "d", "bounds"), f"{folder}/bounds"), ["label", "d"])
    ranges = staged(ranges.withColumn("range", F.size(F.filter("bounds", lambda b: b <= F.col("x0")))).drop("bounds"), f"{folder}/ranges")
    # Many equal coordinates leave a range too full: it is dealt out by hash.
    full = ranges.groupBy("label", "d", "range").agg(F.ceil(F.count("*") / (2 * side)).alias("parts"))
    tile = F.shiftleft(F.col("range").cast("bigint"), _SPLIT_BITS) + F.pmod(F.xxhash64("class"), F.col("parts"))
    return staged(ranges.join(full, ["label", "d", "range"]).withColumn("tile", tile).drop("range", "parts"), f"{folder}/tiles")


def _meeting(tiles: DataFrame, threshold: float) -> DataFrame:
    """(label, d, tile, first, second): each tile with every pair of tiles it has to be in."""
    sides = [f(f"x{k}").alias(f"{n}{k}") for k in range(BOXES) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    boxes = tiles.groupBy("label", "d", "tile").agg(*sides)
    one, two = boxes.alias("a"), boxes.alias("b")
    gaps = [F.greatest(F.lit(0.0), F.col(f"a.lo{k}") - F.col(f"b.hi{k}"), F.col(f"b.lo{k}") - F.col(f"a.hi{k}")) ** 2 for k in range(BOXES)]
    near = sum(gaps[1:], gaps[0]) <= 2 - 2 * threshold + _SLACK
    same = (F.col("a.label") == F.col("b.label")) & (F.col("a.d") == F.col("b.d")) & (F.col("a.tile") <= F.col("b.tile"))
    pairs = one.join(two, same & near).select("a.label", "a.d", F.col("a.tile").alias("first"), F.col("b.tile").alias("second"))
    return pairs.withColumn("tile", F.explode(F.array_distinct(F.array("first", "second"))))


def near_vectors(
    rows: DataFrame, *, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    folder = workspace(rows.sparkSession, "vectors")
    plain = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    kind = {f.name: f.dataType.simpleString() for f in plain.schema}
    marked = plain.mapInArrow(_marked, f"vec_id {kind['vec_id']}, label {kind['label']}, vector {kind['vector']}, class binary")
    members = staged(marked.select("vec_id", "class"), f"{folder}/members")
    found = staged(
        marked.where("class is not null").groupBy("class").agg(
            F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id")).alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")
        ).select("vector", "class", "label", "copies", F.col("least.vec_id").alias("first_id")),
        f"{folder}/classes",
    )
    basis = bases(found)
    lead = ", ".join(f"x{k} double" for k in range(BOXES))
    placed = found.select("vector", "class", "label", "copies").mapInArrow(
        partial(_projected, basis=basis), f"vector {kind['vector']}, class binary, label {kind['label']}, copies bigint, d int, {lead}"
    )
    tiles = _tiled(placed, folder)
    meeting = staged(_meeting(tiles, threshold), f"{folder}/meeting")

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _compare(table, key[2].as_py(), key[3].as_py(), basis, threshold)

    sent = tiles.select("label", "d", "tile", "class", "copies", "vector").join(meeting, ["label", "d", "tile"])
    local = staged(sent.groupBy("label", "d", "first", "second").applyInArrow(compare, "class binary, links bigint, root binary"), f"{folder}/links")
    joined = components(local.select(F.col("class").alias("a"), F.col("root").alias("b")), f"{folder}/components")
    linked = local.groupBy("class").agg(F.sum("links").alias("links"))
    named = found.select("class", "first_id", "copies").join(joined.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    # Written first, so that the join below can split a component with many of the rows.
    named = staged(named, f"{folder}/named")
    heads = named.groupBy("component").agg(F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id")).alias("least")).select("component", F.col("least.first_id").alias("head"))
    heads = staged(heads, f"{folder}/heads")
    known = staged(
        named.join(heads, "component").join(linked, "class", "left").select("class", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), f"{folder}/known"
    )
    head = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("head"))
    return members.join(known, "class", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), head.alias("component_id"), F.col("vec_id").eqNullSafe(head).alias("kept")
    )
