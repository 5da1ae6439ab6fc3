"""Document fingerprints: threshold-scaled sketches of character shingles.

A shingle is a run of 8 code points (a shorter text is one shingle).  The sketch keeps
every distinct 40-bit shingle hash below ``2**40 / scale``; if none lies below, the least
one, so that only an empty text has an empty sketch.  The threshold is the same for all
documents, so sketches of very unequal documents can be merged (``merge``) and compared:
``likeness`` estimates Jaccard similarity and ``containment`` the share of one document
within another.  As a string a sketch is the Base64 of its ascending hashes, five bytes each.

Defined cases: a null text is the empty text; two empty sketches are alike (1), an empty
and a full one are not (0).  The next document is that of the next larger id; null ids
come last, rows that repeat an id follow each other by text, and the last row's next is
the first (a single row's next is itself).  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm.ranks import key_ranges
from docstrata.llm.words import mix
from docstrata.session import ship_package

SHINGLE, SCALE, BITS = 8, 8, 40
_CHUNK_BYTES = 24 << 20


def sketch(text: str, scale: int = SCALE) -> np.ndarray:
    """Ascending retained hashes of one text."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    n = len(points)
    if not n:
        return points
    width = min(n, SHINGLE)
    rolled = np.full(n - width + 1, n if n < SHINGLE else 0, dtype=np.uint64)
    for k in range(width):
        rolled *= np.uint64(0x9E3779B97F4A7C15)
        rolled += points[k : k + len(rolled)]
    hashes = mix(rolled) >> np.uint64(64 - BITS)
    below = hashes[hashes < np.uint64((1 << BITS) // scale)]
    return np.unique(below) if len(below) else hashes.min(keepdims=True)


def to_string(hashes: np.ndarray) -> str:
    packed = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :]
    return base64.b64encode(packed.tobytes()).decode("ascii")


def from_string(text: str) -> np.ndarray:
    packed = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, BITS // 8)
    wide = np.zeros((len(packed), 8), dtype=np.uint8)
    wide[:, 8 - BITS // 8 :] = packed
    return wide.view(">u8").ravel().astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of both documents' shingles together."""
    both = np.union1d(a, b)
    below = both[both < np.uint64((1 << BITS) // scale)]
    return below if len(below) else both[:1]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the shingle sets."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def edit(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many, or all, of the next document's first."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _sketch_rows(batches: Iterator[pa.RecordBatch], scale: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (chunk, ghost, id): each row meets the next, the last of a chunk its ghost."""
    held: list = []  # chunk, id, text and sketch of the row that waits for its next
    first: tuple | None = None
    out: list[tuple] = []

    def close(following: str, following_sketch: np.ndarray) -> None:
        _, doc_id, text, own = held[0]
        edited = edit(text, following)
        edited_sketch = sketch(edited, scale)
        out.append(
            (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_string(own), to_string(edited_sketch),
             likeness(own, edited_sketch), likeness(own, following_sketch), containment(own, following_sketch))
        )
        held.clear()

    def flush(schema: pa.Schema) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return batch

    schema = None
    for batch in batches:
        schema = schema or pa.schema(
            [("doc_id", batch.schema.field("doc_id").type), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
             ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("next_containment", pa.float64())]
        )
        columns = [batch.column(name) for name in ("chunk", "ghost", "doc_id", "text")]
        for i in range(batch.num_rows):
            chunk, ghost, doc_id, text = (column[i].as_py() for column in columns)
            if ghost and not held:
                continue  # a further ghost, or one without a row before it
            own = sketch(text, scale)
            if held and (ghost or held[0][0] == chunk):
                close(text, own)
            if not ghost:
                held.append((chunk, doc_id, text, own))
                first = first or (text, own)
        if out:
            yield flush(schema)
    if held and whole:
        close(*first)
    if out:
        yield flush(schema)


def fingerprints(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", scale: int = SCALE, chunk_bytes: int = _CHUNK_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    Rows are dealt to ranges of ids and sorted there; the first row of each range is also
    sent, as a ghost, to the end of the range before it.  So texts move once.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = key_ranges(rows, "doc_id", "text", chunk_bytes)
    heads, whole = ranges.heads, ranges.count == 1
    if whole:
        dealt = rows.withColumn("chunk", F.lit(0)).withColumn("ghost", F.lit(False))
    else:
        own = F.struct(F.col("chunk").alias("chunk"), F.lit(False).alias("ghost"))
        ghost = F.struct(F.pmod(F.col("chunk") + len(heads) - 1, F.lit(len(heads))).alias("chunk"), F.lit(True).alias("ghost"))
        places = F.when(F.col("doc_id").isin(heads), F.array(own, ghost)).otherwise(F.array(own))
        dealt = rows.withColumn("chunk", ranges.of("doc_id")).select("doc_id", "text", F.explode(places).alias("place"))
        dealt = dealt.select("doc_id", "text", "place.chunk", "place.ghost")
    id_type = docs.schema[doc_id].dataType.simpleString()
    return (
        dealt.repartitionById(ranges.count, "chunk")
        .sortWithinPartitions("chunk", "ghost", F.col("doc_id").asc_nulls_last(), "text")
        .mapInArrow(
            partial(_sketch_rows, scale=scale, whole=whole),
            f"doc_id {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, next_containment double",
        )
    )
