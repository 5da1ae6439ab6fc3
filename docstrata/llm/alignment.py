"""Alignment of two tokenizers' tokens over a corpus, in Arrow columns.

Two token streams A and B cover the same bytes.  Per block of documents, flat token lists
and their parent indices give every token's end by a cumulative sum that restarts in each
document; a full outer hash join of the (document, end) keys of A and B then has one row for
each end that either has.  Such a row is one link: the bytes up to that end, from the end
before, lie in exactly one A and one B token, and each overlapping pair of tokens has exactly
one such stretch.  Rows with both ends close a group.

Counts: ``Table.group_by`` counts the id pairs of a chunk of documents, Spark adds the chunks
up and finds the highest count of each B id.  The links of a chunk are kept as places in the
chunk's own list of pairs, in one file a chunk, so that only the lists of pairs and their
totals are shuffled: a pair that is everywhere has one row a chunk.

The A tokenizer's vocabulary and merges are read from its JSON file and run by the rank
library, which gives the same ids (tested) at several times the speed.

Defined cases: null or empty texts, texts that are not UTF-8, and texts whose joined tokens
are not a blank and the text have no tokens: all counts are 0 and ``groups_sha256`` is ''.
Ids may be null, repeated and of any type; every row has its own result.  An empty table
gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm.storage import Publisher, filesystem, staged, workspace

CHUNK_BYTES = 4 << 20
_SLICE_BYTES = 256 << 10
_DOC_SHIFT = 40  # a document-end key has the end in its low bits
# The pattern of the byte-level tokenizer, and the printable stand-ins of its bytes.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_of() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(_PLAIN)]
    return {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteTokens:
    """Tokens of the byte-level tokenizer of a JSON file; special tokens are ordinary text."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        special, byte_of = {token["content"] for token in found["added_tokens"]}, _byte_of()
        ranks = {bytes(byte_of[c] for c in token): number for token, number in found["model"]["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding("own", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.bytes = _by_id({number: token for token, number in ranks.items()}, self.size)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + text) for text in texts]


class PieceTokens:
    """Tokens of a piece model, which puts the blank before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()

        def content(k: int) -> bytes:
            piece = self.model.id_to_piece(k)
            return bytes([int(piece[3:5], 16)]) if self.model.is_byte(k) else piece.replace("▁", " ").encode()

        self.bytes = _by_id({k: content(k) for k in range(self.size)}, self.size)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _by_id(tokens: dict[int, bytes], size: int) -> pa.Array:
    return pa.array([tokens.get(k, b"") for k in range(size)], pa.large_binary())


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> tuple[ByteTokens, PieceTokens]:
    return ByteTokens(a_path), PieceTokens(b_path)


@lru_cache(maxsize=1)
def _written(size: int) -> pa.Array:
    """Decimal ids followed by ',' then by '|' then by ';'."""
    return pa.array([f"{k}{mark}" for mark in ",|;" for k in range(size)], pa.large_string())


def _tokens(encoder: ByteTokens | PieceTokens, texts: list[str], expected: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and the number of them of each text; none where the tokens do not join to the text."""
    flat, counts = [], []
    begin = 0
    while begin < len(texts):
        end, held = begin, 0
        while end < len(texts) and (held == 0 or held + len(expected[end]) <= _SLICE_BYTES):
            held, end = held + len(expected[end]), end + 1
        for ids, want in zip(encoder.encode(texts[begin:end]), expected[begin:end]):
            ids = np.array(ids, dtype=np.int64)
            _, offsets, data = encoder.bytes.take(pa.array(ids)).buffers()
            size = np.frombuffer(offsets, np.int64)[len(ids)] if len(ids) else 0
            same = size == len(want) and (data.slice(0, size).equals(pa.py_buffer(want)) if size else True)
            flat.append(ids if same else ids[:0])
            counts.append(len(ids) if same else -1)
        begin = end
    return np.concatenate(flat) if flat else np.zeros(0, np.int64), np.array(counts, dtype=np.int64)


def _ends(ids: pa.ListArray, lengths: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Flat ids, their documents, and each token's end in its document."""
    flat, parents = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
    running = pc.cumulative_sum(pc.take(lengths, flat))
    heads = np.asarray(ids.offsets)[:-1]
    before = np.concatenate([[0], np.asarray(running)])[heads]
    return flat, parents, pc.subtract(running, pc.take(pa.array(before), parents))


class Aligned:
    """Links and groups of one block of documents."""

    def __init__(self, a_ids: pa.ListArray, b_ids: pa.ListArray, a: ByteTokens, b: PieceTokens):
        n = len(a_ids)
        self.a, a_doc, a_end = _ends(a_ids, pc.binary_length(a.bytes).cast(pa.int64()))
        self.b, b_doc, b_end = _ends(b_ids, pc.binary_length(b.bytes).cast(pa.int64()))
        key = lambda doc, end: pc.add(pc.shift_left(doc, pa.scalar(_DOC_SHIFT, pa.int64())), end)
        left = pa.table({"key": key(a_doc, a_end), "in_a": pa.repeat(True, len(self.a))})
        right = pa.table({"key": key(b_doc, b_end), "in_b": pa.repeat(True, len(self.b))})
        ends = left.join(right, "key", join_type="full outer", use_threads=False).combine_chunks().sort_by("key")
        in_a, in_b = (np.asarray(pc.is_valid(ends[c])) for c in ("in_a", "in_b"))
        # An end inside a token belongs to the next token that ends.
        before = lambda flags: np.cumsum(flags) - flags
        both = in_a & in_b
        self.doc = np.asarray(ends["key"]) >> _DOC_SHIFT
        self.pair = np.asarray(self.a)[before(in_a)] * b.size + np.asarray(self.b)[before(in_b)] if len(self.doc) else np.zeros(0, np.int64)
        group = before(both)
        self.a_group, self.b_group = group[in_a], group[in_b]
        self.n_links = np.bincount(self.doc, minlength=n)
        self.n_groups = np.bincount(self.doc[both], minlength=n)
        self.a_counts, self.b_counts = (np.diff(np.asarray(x.offsets)).astype(np.int64) for x in (a_ids, b_ids))
        self.vocabulary = max(a.size, b.size)

    def digests(self) -> list[str]:
        """The hash of each document's groups, '' without tokens."""
        n_a, n_b = len(self.a_group), len(self.b_group)
        total = int(self.a_group[-1]) + 1 if n_a else 0
        a_of, b_of = np.bincount(self.a_group, minlength=total), np.bincount(self.b_group, minlength=total)
        places = np.empty(n_a + n_b, dtype=np.int64)
        last = lambda group: np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)
        places[np.arange(n_a) + (np.cumsum(b_of) - b_of)[self.a_group]] = np.asarray(self.a) + self.vocabulary * last(self.a_group)
        places[np.arange(n_b) + np.cumsum(a_of)[self.b_group]] = np.asarray(self.b) + 2 * self.vocabulary * last(self.b_group)
        written = _written(self.vocabulary).take(pa.array(places))
        offsets, data = np.frombuffer(written.buffers()[1], np.int64), memoryview(written.buffers()[2] or b"")
        cuts = offsets[np.concatenate([[0], np.cumsum(self.a_counts + self.b_counts)])].tolist() if n_a else [0] * (len(self.a_counts) + 1)
        return [hashlib.sha256(data[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(cuts[:-1], cuts[1:])]


_DOC_COLUMNS = ["n_a", "n_b", "n_groups", "n_links"]


def align_block(ids: pa.Array, texts: pa.Array, a: ByteTokens, b: PieceTokens) -> tuple[pa.Table, pa.Table]:
    """Documents with their places in the list of pairs, and that list with its counts."""
    whole, good, strings = [x or b"" for x in texts.cast(pa.binary()).to_pylist()], [], []
    for k, x in enumerate(whole):
        try:
            text = x.decode()
        except UnicodeDecodeError:
            continue
        if text:
            good.append(k)
            strings.append(text)
    expected = [b" " + whole[k] for k in good]
    del whole
    flat_a, n_a = _tokens(a, strings, expected)
    flat_b, n_b = _tokens(b, strings, expected)
    right = (n_a >= 0) & (n_b >= 0)
    size_a, size_b = np.maximum(n_a, 0), np.maximum(n_b, 0)
    flat_a, flat_b = flat_a[np.repeat(right, size_a)], flat_b[np.repeat(right, size_b)]

    def lists(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
        every = np.zeros(len(ids) + 1, dtype=np.int64)
        every[1:][good] = np.where(right, sizes, 0)
        return pa.LargeListArray.from_arrays(pa.array(np.cumsum(every)), pa.array(flat))

    block = Aligned(lists(flat_a, size_a), lists(flat_b, size_b), a, b)
    counted = pa.table({"pair": block.pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
    spots = np.searchsorted(np.asarray(counted["pair"]), block.pair).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(block.n_links)])
    docs = pa.table(
        {
            "doc_id": ids, "n_a": block.a_counts, "n_b": block.b_counts, "n_groups": block.n_groups, "n_links": block.n_links,
            "groups_sha256": pa.array(block.digests(), pa.string()), "spots": pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(spots)),
        }
    )
    return docs, counted.rename_columns(["pair", "k"])


def chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of consecutive rows with about ``chunk_bytes`` of text; a longer text stands alone."""
    held, size = [], 0
    for batch in batches:
        sizes = np.cumsum(np.asarray(pc.binary_length(batch.column(1)).fill_null(0), dtype=np.int64))
        begin = 0
        while begin < batch.num_rows:
            done = int(sizes[begin - 1]) if begin else 0
            end = max(int(np.searchsorted(sizes, done + chunk_bytes - size, "right")), begin if held else begin + 1)
            if end > begin:
                held.append(batch.slice(begin, end - begin))
                size += int(sizes[end - 1]) - done
            if end < batch.num_rows:
                joined = pa.Table.from_batches(held).combine_chunks()
                yield joined.column(0).combine_chunks(), joined.column(1).combine_chunks()
                held, size = [], 0
            begin = end
    if held:
        joined = pa.Table.from_batches(held).combine_chunks()
        yield joined.column(0).combine_chunks(), joined.column(1).combine_chunks()


def _flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _align(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, folder: str, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """One row a chunk: its file, and its pairs with their counts."""
    a, b = tokenizers(a_path, b_path)
    publisher, partition = Publisher(folder), TaskContext.get().partitionId()
    for number, (ids, texts) in enumerate(chunks(batches, chunk_bytes)):
        docs, counted = align_block(_flat(ids), _flat(texts), a, b)
        name, sink = f"links-{partition:06d}-{number:06d}.arrow", pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(docs)
        publisher.write(name, [sink.getvalue()])
        one = lambda column: pa.ListArray.from_arrays(pa.array([0, counted.num_rows], pa.int32()), _flat(counted[column]).cast(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([name]), one("pair"), one("k")], names=["chunk", "pairs", "counts"])


_RESULT = ["doc_id", *_DOC_COLUMNS, "n_best", "count_sum", "groups_sha256"]


def _total(chunk: str, totals: pa.Table) -> pa.Table:
    """The documents of the chunk in a file, with the corpus-wide counts of its pairs."""
    store, path = filesystem(chunk)
    with store.open_input_stream(path) as stream:
        docs = pa.ipc.open_stream(stream).read_all()
    totals = totals.filter(pc.is_valid(totals["place"]))
    places = np.asarray(totals["place"])
    n, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    n[places], best[places] = np.asarray(totals["n"]), np.asarray(totals["best"].cast(pa.int64()))
    lists = _flat(docs["spots"])
    spots, ends = np.asarray(lists.flatten()), np.cumsum(np.asarray(docs["n_links"]))

    def summed(values: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(values[spots])])
        return np.diff(running[np.concatenate([[0], ends])])

    docs = docs.append_column("n_best", pa.array(summed(best))).append_column("count_sum", pa.array(summed(n)))
    return docs.select(_RESULT)


def align(docs: DataFrame, a_path: str, b_path: str, *, text: str = "text", doc_id: str = "doc_id", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    folder = workspace(docs.sparkSession, "alignment")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = staged(
        rows.mapInArrow(
            partial(_align, a_path=a_path, b_path=b_path, folder=f"{folder}/links", chunk_bytes=chunk_bytes), "chunk string, pairs array<bigint>, counts array<bigint>"
        ),
        f"{folder}/chunks",
    )
    pairs = found.select("chunk", F.posexplode_outer(F.arrays_zip("pairs", "counts")).alias("place", "x")).select("chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("k"))
    totals = staged(pair_totals(pairs, tokenizers(a_path, b_path)[1].size), f"{folder}/totals")
    known = pairs.select("chunk", "place", "pair").join(totals.select("pair", "n", "best"), "pair", "left").select("chunk", "place", "n", "best")
    kind = rows.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{c} bigint" for c in _RESULT[1:-1])

    def total(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _total(f"{folder}/links/{key[0].as_py()}", table)

    return known.groupBy("chunk").applyInArrow(total, f"doc_id {kind}, {longs}, groups_sha256 string")


def pair_totals(pairs: DataFrame, b_size: int) -> DataFrame:
    """pair, n and best (whether no pair of the same B id has more) from (pair, k) rows."""
    totals = pairs.where("pair is not null").groupBy("pair").agg(F.sum("k").alias("n")).withColumn("b", F.pmod("pair", F.lit(b_size)))
    highest = totals.groupBy("b").agg(F.max("n").alias("most"))
    return totals.join(highest, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
