"""Token ids as files of fixed-width bit fields.

Every id takes the least number of bits that the vocabulary needs.  A file has

    header   "IDPK", version, bits, ids per block (4 x uint32, little-endian)
    blocks   ids per block (a multiple of 8, so blocks are whole bytes), least bit first
    index    an Arrow stream: per document its id, first id's place in the file, number of ids
    footer   number of ids, offsets of the blocks (uint64 each), number of blocks, place of
             the index, "IDPK"

so a reader finds any id by the block offsets, and unpacks whole blocks with numpy.
Documents stand in ascending order of their ids, files are ranges of them, and a manifest
written last names the files with the numbers of ids before them.

Defined cases: a null text is the empty text, which has only the end id.  Null document ids
come last; rows that repeat an id stand in the order of their ids' bytes.  An empty table
gives a manifest without files.  Extra columns are ignored.
"""

from __future__ import annotations

import json
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.llm.ranks import key_ranges
from docstrata.llm.storage import Publisher, filesystem
from docstrata.session import ship_package

MAGIC, VERSION, BLOCK_IDS = b"IDPK", 1, 1 << 16
_HEADER, _TAIL = struct.Struct("<4s3I"), struct.Struct("<QQQ4s")
_RANGE_BYTES = 96 << 20
# Texts that are encoded together: each distinct word of them is looked up once.
_GROUP_BYTES = 6 << 20


def bits_for(vocabulary: int) -> int:
    """Bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as bit fields, least bit first, padded to whole bytes."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    fields = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(fields.ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first n ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=n).astype(np.uint32)
    fields = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), dtype=np.uint8)
    wide[:, :bits] = fields
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class WordEncoder:
    """A tokenizer that drops white space and never joins words, applied word by word with a memory.

    Words of ASCII are lower-cased, as the tokenizer itself does, unless a special token may
    stand in them.  Other words are left to it: it composes characters before it lowers them,
    and a small letter may compose with a mark that its capital does not take.  New words of letters are encoded many at a time and told apart by the
    pieces that end a word; whatever does not come out even is encoded alone.
    """

    _MARKS = string.punctuation
    _MEMORY, _JOINED = 600_000, 64

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or "</w>"
        self.ends = np.zeros(self.size, dtype=bool)
        for piece, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[number] = piece.endswith(suffix)
        self.known: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: set[bytes]) -> None:
        letters, others, parts = [], [], {}
        for word in words:
            text = word.decode("utf-8")
            if text.isalpha():
                letters.append((word, text))
                continue
            head = text.rstrip(self._MARKS)
            if head.isalpha() and b"<|" not in word:
                parts[word] = (head.encode(), text[len(head) :].encode())
            else:
                others.append((word, text))
        for head, tail in parts.values():
            for piece, known in ((head, letters), (tail, others)):
                if piece not in self.known:
                    self.known[piece] = b""
                    known.append((piece, piece.decode()))
        groups = [letters[k : k + self._JOINED] for k in range(0, len(letters), self._JOINED)]
        for group, ids in zip(groups, self._ids([" ".join(text for _, text in group) for group in groups])):
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(group) and (not len(ids) or ends[-1] == len(ids)):
                data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
                for (word, _), begin, end in zip(group, cuts[:-1], cuts[1:]):
                    self.known[word] = data[begin:end]
            else:
                others.extend(group)
        for (word, _), ids in zip(others, self._ids([text for _, text in others])):
            self.known[word] = ids.tobytes()
        for word, (head, tail) in parts.items():
            self.known[word] = self.known[head] + self.known[tail]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        return [ids.tobytes() for ids in self.encode_array(pa.array(texts, pa.binary()))]

    def encode_array(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a binary array; a null has none.

        The words of all texts are told apart in Arrow, so that each distinct one is looked up once.
        """
        if len(self.known) > self._MEMORY:
            self.known.clear()
        # As text only for the kernel, which looks at ASCII white space alone: nothing is decoded.
        words = pc.ascii_split_whitespace(texts.cast(pa.large_binary()).view(pa.large_string()).fill_null(""))
        ends, coded = words.offsets.to_numpy().astype(np.int64), words.flatten().dictionary_encode()
        ends = ends - ends[0]
        distinct = coded.dictionary
        plain = pc.and_(pc.string_is_ascii(distinct), pc.invert(pc.match_substring(distinct, "<|")))
        lowered = pc.if_else(plain, pc.ascii_lower(distinct), distinct).view(pa.large_binary())
        keys = lowered.to_numpy(zero_copy_only=False).tolist()
        pieces = list(map(self.known.get, keys))
        new = {key for key, piece in zip(keys, pieces) if piece is None}
        if new:
            self._learn(new)
            pieces = list(map(self.known.__getitem__, keys))
        flat = np.frombuffer(b"".join(pieces), dtype="<u4")
        sizes = np.fromiter((len(x) // 4 for x in pieces), np.int64, len(pieces))
        starts, code = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        # Place in ``flat`` of each id: its word's start there, and its place within the word.
        counts = sizes[code]
        bounds = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(starts[code] - bounds[:-1], counts)
        places += np.arange(len(places))
        return np.split(flat[places], bounds[ends[1:-1]]) if len(ends) > 1 else []


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end: int, bits: int) -> Iterator[pa.RecordBatch]:
    """doc and packed ids of each row; texts pass in groups of a few megabytes."""
    encoder, last = _encoder(path), np.array([end], dtype="<u4")
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        group = np.cumsum(np.array(pc.binary_length(texts).fill_null(0), dtype=np.int64)) // _GROUP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for begin, stop in zip(cuts[:-1], cuts[1:]):
            part = texts.slice(begin, stop - begin)
            ids = [np.concatenate([x, last]) for x in encoder.encode_array(part)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(begin, len(part)), batch.column(2).slice(begin, len(part)),
                    pa.array([len(x) for x in ids], pa.int64()), pa.array([pack(x, bits) for x in ids], pa.binary()),
                ],
                names=["doc_id", "range", "n", "packed"],
            )


class FileWriter:
    """Writes one file of packed ids."""

    def __init__(self, publisher: Publisher, name: str, bits: int):
        self.file, self.bits = publisher.open(name), bits
        self.docs: list = []
        self.lengths: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.held = self.n = 0
        self.offsets = [_HEADER.size]
        self.file.write(_HEADER.pack(MAGIC, VERSION, bits, BLOCK_IDS))

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            flat = np.concatenate(self.waiting)
            whole = len(flat) - len(flat) % BLOCK_IDS
            for k in range(0, whole, BLOCK_IDS):
                self._block(flat[k : k + BLOCK_IDS])
            self.waiting, self.held = [flat[whole:]], len(flat) - whole

    def _block(self, ids: np.ndarray) -> None:
        self.file.write(pack(ids, self.bits))
        self.offsets.append(self.file.size)
        self.n += len(ids)

    def close(self, id_type: pa.DataType) -> int:
        if self.held:
            self._block(np.concatenate(self.waiting))
        place, lengths = self.file.size, np.array(self.lengths, dtype=np.int64)
        index = pa.table({"doc_id": pa.array(self.docs, id_type), "start": np.cumsum(lengths) - lengths, "n": lengths})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_table(index)
        self.file.write(sink.getvalue().to_pybytes())
        offsets = np.array(self.offsets, dtype="<u8")
        self.file.write(offsets.tobytes() + _TAIL.pack(self.n, len(offsets), place, MAGIC))
        self.file.publish()
        return self.n


class FileReader:
    """Random access to one file of packed ids."""

    def __init__(self, uri: str):
        store, path = filesystem(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        self.n, blocks, place, magic = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a file of packed ids")
        _, _, self.bits, self.block_ids = _HEADER.unpack(self.file.read_at(_HEADER.size, 0))
        end = size - _TAIL.size - 8 * blocks
        self.offsets = np.frombuffer(self.file.read_at(8 * blocks, end), dtype="<u8").astype(np.int64)
        self.index = pa.ipc.open_stream(self.file.read_at(end - place, place)).read_all()

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids at the places begin .. end - 1; only their blocks are read."""
        if end <= begin:
            return np.zeros(0, dtype=np.uint32)
        first, last = begin // self.block_ids, (end - 1) // self.block_ids
        data = self.file.read_at(int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first]))
        held = min(self.n, (last + 1) * self.block_ids) - first * self.block_ids
        flat = unpack(data, self.bits, held)
        return flat[begin - first * self.block_ids : end - first * self.block_ids]

    def document(self, row: int) -> np.ndarray:
        start = self.index["start"][row].as_py()
        return self.ids(start, start + self.index["n"][row].as_py())


_WRITTEN = "range int, file string, docs bigint, ids bigint"


def _write(batches: Iterator[pa.RecordBatch], folder: str, bits: int) -> Iterator[pa.RecordBatch]:
    """One file for each range that the task holds; its rows come in order."""
    publisher, writer, at, done, kind = Publisher(folder), None, None, [], None

    def finish() -> None:
        name = f"ids-{at:06d}.bin"
        docs = len(writer.docs)
        done.append((at, name, docs, writer.close(kind)))

    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for doc_id, number, n, packed in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "range", "n", "packed"))):
            if number != at:
                if writer:
                    finish()
                writer, at = FileWriter(publisher, f"ids-{number:06d}.bin", bits), number
            writer.add(doc_id, unpack(packed, bits, n))
    if writer:
        finish()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int32(), pa.string(), pa.int64(), pa.int64()))], names=["range", "file", "docs", "ids"])


def write_ids(docs: DataFrame, folder: str, tokenizer: str, *, end: int = 1, text: str = "text", doc_id: str = "doc_id", range_bytes: int = _RANGE_BYTES) -> None:
    """Encode every text, append ``end`` and write the files and the manifest to ``folder``.

    Ids move packed.  The manifest has one entry a file, of which there are at most 20,000.
    """
    ship_package(docs.sparkSession)
    bits = bits_for(_encoder(tokenizer).size)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ranges = key_ranges(rows, "doc_id", "text", range_bytes)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    encoded = rows.withColumn("range", ranges.of("doc_id")).mapInArrow(
        partial(_encoded, path=tokenizer, end=end, bits=bits), f"doc_id {id_type}, range int, n bigint, packed binary"
    )
    written = encoded.repartitionById(ranges.count, "range").sortWithinPartitions("range", F.col("doc_id").asc_nulls_last(), "packed").mapInArrow(
        partial(_write, folder=folder, bits=bits), _WRITTEN
    )
    before, files = 0, []
    for row in sorted(written.collect()):
        files.append({"file": row["file"], "docs": row["docs"], "ids": row["ids"], "before": before})
        before += row["ids"]
    Publisher(folder).write("manifest.json", [json.dumps({"bits": bits, "ids": before, "files": files}).encode()])


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            reader = FileReader(f"{folder}/{name}")
            starts, lengths = (reader.index[k].to_numpy() for k in ("start", "n"))
            # Documents in groups of about two million ids, read by block.
            group = np.cumsum(lengths) // (1 << 21)
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(starts)]
            for low, high in zip(cuts[:-1], cuts[1:]):
                base = int(starts[low])
                flat = reader.ids(base, int(starts[high - 1] + lengths[high - 1])).astype("<u4")
                crcs = [zlib.crc32(flat[s - base : s - base + n].tobytes()) for s, n in zip(starts[low:high].tolist(), lengths[low:high].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        reader.index["doc_id"].slice(low, high - low).combine_chunks(), pa.array(starts[low:high] + before), pa.array(lengths[low:high]),
                        pa.array(crcs, pa.int64()), pa.array([name] * (high - low)),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "file"],
                )


def read_ids(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and file of every document in the files of a manifest."""
    ship_package(spark)
    store, path = filesystem(f"{folder}/manifest.json")
    with store.open_input_stream(path) as stream:
        manifest = json.loads(stream.read())
    files = [(f["file"], f["before"]) for f in manifest["files"]]
    listed = spark.createDataFrame(files, "file string, before bigint").repartition(max(len(files), 1))
    return listed.mapInArrow(partial(_read, folder=folder), f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint, file string")
