"""SentencePiece encoding with seeded merge dropout, and lossless decoding.

The model's own merge order is kept: among the candidate merges of a text the one of the
best score, then the leftmost, is next.  A candidate is skipped when a keyed hash of the
seed, the document, the chunk around it and its place there falls below ``dropout``; so a rerun gives the same
ids, another seed or document other ones, and with ``dropout`` 0 the ids are the library's.

No piece holds white space after another character (checked at load), so merges stay inside
chunks: a run of blanks with the word after it.  Every chunk of every document has its own
key, by the seed, the document and the chunk's number in it.  Only what no key changes is
remembered: the merges of a chunk in their order when a given set of its candidates is
skipped, and their ids.  The key then tells the first merge that is skipped, which leads to
the next such path, or that none is.  Paths wanted once in a group of texts, and chunks of
more than ``_LONG`` characters, are segmented afresh under their key, with the same result.

Decoding joins the pieces' bytes.  It is lossless for every text: characters outside the
vocabulary are spelled in byte pieces, and so is a literal U+2581, which the library itself
would turn into a blank.

Defined cases: a null or empty text has no ids and decodes to itself.  Rows equal in id and
text get equal ids.  Extra columns are kept by ``encode`` unless their name is taken by an
added column (``free_name`` moves the added one).  An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docstrata.llm.storage import free_name
from docstrata.llm.words import mix
from docstrata.session import ship_package

DROPOUT, SEED = 0.1, 11
_BLANK, _LITERAL = "▁", "\udc81"  # the model's blank; a stand-in for a literal one, which no text can hold
_CHUNKS = re.compile(f"{_BLANK}*[^{_BLANK}]+|{_BLANK}+")
_MEMORY, _ROUND_SYMBOLS, _GROUP_BYTES = 300_000, 1 << 18, 2 << 20
_SLOT_BITS, _LONG, _BLOCK = 21, 32, 1 << 17


class Pieces:
    """Vocabulary, merges and memory of one model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = self.size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(n)]
        byte = [model.is_byte(i) for i in range(n)]
        self.bytes_of = [
            bytes([int(name[3:5], 16)]) if b else b"" if s else name.replace(_BLANK, " ").encode() for name, b, s in zip(names, byte, special)
        ]
        self.byte_ids = [next(i for i in range(n) if byte[i] and self.bytes_of[i][0] == value) for value in range(256)]
        ids = {name: i for i, name in enumerate(names) if not byte[i] and not special[i]}
        self.characters = {name: i for name, i in ids.items() if len(name) == 1}
        self.symbols = np.full(0x110000, -1, dtype=np.int32)  # by code point
        self.symbols[[ord(c) for c in self.characters]] = list(self.characters.values())
        keys, merged = [], []
        for name, i in ids.items():
            if _BLANK in name.lstrip(_BLANK) or any(c not in self.characters for c in name):
                raise ValueError(f"piece {name!r}: pieces must not join words or hold characters that are no pieces")
            for k in range(1, len(name)):
                left, right = ids.get(name[:k]), ids.get(name[k:])
                if left is not None and right is not None:
                    keys.append(left * n + right)
                    merged.append(i)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.pairs, self.merged = np.array(keys, dtype=np.int64)[order], np.array(merged, dtype=np.int64)[order]
        scores = np.array([model.get_score(i) for i in range(n)])
        # Equal scores have equal ranks; the best score has the highest.
        self.ranks = np.unique(scores, return_inverse=True)[1].astype(np.int32)
        self._hash_pairs()
        self._forget()

    def _hash_pairs(self) -> None:
        """A table that finds most pairs by one look; a slot's further pairs stay in a sorted list."""
        slot = self._slot(self.pairs)
        self.slot_pair, self.slot_piece = np.full(1 << _SLOT_BITS, -1, dtype=np.int64), np.full(1 << _SLOT_BITS, -1, dtype=np.int32)
        first = np.unique(slot, return_index=True)[1]
        self.slot_pair[slot[first]], self.slot_piece[slot[first]] = self.pairs[first], self.merged[first]
        later = np.ones(len(slot), dtype=bool)
        later[first] = False
        self.crowded = np.zeros(1 << _SLOT_BITS, dtype=bool)
        self.crowded[slot[later]] = True
        self.pairs, self.merged = self.pairs[later], self.merged[later]

    @staticmethod
    def _slot(pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    @staticmethod
    def _place(start, middle, end) -> np.ndarray:
        """Hash of a candidate's place in its chunk."""
        start, middle, end = (x.astype(np.uint64) for x in (start, middle, end))
        return mix(((start << np.uint64(42)) ^ (middle << np.uint64(21)) ^ end) * np.uint64(0x9E3779B97F4A7C15))

    def _candidates(self, left, right, start, middle, end, key, threshold: int, skipped: np.ndarray | None):
        """Merged piece and rank of neighbouring symbols; no piece or a skipped one has rank -1."""
        pair = left.astype(np.int64) * self.size + right
        pair[(left < 0) | (right < 0)] = -2
        slot = self._slot(pair)
        piece = np.where(self.slot_pair[slot] == pair, self.slot_piece[slot], np.int32(-1))
        rest = np.flatnonzero(self.crowded[slot] & (piece < 0))
        if len(rest) and len(self.pairs):
            spot = np.minimum(np.searchsorted(self.pairs, pair[rest]), len(self.pairs) - 1)
            piece[rest] = np.where(self.pairs[spot] == pair[rest], self.merged[spot], -1)
        rank = np.where(piece >= 0, self.ranks[piece], np.int32(-1))
        if threshold or skipped is not None:
            there = np.flatnonzero(piece >= 0)
            drawn = mix(key[there] ^ self._place(start[there], middle[there], end[there]))
            rank[there[(drawn >> np.uint64(11)) < np.uint64(threshold) if skipped is None else np.isin(drawn, skipped)]] = -1
        return piece, rank

    def segment(self, chunks: list[str], keys: np.ndarray, threshold: int, skipped: np.ndarray | None = None, merges: list | None = None) -> list[bytes]:
        """Ids of chunks as little-endian uint32 bytes, one merge of every chunk a round.

        With ``skipped`` the candidates are skipped whose draws it holds, whatever the threshold.
        Each round's merges are added to ``merges``: chunks and places.
        """
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        symbol = self.symbols[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        chunk = np.repeat(np.arange(len(chunks), dtype=np.int32), lengths)
        begin = (np.arange(len(symbol)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        results: list = [None] * len(chunks)

        def link(i: np.ndarray):
            """Candidates of the symbols i with their right neighbours; a symbol ends where the next begins."""
            piece, rank = np.full(len(i), -1, dtype=np.int32), np.full(len(i), -1, dtype=np.int32)
            last = len(symbol) - 1
            inner = np.flatnonzero((i < last) & (chunk[np.minimum(i + 1, last)] == chunk[i]))
            if len(inner):
                j = i[inner]
                own, after = chunk[j], np.minimum(j + 2, last)
                end = np.where((j + 2 <= last) & (chunk[after] == own), begin[after], lengths[own])
                piece[inner], rank[inner] = self._candidates(symbol[j], symbol[j + 1], begin[j], begin[j + 1], end, keys[own], threshold, skipped)
            return piece, rank

        piece, rank = link(np.arange(len(symbol)))
        while len(symbol):
            heads = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
            best = np.maximum.reduceat(rank, heads)
            spans = np.diff(np.r_[heads, len(symbol)])
            ended = best < 0
            if ended.any():
                over = np.repeat(ended, spans)
                ids, done = symbol[over], chunk[heads[ended]].tolist()
                stops = np.cumsum(spans[ended])
                data, offsets = ids.astype("<u4").tobytes(), (4 * np.r_[0, stops]).tolist()
                for number, low, high in zip(done, offsets, offsets[1:]):
                    results[number] = data[low:high]
                foreign = np.flatnonzero(ids < 0)
                if len(foreign):
                    places = begin[over]
                    for k in np.unique(np.searchsorted(stops, foreign, "right")).tolist():
                        low, high = offsets[k] // 4, offsets[k + 1] // 4
                        results[done[k]] = self._spell(chunks[done[k]], ids[low:high], places[low:high]).astype("<u4").tobytes()
                live = np.flatnonzero(~over)
                symbol, chunk, begin, piece, rank = (a[live] for a in (symbol, chunk, begin, piece, rank))
                if not len(symbol):
                    break
                best, spans = best[~ended], spans[~ended]
            hits = np.flatnonzero(rank == np.repeat(best, spans))
            hits = hits[np.r_[True, chunk[hits[1:]] != chunk[hits[:-1]]]]
            if merges is not None:
                own, after = chunk[hits], np.minimum(hits + 2, len(symbol) - 1)
                end = np.where((hits + 2 < len(symbol)) & (chunk[after] == own), begin[after], lengths[own])
                merges.append((own, self._place(begin[hits], begin[hits + 1], end)))
            symbol[hits] = piece[hits]
            keep = np.ones(len(symbol), dtype=bool)
            keep[hits + 1] = False
            keep = np.flatnonzero(keep)
            symbol, chunk, begin, piece, rank = (a[keep] for a in (symbol, chunk, begin, piece, rank))
            hits = hits - np.arange(len(hits))  # one symbol went in each chunk before
            before = hits[hits > 0]
            before = before[chunk[before - 1] == chunk[before]] - 1
            touched = np.concatenate([hits, before])
            piece[touched], rank[touched] = link(touched)
        return results

    def _spell(self, chunk: str, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        out: list[int] = []
        for number, at in zip(ids.tolist(), begin.tolist()):
            if number >= 0:
                out.append(number)
            else:
                character = _BLANK if chunk[at] == _LITERAL else chunk[at]
                out.extend(self.byte_ids[b] for b in character.encode())
        return np.array(out, dtype=np.int64)

    def _forget(self) -> None:
        """Paths by number; path 0 stands for a chunk that is segmented afresh.

        ``first`` and ``length`` tell a path's merges in ``places``; ``child`` has the path when
        that merge is skipped.  ``came`` is the merge whose skip made a path, ``done`` the number
        of merges before it.
        """
        self.roots: dict[str, int] = {}
        self.chunk_of, self.ids_of = [""], [b""]
        self.first, self.length, self.done = (np.zeros(1, dtype=np.int64) for _ in range(3))
        self.came = np.full(1, -1, dtype=np.int64)
        self.places, self.child, self.path_of = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)

    def _learn(self, chunks: list[str], came: np.ndarray) -> np.ndarray:
        """Numbers of new paths of chunks: those that follow when the merges ``came`` (-1: none) are skipped too."""
        done = np.zeros(len(chunks), dtype=np.int64)
        inner = np.flatnonzero(came >= 0)
        if len(inner):
            above = self.path_of[came[inner]]
            done[inner] = self.done[above] + came[inner] - self.first[above]
        # The skipped merges of each chunk, up to its first path.
        rows, steps, hidden = inner, came[inner], []
        keys = mix(np.arange(len(chunks), dtype=np.uint64))
        while len(rows):
            hidden.append((rows, self.places[steps]))
            steps = self.came[self.path_of[steps]]
            rows, steps = rows[steps >= 0], steps[steps >= 0]
        group = np.cumsum(np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))) // _ROUND_SYMBOLS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(chunks)]
        owners, places = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            skipped = [mix(keys[r[own]] ^ p[own]) for r, p in hidden if (own := (r >= low) & (r < high)).any()]
            merges: list = []
            self.ids_of += self.segment(chunks[low:high], keys[low:high], 0, np.concatenate(skipped) if skipped else None, merges)
            owners += [own.astype(np.int64) + low for own, _ in merges]
            places += [place for _, place in merges]
        owner, place = np.concatenate(owners), np.concatenate(places)
        order = np.argsort(owner, kind="stable")
        owner, place = owner[order], place[order]
        made = np.bincount(owner, minlength=len(chunks))
        later = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) >= done[owner]
        owner, place, length = owner[later], place[later], made - done
        numbers = np.arange(len(self.chunk_of), len(self.chunk_of) + len(chunks))
        self.chunk_of += chunks
        self.first = np.r_[self.first, len(self.places) + np.cumsum(length) - length]
        self.length, self.done, self.came = np.r_[self.length, length], np.r_[self.done, done], np.r_[self.came, came]
        self.places, self.child = np.r_[self.places, place], np.r_[self.child, np.full(len(place), -1, dtype=np.int32)]
        self.path_of = np.r_[self.path_of, numbers[owner].astype(np.int32)]
        return numbers

    def _skips(self, keys: np.ndarray, path: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose path has a skipped merge under their key, and the first such merge."""
        rows, steps = [], []
        for low in range(0, len(path), _BLOCK):
            part = path[low : low + _BLOCK]
            n = self.length[part]
            row = np.repeat(np.arange(len(part)), n)
            step = np.arange(len(row)) + np.repeat(self.first[part] - (np.cumsum(n) - n), n)
            hits = np.flatnonzero((mix(keys[low : low + _BLOCK][row] ^ self.places[step]) >> np.uint64(11)) < np.uint64(threshold))
            if len(hits):
                hits = hits[np.r_[True, row[hits[1:]] != row[hits[:-1]]]]
            rows.append(row[hits] + low)
            steps.append(step[hits])
        return np.concatenate(rows), np.concatenate(steps)

    def encode(self, texts: list[str], doc_keys: np.ndarray, seed: int, dropout: float, variants: int | None = None) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes (``variants`` has no effect)."""
        threshold = round(dropout * (1 << 53))
        if len(self.chunk_of) > _MEMORY:
            self._forget()
        texts = [f"{_BLANK}{t.replace(_BLANK, _LITERAL) if _BLANK in t else t}".replace(" ", _BLANK) if t else "" for t in texts]
        split = [_CHUNKS.findall(t) for t in texts]
        counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        chunks = list(chain.from_iterable(split))
        new = [c for c in set(chunks) - self.roots.keys() if len(c) <= _LONG]
        if new:
            self.roots.update(zip(new, self._learn(new, np.full(len(new), -1)).tolist()))
        path = np.fromiter(map(self.roots.get, chunks, repeat(0)), dtype=np.int64, count=len(chunks))
        keys = np.arange(len(chunks)) - np.repeat(np.cumsum(counts) - counts, counts)
        keys = mix(np.repeat(doc_keys, counts) ^ mix(keys.astype(np.uint64) + mix(np.full(1, seed, dtype=np.uint64))))
        todo, afresh = np.flatnonzero(path), [np.flatnonzero(path == 0)]
        while threshold and len(todo):
            rows, steps = self._skips(keys[todo], path[todo], threshold)
            todo = todo[rows]
            missing, n = np.unique(steps[self.child[steps] < 0], return_counts=True)
            missing = missing[n > 1]
            if len(missing):
                self.child[missing] = self._learn([self.chunk_of[k] for k in self.path_of[missing].tolist()], missing)
            known = self.child[steps] >= 0
            afresh.append(todo[~known])
            todo = todo[known]
            path[todo] = self.child[steps[known]]
        found = list(map(self.ids_of.__getitem__, path.tolist()))
        alone = np.concatenate(afresh)
        group = np.cumsum(np.fromiter((len(chunks[k]) for k in alone.tolist()), dtype=np.int64, count=len(alone))) // _ROUND_SYMBOLS
        for rows in np.split(alone, np.flatnonzero(np.diff(group)) + 1) if len(alone) else ():
            for k, ids in zip(rows.tolist(), self.segment([chunks[k] for k in rows.tolist()], keys[rows], threshold)):
                found[k] = ids
        stops = np.cumsum(counts).tolist()
        return [b"".join(found[low:high]) for low, high in zip([0, *stops], stops)]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the text of the ids; the blank put before every text goes."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))[1:]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _doc_keys(keys: list[str]) -> np.ndarray:
    return mix(np.array([zlib.crc32(k.encode()) for k in keys], dtype=np.uint64))


def _encode(batches: Iterator[pa.RecordBatch], path: str, seed: int, dropout: float, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The input's columns but the last two (key, text) with ids, count and the round trip's outcome."""
    model = pieces(path)
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(batch.num_columns - 1)).fill_null(0), dtype=np.int64)
        group = np.cumsum(sizes) // _GROUP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
        for low, high in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(low, high - low)
            texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
            coded = model.encode(texts, _doc_keys(part.column(part.num_columns - 2).to_pylist()), seed, dropout)
            arrays = [np.frombuffer(c, dtype="<u4") for c in coded]
            offsets = np.cumsum([0, *(len(a) for a in arrays)]).astype(np.int32)
            flat = np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)
            lossless = [model.decode(a) == t.encode() for a, t in zip(arrays, texts)]
            added = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(np.diff(offsets).astype(np.int64)), pa.array(lossless)]
            kept = part.columns[:-2]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=names)


def encode(
    docs: DataFrame, model: str, *, dropout: float = DROPOUT, seed: int = SEED, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (all columns by default) with piece_ids, n_pieces and lossless (decoding gives the text back).

    Documents stay where they are: one map over the texts, no shuffle.
    """
    if not 0 <= dropout < 1:
        raise ValueError("dropout must be in [0, 1)")
    ship_package(docs.sparkSession)
    kept = docs.columns if keep is None else keep
    added = [free_name(kept, name) for name in ("piece_ids", "n_pieces", "lossless")]
    rows = docs.select(*kept, F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_key"), F.col(text).alias("_text"))
    kinds = (T.ArrayType(T.IntegerType()), T.LongType(), T.BooleanType())
    schema = T.StructType([*docs.select(*kept).schema.fields, *(T.StructField(n, k) for n, k in zip(added, kinds))])
    return rows.mapInArrow(partial(_encode, path=model, seed=seed, dropout=dropout, names=schema.names), schema)


def _decode(batches: Iterator[pa.RecordBatch], path: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    model = pieces(path)
    for batch in batches:
        texts = [None if ids is None else model.decode(np.array(ids, dtype=np.int64)).decode() for ids in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=names)


def decode(frame: DataFrame, model: str, *, ids: str = "piece_ids", into: str = "decoded") -> DataFrame:
    """``frame`` with the text of its ids; null ids give a null text."""
    ship_package(frame.sparkSession)
    into = free_name(frame.columns, into)
    schema = T.StructType([*frame.schema.fields, T.StructField(into, T.StringType())])
    return frame.select("*", F.col(ids).alias("_ids")).mapInArrow(partial(_decode, path=model, names=schema.names), schema)
