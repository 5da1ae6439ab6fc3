"""Language-model scores from a class bigram model with exchange clustering (Brown classes).

    p(word | word before) = p(class | class before) * p(word | class)

Clustering has two phases.  First the words with at least ``min_share`` of the training
tokens and groups of all others by their last three bytes are exchanged in sweeps: a sweep
takes each unit's neighbours by class from the counts of neighbouring units.  Then every
word with ``least_count`` occurrences, an absolute number, is a unit of its own: a pass over
the texts counts its neighbours by class, and it moves to the class that suits it best,
starting from its group's.  Only words below that count, and unknown ones, stay in their
groups.  Parts of the units are exchanged side by side, each part unit by unit against its
own running copy of the class table (K x K), as in distributed exchange clustering; there
are as many parts as the units need.  The end of a text is a class of its own.

Smoothing: class transitions are interpolated with class shares; every class keeps the mass
of its words seen once (and a half) for unknown words, which count as one word a class.

Counts cover all training tokens.  The words with their counts and classes are a table; only
the class table, the units of the first phase and totals reach the driver, all bounded by
parameters.  A worker keeps the table if it has at most ``local_words`` rows.  A larger one is
read in parts of that size, once for every ``_HELD_TOKENS`` tokens of a task, with the same
results; texts and tokens are never shuffled.  The passes that count neighbours need only the
words that are units.  A task sums the neighbours of a word before it hands them over, a row
a word; a part takes these rows as they come and holds its units' sums alone.

Defined cases: a null or wordless text has only the end token.  A null id is held out by
the checksum of the empty text.  Without training documents every probability is 1.  Rows
equal in id and text have equal scores.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow.dataset import dataset
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.llm.storage import filesystem, settings, staged, workspace
from docstrata.llm.words import Words, blocks, hash_words, mix

CLASSES, MIN_SHARE, LEAST_COUNT, GROUPS, SWEEPS, LOCAL_WORDS = 64, 1e-4, 20, 2048, 6, 8_000_000
_BUFFER_TOKENS, _BUFFER_KEYS, _UNITS_A_PART = 1_000_000, 1_000_000, 500
# A worker holds a batch of texts and the hashes of one block beside its counts.
_BLOCK_BYTES, _ROWS_A_BATCH = 1 << 20, 1000
# Beside a part of a table: about 9 bytes a token, without the texts.
_HELD_TOKENS = 8_000_000
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(_ROWS_A_BATCH), "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
_ALPHA = 10.0


def _groups(words: Words, groups: int) -> np.ndarray:
    return _tail_groups(words.tails, groups)


def _tail_groups(tails: np.ndarray, groups: int) -> np.ndarray:
    return (mix(tails.astype(np.uint64)) % np.uint64(groups)).astype(np.int32)


def _count_words(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Partial counts of words: hash, group, n."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        hashes, group = (np.concatenate(x) for x in zip(*held))
        held.clear()
        values, first, n = np.unique(hashes, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(group[first]), pa.array(n)], names=["hash", "group", "n"])

    for batch in batches:
        for _, block in blocks(batch.column(0), _BLOCK_BYTES):
            words = hash_words(block)
            held.append((words.hashes, _groups(words, groups)))
            if sum(len(h) for h, _ in held) >= _BUFFER_TOKENS:
                yield flush()
    if held:
        yield flush()


@dataclass(frozen=True)
class Units:
    """Exchange units: 0 is the end of a text, then frequent words by hash, then groups."""

    frequent: np.ndarray  # ascending hashes
    groups: int

    @property
    def count(self) -> int:
        return 1 + len(self.frequent) + self.groups

    def of(self, words: Words) -> np.ndarray:
        unit = 1 + len(self.frequent) + _groups(words, self.groups).astype(np.int64)
        if len(self.frequent):
            spot = np.minimum(np.searchsorted(self.frequent, words.hashes), len(self.frequent) - 1)
            unit = np.where(self.frequent[spot] == words.hashes, 1 + spot, unit)
        return unit


def _with_ends(values: np.ndarray, bounds: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """Values of consecutive texts with an end after each, and where each text begins."""
    n = len(bounds) - 1
    out = np.full(len(values) + n, end, dtype=values.dtype)
    place = np.ones(len(out), dtype=bool)
    place[bounds[1:] + np.arange(n)] = False
    out[place] = values
    return out, bounds[:-1] + np.arange(n)


def _count_pairs(batches: Iterator[pa.RecordBatch], units: Units) -> Iterator[pa.RecordBatch]:
    """Partial counts of neighbouring units: a, b, n."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array((codes // units.count).astype(np.int32)), pa.array((codes % units.count).astype(np.int32)), pa.array(n)], names=["a", "b", "n"])

    for batch in batches:
        for _, block in blocks(batch.column(0), _BLOCK_BYTES):
            words = hash_words(block)
            line, _ = _with_ends(units.of(words), words.bounds, 0)
            held.append(np.r_[0, line[:-1]] * units.count + line)
            size += len(line)
            if size >= _BUFFER_TOKENS:
                yield flush()
                size = 0
    if held:
        yield flush()


def _plogp(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


@dataclass(frozen=True)
class Contexts:
    """How often units, ascending, have which classes beside them."""

    units: np.ndarray
    old: np.ndarray  # their classes
    own: np.ndarray  # how often each follows itself
    keys: np.ndarray  # ascending: (the unit's place * 2 + side) * classes + class; side 0 before, 1 after
    n: np.ndarray  # of each key


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys with their sums."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(n, starts)


def _merged(parts: list[Contexts], classes: int) -> Contexts:
    """One of many; a part may name a unit more than once."""
    width = 2 * classes
    units, first, place = np.unique(np.concatenate([p.units for p in parts]), return_index=True, return_inverse=True)
    begins = np.cumsum([0, *(len(p.units) for p in parts)])
    keys = np.concatenate([place[p.keys // width + begin] * width + p.keys % width for p, begin in zip(parts, begins)])
    own = np.bincount(place, np.concatenate([p.own for p in parts]), minlength=len(units)).astype(np.int64)
    return Contexts(units, np.concatenate([p.old for p in parts])[first], own, *_summed(keys, np.concatenate([p.n for p in parts])))


def _merging(parts: Iterator[Contexts], classes: int, most: int | None = None) -> Iterator[Contexts]:
    """Sums of parts as they come, so that only distinct keys are held; given out from ``most`` keys on, else at the end."""
    held, size, at = [], 0, _BUFFER_KEYS
    for part in parts:
        held.append(part)
        size += len(part.keys)
        if size >= at:
            held = [_merged(held, classes)]
            size = len(held[0].keys)
            if most is not None and size >= most:
                yield held.pop()
                size = 0
            at = max(_BUFFER_KEYS, 2 * size)
    if held:
        yield _merged(held, classes)


def _context_rows(found: Contexts, classes: int) -> Iterator[pa.RecordBatch]:
    """A row a unit: unit, old, own, code, n (lists)."""
    bounds = np.searchsorted(found.keys, np.arange(len(found.units) + 1) * (2 * classes)).astype(np.int32)
    code = (found.keys % (2 * classes)).astype(np.int16)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(found.units), pa.array(found.old.astype(np.int32)), pa.array(found.own), pa.ListArray.from_arrays(bounds, pa.array(code)), pa.ListArray.from_arrays(bounds, pa.array(found.n))],
        names=["unit", "old", "own", "code", "n"],
    )
    for begin in range(0, batch.num_rows, _ROWS_A_BATCH):
        yield batch.slice(begin, _ROWS_A_BATCH)


def _contexts_of(batch: pa.RecordBatch, classes: int) -> Contexts:
    """Of rows unit, old, own, code, n; code and n are values or lists."""
    unit, old, own, code, n = (batch.column(name) for name in ("unit", "old", "own", "code", "n"))
    place = np.arange(batch.num_rows)
    if pa.types.is_list(code.type):
        place, code, n = np.repeat(place, pa.compute.list_value_length(code).to_numpy()), code.flatten(), n.flatten()
    return Contexts(unit.to_numpy(), old.to_numpy(), own.to_numpy(), place * (2 * classes) + code.to_numpy(), n.to_numpy())


def _exchange(found: Contexts, table: np.ndarray) -> np.ndarray:
    """Move each unit of one part to the class that most raises the class bigram likelihood.

    The end's class, the last, neither gives nor takes units.
    """
    table, k = table.copy(), len(table)
    logs = _plogp(table)
    beside = np.bincount(found.keys, found.n, minlength=len(found.units) * 2 * k).reshape(-1, 2, k)
    moved = found.old.copy()
    for place, old in enumerate(found.old.tolist()):
        if old == k - 1:
            continue
        (before, after), own = beside[place], float(found.own[place])
        total_after, total_before = after.sum(), before.sum()
        table[old] -= after
        table[:, old] -= before
        table[old, old] += own
        after[old] -= own
        before[old] -= own
        logs[old], logs[:, old] = _plogp(table[old]), _plogp(table[:, old])
        # Only classes beside the unit change anything.
        right, above = np.flatnonzero(after), np.flatnonzero(before)
        up, left_corner = np.zeros((k, k)), np.zeros(k)
        up[:, right] = _plogp(table[:, right] + after[right]) - logs[:, right]
        left = _plogp(table[above] + before[above, None]) - logs[above]
        left_corner[above] = left[np.arange(len(above)), above]
        corner = np.diagonal(table)
        rows_of, columns_of = table.sum(1), table.sum(0)
        sums = _plogp(np.concatenate([corner + after + before + own, corner, rows_of + total_after, rows_of, columns_of + total_before, columns_of])).reshape(6, k)
        gain = up.sum(1) - np.diagonal(up) + left.sum(0) - left_corner + sums[0] - sums[1]
        gain -= sums[2] - sums[3] + sums[4] - sums[5]
        gain[k - 1] = -np.inf
        new = int(np.argmax(gain))
        table[new] += after
        table[:, new] += before
        table[new, new] += own
        logs[new], logs[:, new] = _plogp(table[new]), _plogp(table[:, new])
        moved[place] = new
    return moved


def _moves(contexts: DataFrame, units: int, table: np.ndarray, seed: int) -> DataFrame:
    """(unit, new) from the contexts of all units."""
    part = F.pmod(F.xxhash64("unit", F.lit(seed)), F.lit(-(-units // _UNITS_A_PART)))
    classes = len(table)

    def exchange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _merging((_contexts_of(batch, classes) for batch in batches), classes):
            new = _exchange(found, table)
            some = found.old != classes - 1
            yield pa.RecordBatch.from_arrays([pa.array(found.units[some]), pa.array(new[some].astype(np.int32))], names=["unit", "new"])

    return contexts.groupBy(part.alias("part")).applyInArrow(exchange, "unit bigint, new int")


@dataclass(frozen=True)
class Vocabulary:
    """Words with counts and classes: a table, and the classes of the groups of all other words."""

    path: str  # table of hash, n, class, in files by ascending hash
    rows: int
    group_class: np.ndarray
    classes: int

    def lines(self, batches: Iterator[pa.RecordBatch], column: int, local_words: int = LOCAL_WORDS) -> Iterator[tuple[list[pa.Array], Line]]:
        """The other columns and the tokens of blocks of texts, looked up in the table."""
        held, size = [], 0
        for batch in batches:
            for begin, block in blocks(batch.column(column), _BLOCK_BYTES):
                # Copies, so that no text is held.
                rows = pa.array(np.arange(begin, begin + len(block)))
                held.append(([c.take(rows) for k, c in enumerate(batch.columns) if k != column], self._unknown(block)))
                size += len(held[-1][1].spots) + len(block)
                if self.rows <= local_words or size >= _HELD_TOKENS:
                    yield from self._known(held, local_words)
                    held, size = [], 0
        yield from self._known(held, local_words)

    def _unknown(self, block: pa.Array) -> Line:
        """Tokens of texts as if none were in the table."""
        words = hash_words(block)
        distinct, first, spots = np.unique(words.hashes.view(np.int64), return_index=True, return_inverse=True)
        classes = self.group_class[_tail_groups(words.tails[first], len(self.group_class))]
        return Line(distinct, np.zeros(len(distinct), np.int64), classes, spots.astype(np.int32), words.bounds)

    def _known(self, held: list[tuple[list[pa.Array], Line]], local_words: int) -> Iterator[tuple[list[pa.Array], Line]]:
        if held:
            for part in [_loaded(self.path)] if self.rows <= local_words else _parts(self.path, max(local_words, 1)):
                for _, line in held:
                    line.look_up(*part)
        yield from held


@dataclass(frozen=True)
class Line:
    """Tokens of consecutive texts: places in distinct words."""

    words: np.ndarray  # ascending hashes
    word_counts: np.ndarray
    word_classes: np.ndarray
    spots: np.ndarray
    bounds: np.ndarray

    def look_up(self, hashes: np.ndarray, n: np.ndarray, classes: np.ndarray) -> None:
        """Take the counts and classes of a table's words, by ascending hashes; other words stay as they are."""
        if len(hashes):
            begin, end = np.searchsorted(self.words, hashes[0]), np.searchsorted(self.words, hashes[-1], "right")
            spot = np.searchsorted(hashes, self.words[begin:end])
            there = np.flatnonzero(hashes[spot] == self.words[begin:end])
            self.word_counts[begin + there], self.word_classes[begin + there] = n[spot[there]], classes[spot[there]]

    @property
    def counts(self) -> np.ndarray:
        return self.word_counts[self.spots]

    @property
    def classes(self) -> np.ndarray:
        return self.word_classes[self.spots]


_tables: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _loaded(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending hashes, counts and classes of a vocabulary table; its files are in this order.

    A worker keeps the last table alone, and lets go of it before it loads another.
    """
    if path not in _tables:
        _tables.clear()
        _tables[path] = next(_parts(path))
    return _tables[path]


def _parts(path: str, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A vocabulary table in parts of at most ``most`` rows, or whole; each is good until the next one.

    File by file, into the narrowest types, so that a worker holds little more than a part.
    """
    if most is not None:
        _tables.clear()
    store, root = filesystem(path)
    files = list(dataset(root, filesystem=store, format="parquet").get_fragments())
    rows = sum(file.metadata.num_rows for file in files)
    # Parts of one size.
    size = rows if most is None or not rows else -(-rows // -(-rows // most))
    columns, filled = [np.empty(size, kind) for kind in (np.int64, np.int32, np.int16)], 0

    def part() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [c[:filled] for c in columns]
        if filled and not (found[0][1:] > found[0][:-1]).all():
            order = np.argsort(found[0])
            found = [c[order] for c in found]
        return tuple(found)

    for file in files:
        table = file.to_table(columns=["hash", "n", "class"])
        begin = 0
        while begin < len(table):
            taken = min(len(table) - begin, size - filled)
            for k, name in enumerate(("hash", "n", "class")):
                values = table.column(name).slice(begin, taken).to_numpy()
                if name == "n" and columns[k].dtype == np.int32 and values.max() >= 1 << 31:
                    columns[k] = columns[k].astype(np.int64)
                columns[k][filled : filled + taken] = values
            begin, filled = begin + taken, filled + taken
            if filled == size:
                yield part()
                filled = 0
    if filled or not rows:
        yield part()


def _unit_contexts(lines: Iterator[tuple[list[pa.Array], Line]], classes: int, least: int) -> Iterator[pa.RecordBatch]:
    """Partial contexts of all words with ``least`` or more occurrences: unit, old, own, code, n (lists)."""

    def parts() -> Iterator[Contexts]:
        for _, line in lines:
            unit = line.word_counts >= least
            # An end has the place -1, which is the last.
            spot, _ = _with_ends(line.spots, line.bounds, -1)
            place = np.r_[np.where(unit, np.cumsum(unit) - 1, -1), -1][spot]
            class_of = np.r_[line.word_classes, classes - 1][spot]
            some, again = place >= 0, np.flatnonzero((place[:-1] >= 0) & (place[:-1] == place[1:]))
            sides = (np.r_[classes - 1, class_of[:-1]], classes + np.r_[class_of[1:], classes - 1])
            keys = np.concatenate([(place * (2 * classes) + side)[some] for side in sides])
            keys, n = np.unique(keys, return_counts=True)
            own = np.bincount(place[again], minlength=int(unit.sum()))
            yield Contexts(line.words[unit], line.word_classes[unit], own, keys, n)

    for found in _merging(parts(), classes, _BUFFER_KEYS // 2):
        yield from _context_rows(found, classes)


def _class_table(lines: Iterator[tuple[list[pa.Array], Line]], classes: int) -> Iterator[pa.RecordBatch]:
    """The task's counts of neighbouring classes."""
    table = np.zeros(classes * classes)
    for _, line in lines:
        class_of, _ = _with_ends(line.classes, line.bounds, classes - 1)
        table += np.bincount(np.r_[classes - 1, class_of[:-1]] * classes + class_of, minlength=classes * classes)
    some = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array((some // classes).astype(np.int32)), pa.array((some % classes).astype(np.int32)), pa.array(table[some].astype(np.int64))], names=["ca", "cb", "n"])


@dataclass(frozen=True)
class Model:
    """All that scoring needs besides the vocabulary's table."""

    vocabulary: Vocabulary
    transitions: np.ndarray  # log10 p(class | class before)
    known: np.ndarray  # by class: log10 of what a word's count is divided by
    unknown: np.ndarray  # by class: log10 p(an unknown word | class)
    docs: int
    tokens: int
    words: int

    def score(self, line: Line) -> dict[str, np.ndarray]:
        """n_tokens, n_known, base_score and score of consecutive texts."""
        end = self.vocabulary.classes - 1
        classes, starts = _with_ends(line.classes, line.bounds, end)
        n, _ = _with_ends(line.counts, line.bounds, self.docs)
        if not len(starts):
            return {k: np.zeros(0) for k in ("n_tokens", "n_known", "base_score", "score")}
        before = np.r_[end, classes[:-1]]
        seen = n > 0
        emitted = np.where(seen, np.log10(np.maximum(n, 1)) - self.known[classes], self.unknown[classes])
        base = np.log10((n + 1) / (self.tokens + self.words + 1))
        sums = {"n_known": seen.astype(np.int64), "base_score": base, "score": self.transitions[before, classes] + emitted}
        return {"n_tokens": np.diff(line.bounds) + 1} | {k: np.add.reduceat(v, starts) for k, v in sums.items()}


def _coarse_classes(texts: DataFrame, counts: DataFrame, tokens: int, classes: int, min_share: float, groups: int, sweeps: int, folder: str) -> tuple[Units, np.ndarray, np.ndarray]:
    """The first phase: units, their classes and the class table."""
    # At most 1 / min_share rows.
    hashes = [row["hash"] for row in counts.where(F.col("n") >= max(2, min_share * tokens)).select("hash").collect()]
    units = Units(np.sort(np.array(hashes, dtype=np.int64).view(np.uint64)), groups)
    pairs = staged(
        texts.mapInArrow(partial(_count_pairs, units=units), "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")), f"{folder}/pairs"
    )
    class_of = (mix(np.arange(units.count, dtype=np.uint64)) % np.uint64(classes - 1)).astype(np.int64)
    class_of[0] = classes - 1

    def class_pairs() -> np.ndarray:
        lookup = F.lit(class_of.tolist())
        return _table(pairs.select(F.get(lookup, F.col("a")).alias("ca"), F.get(lookup, F.col("b")).alias("cb"), "n"), classes)

    table = class_pairs()
    for sweep in range(sweeps):
        lookup = F.lit(class_of.tolist())
        own = F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)
        side = lambda unit, other, code, own: pairs.select(
            F.col(unit).cast("bigint").alias("unit"), F.get(lookup, F.col(unit)).cast("int").alias("old"), (F.get(lookup, F.col(other)) + code).cast("int").alias("code"), "n", own.alias("own")  # noqa: B023
        )
        contexts = side("a", "b", classes, own).unionByName(side("b", "a", 0, F.lit(0).cast("bigint"))).groupBy("unit", "old", "code").agg(F.sum("n").alias("n"), F.sum("own").alias("own"))
        moves = _moves(contexts, units.count, table, sweep).collect()  # one row a unit
        changed = sum(class_of[row["unit"]] != row["new"] for row in moves)
        for row in moves:
            class_of[row["unit"]] = row["new"]
        table = class_pairs()
        if not changed:
            break
    return units, class_of, table


def _table(pairs: DataFrame, classes: int) -> np.ndarray:
    """The class table from (ca, cb, n); at most classes ** 2 rows reach the driver."""
    table = np.zeros((classes, classes))
    for row in pairs.groupBy("ca", "cb").agg(F.sum("n").alias("n")).collect():
        table[row["ca"], row["cb"]] = row["n"]
    return table


def _stored(words: DataFrame, path: str) -> DataFrame:
    """A vocabulary table in files by ascending hash."""
    return staged(words.select("hash", "n", F.col("class").cast("smallint").alias("class")).repartitionByRange("hash").sortWithinPartitions("hash"), path)


def _over(texts: DataFrame, vocabulary: Vocabulary, count, types: str, local_words: int) -> DataFrame:
    """``count`` of the tokens of all texts."""
    return texts.mapInArrow(lambda batches: count(vocabulary.lines(batches, 0, local_words)), types)


def fit(
    docs: DataFrame, *, text: str = "text", classes: int = CLASSES, min_share: float = MIN_SHARE, least_count: int = LEAST_COUNT, groups: int = GROUPS, sweeps: int = SWEEPS,
    local_words: int = LOCAL_WORDS, folder: str | None = None,
) -> Model:
    """Learn from every row of ``docs``."""
    with settings(docs.sparkSession, _BATCHES):
        return _fit(docs.select(F.col(text).alias("text")), classes, min_share, least_count, groups, sweeps, local_words, folder or workspace(docs.sparkSession, "classlm"))


def _fit(texts: DataFrame, classes: int, min_share: float, least_count: int, groups: int, sweeps: int, local_words: int, folder: str) -> Model:
    spark = texts.sparkSession
    counts = staged(
        texts.mapInArrow(partial(_count_words, groups=groups), "hash bigint, group int, n bigint").groupBy("hash").agg(F.sum("n").alias("n"), F.min("group").alias("group")),
        f"{folder}/counts",
    )
    n_docs = texts.count()
    totals = counts.agg(F.count("*").alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count_if(F.col("n") >= least_count).alias("units")).first()
    tokens, words = totals["tokens"] + n_docs, totals["words"] + (n_docs > 0)
    units, class_of, table = _coarse_classes(texts, counts, tokens, classes, min_share, groups, sweeps, folder)
    frequent = len(units.frequent)
    group_class = class_of[1 + frequent :].astype(np.int64)
    of_group = F.get(F.lit(group_class.tolist()), F.col("group"))
    listed = spark.createDataFrame([(h, int(c)) for h, c in zip(units.frequent.view(np.int64).tolist(), class_of[1 : 1 + frequent])], "hash bigint, class int")
    # All words whose class can be another than their group's.
    single = counts.join(F.broadcast(listed), "hash", "left").where((F.col("n") >= least_count) | F.col("class").isNotNull())
    single = _stored(single.select("hash", "n", F.coalesce("class", of_group).alias("class")), f"{folder}/coarse")
    if sweeps and totals["units"]:
        # The second phase: every word with enough occurrences by itself.
        coarse = Vocabulary(f"{folder}/coarse", single.count(), group_class, classes)
        contexts = _over(
            texts, coarse, partial(_unit_contexts, classes=classes, least=least_count), "unit bigint, old int, own bigint, code array<smallint>, n array<bigint>", local_words
        )
        moves = staged(_moves(contexts, totals["units"], table, sweeps), f"{folder}/moves")
        moved = single.join(moves, single["hash"] == moves["unit"], "left").select("hash", "n", F.coalesce("new", "class").alias("class"))
        single = _stored(moved, f"{folder}/moved")
        table = _table(_over(texts, Vocabulary(f"{folder}/moved", coarse.rows, group_class, classes), partial(_class_table, classes=classes), "ca int, cb int, n bigint", local_words), classes)
    vocabulary = Vocabulary(f"{folder}/vocabulary", totals["words"], group_class, classes)
    known = _stored(counts.join(single.select("hash", "class"), "hash", "left").select("hash", "n", F.coalesce("class", of_group).alias("class")), vocabulary.path)

    once = np.zeros(classes)
    for row in known.where("n = 1").groupBy("class").count().collect():
        once[row["class"]] = row["count"]
    held = once + 0.5
    held[classes - 1] = 0.0
    column, total = table.sum(0), table.sum()
    share = column / total if total else np.full(classes, 1 / classes)
    mass = column + held
    with np.errstate(divide="ignore"):
        log_mass, unknown = np.log10(np.maximum(mass, 1e-300)), np.log10(np.maximum(held, 1e-300) / np.maximum(mass, 1e-300))
    if not total:
        transitions, log_mass[:], unknown[:] = np.zeros((classes, classes)), 0.0, 0.0
    else:
        # A class without tokens keeps a little mass, so that a new unit in it is possible.
        share = (share + 1e-9) / (share + 1e-9).sum()
        transitions = np.log10((table + _ALPHA * share) / (table.sum(1, keepdims=True) + _ALPHA))
    return Model(vocabulary, transitions, log_mass, unknown, n_docs, tokens, words)


def _scored(ids: pa.Array, found: dict[str, np.ndarray]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([ids, *(pa.array(found[k], t) for k, t in zip(_SCORES, kinds))], names=["key", *_SCORES])


_SCORES = ("n_tokens", "n_known", "base_score", "score")
_SCORE_TYPES = "n_tokens bigint, n_known bigint, base_score double, score double"


def score(docs: DataFrame, model: Model, *, text: str = "text", doc_id: str = "doc_id", local_words: int = LOCAL_WORDS) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), line in model.vocabulary.lines(batches, 1, local_words):
            yield _scored(ids, model.score(line))

    return rows.mapInArrow(scored, f"key {id_type}, {_SCORE_TYPES}").withColumnRenamed("key", "doc_id")


def score_corpus(docs: DataFrame, held_out: Callable[[str], Column], *, text: str = "text", doc_id: str = "doc_id", local_words: int = LOCAL_WORDS, **options) -> DataFrame:
    """Learn from the rows that are not held out and score all rows; the scores are staged, so that their texts too move in small batches."""
    folder = options.pop("folder", None) or workspace(docs.sparkSession, "classlm")
    model = fit(docs.where(~held_out(doc_id)), text=text, local_words=local_words, folder=folder, **options)
    with settings(docs.sparkSession, _BATCHES):
        scored = staged(score(docs, model, text=text, doc_id=doc_id, local_words=local_words), f"{folder}/scores")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
