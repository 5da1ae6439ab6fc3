"""License scan by patience alignment of texts with license templates.

In a stretch of text and a template, the words that occur once in both are anchors; the
longest increasing subsequence of their places is kept, and the gaps between the anchors
are aligned in the same way.  The share of the template's words so matched is the coverage.

A whole document would hide anchors that stray words repeat, so stretches come first: runs
of template words with at most ``reach`` other words between two, or a quarter of the
template's length if that is more, which hold enough of the template's words, each counted as
often as both have it; no passage with the coverage wanted can hold fewer.  Matched words
with longer gaps between them are passages of one match, if each has a few words.  A stretch longer than the template by a tenth is also tried in overlapping
pieces of two template lengths, and wherever the template may begin, so that repeated licenses are
found; no part of a text is left out.  Of overlapping matches the one with more words wins, then the
shorter passage; one that joins two copies side by side gives way to them.

Words are runs of ASCII letters and digits in lower case.  Defined cases: null, empty and
wordless texts have no match; a template found several times gives a row for each; rows
that repeat a document are scanned as rows.  An empty table gives no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm.license_texts import FOREIGN, NAMING, STATEMENTS, TEXTS
from docstrata.session import ship_package

COVERAGE, REACH = 0.8, 12
_BRIDGE, _PASSAGE_WORDS, _AFTER = 0.25, 4, 10
_WORD = re.compile(r"[a-z0-9]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Template:
    """A wording of a license, the words of it that a match must hold, and what tells it from its relatives.

    Each phrase of ``naming`` must stand in the text as a whole, its last word matched at an
    end of the phrase in the template; no phrase of ``foreign`` may stand in the passage or in
    the few words after it.
    """

    license: str
    words: tuple[str, ...]
    needed: frozenset[str] = frozenset()
    naming: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[str, ...], ...] = ()

    @cached_property
    def counted(self) -> Counter[str]:
        return Counter(self.words)

    @cached_property
    def named_at(self) -> list[tuple[tuple[str, ...], list[int]]]:
        return [(p, [k for k in range(len(p) - 1, len(self.words)) if self.words[k - len(p) + 1 : k + 1] == p]) for p in self.naming]

    def accepts(self, words: list[str], pairs: list[tuple[int, int]]) -> bool:
        """Whether matched (text place, template place) pairs are of this license."""
        place = {j: i for i, j in pairs}
        if not self.needed <= {self.words[j] for j in place}:
            return False
        for phrase, ends in self.named_at:
            if not any(j in place and tuple(words[max(place[j] - len(phrase) + 1, 0) : place[j] + 1]) == phrase for j in ends):
                return False
        low, high = pairs[0][0], min(pairs[-1][0] + 1 + _AFTER, len(words))
        return not any(tuple(words[k : k + len(p)]) == p for p in self.foreign for k in range(low, high - len(p) + 1))


def _phrases(of: dict[str, list[str]], name: str) -> tuple[tuple[str, ...], ...]:
    return tuple(tuple(p.split()) for p in of.get(name, ()))


def templates() -> list[Template]:
    full = [Template(name, tuple(words_of(text)), frozenset(), _phrases(NAMING, name), _phrases(FOREIGN, name)) for name, text in TEXTS.items()]
    return full + [Template(name, tuple(words_of(text)), frozenset(needed.split()), (), _phrases(FOREIGN, name)) for name, text, needed in STATEMENTS]


def increasing(values: list[int]) -> list[int]:
    """Places of one longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        if pile == len(tops):
            tops.append(value)
            piles.append(i)
        else:
            tops[pile], piles[pile] = value, i
        before[i] = piles[pile - 1] if pile else -1
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: list[str], template: tuple[str, ...] | list[str]) -> list[tuple[int, int]]:
    """Matched (text place, template place) pairs, increasing in both."""
    pairs, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        place = {template[k]: k for k in range(c, d) if in_template[template[k]] == 1}
        anchors = [(i, place[text[i]]) for i in range(a, b) if in_text[text[i]] == 1 and text[i] in place]
        chosen = [anchors[k] for k in increasing([j for _, j in anchors])]
        pairs.extend(chosen)
        if chosen:
            edges = [(a - 1, c - 1), *chosen, (b, d)]
            todo.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if k > i + 1 and m > j + 1)
    return sorted(pairs)


def _passages(pairs: list[tuple[int, int]], reach: int, bridge: int) -> list[list[tuple[int, int]]]:
    """The passages with the most pairs that make up one match.

    Within a passage the text has gaps of ``reach`` words at most, between two passages of a
    match ``bridge`` words; several passages have ``_PASSAGE_WORDS`` or more each.
    """
    runs: list[list[tuple[int, int]]] = []
    for pair in pairs:
        if not runs or pair[0] - runs[-1][-1][0] > reach + 1:
            runs.append([])
        runs[-1].append(pair)
    groups: list[list[list[tuple[int, int]]]] = []
    for run in runs:
        if len(run) >= _PASSAGE_WORDS:
            if not groups or run[0][0] - groups[-1][-1][-1][0] > bridge + 1:
                groups.append([])
            groups[-1].append(run)
    return max([*groups, *([run] for run in runs)], key=lambda group: sum(map(len, group)), default=[])


@dataclass(frozen=True)
class Match:
    license: str
    template: int
    matched: int
    template_words: int
    start: int  # places of the first matched word and after the last
    end: int
    passages: tuple[tuple[int, int], ...]


def _apart(own: set[Match]) -> list[Match]:
    """Matches of one template without those that join two others, the start of one copy and the end of the next."""
    by_end = sorted(own, key=lambda m: (m.end, m.start))
    ends = [m.end for m in by_end]
    out = []
    for match in by_end:
        at, inside = match.start, 0
        for k in range(bisect_left(ends, match.start), len(ends)):
            if ends[k] > match.end or inside == 2:
                break
            if by_end[k].start >= at:
                at, inside = ends[k], inside + 1
        if inside < 2:
            out.append(match)
    return out


class Scanner:
    """Finds all templates in word lists."""

    def __init__(self, known: list[Template] | None = None, coverage: float = COVERAGE, reach: int = REACH):
        self.templates = templates() if known is None else known
        self.coverage, self.reach = coverage, reach
        self.of_word: dict[str, list[int]] = defaultdict(list)
        for number, template in enumerate(self.templates):
            for word in template.counted:
                self.of_word[word].append(number)
        self.vocabulary = set(self.of_word)

    def _bridge(self, number: int) -> int:
        return max(self.reach, int(_BRIDGE * len(self.templates[number].words)))

    def _try(self, words: list[str], low: int, high: int, number: int) -> Match | None:
        template = self.templates[number]
        passages = _passages([(low + i, j) for i, j in align(words[low:high], template.words)], self.reach, self._bridge(number))
        pairs = [pair for passage in passages for pair in passage]
        if not pairs or len(pairs) < self.coverage * len(template.words) or not template.accepts(words, pairs):
            return None
        return Match(template.license, number, len(pairs), len(template.words), pairs[0][0], pairs[-1][0] + 1, tuple((p[0][0], p[-1][0] + 1) for p in passages))

    @staticmethod
    def _stretches(places: list[int], gap: int) -> Iterator[tuple[int, int]]:
        start = last = places[0]
        for place in places[1:]:
            if place - last > gap + 1:
                yield start, last + 1
                start = place
            last = place
        yield start, last + 1

    def scan(self, words: list[str]) -> list[Match]:
        present = self.vocabulary.intersection(words)
        if not present:
            return []
        # No passage matches more words than text and template have in common, with repeats.
        held: Counter[int] = Counter()
        for word in present:
            for number in self.of_word[word]:
                held[number] += self.templates[number].counted[word]
        enough = lambda number, k: k >= self.coverage * len(self.templates[number].words)
        likely = [n for n, k in held.items() if enough(n, k) and self.templates[n].needed <= present]
        if not likely:
            return []
        where: dict[str, list[int]] = defaultdict(list)
        for place, word in enumerate(words):
            if word in present:
                where[word].append(place)
        found: list[Match] = []
        for number in sorted(likely):
            template = self.templates[number]
            size = len(template.words)
            own: set[Match] = set()
            if not enough(number, sum(min(k, len(where[word])) for word, k in template.counted.items() if word in present)):
                continue
            for low, high in self._stretches(sorted(p for word in template.counted if word in present for p in where[word]), self._bridge(number)):
                if high - low < self.coverage * size or not enough(number, (Counter(words[low:high]) & template.counted).total()):
                    continue
                windows = [(low, high)]
                if high - low > 1.1 * size:
                    windows += [(k, min(k + 2 * size, high)) for k in range(low, high, max(1, size // 2))]
                    # Copies close together share all words: try where the template may begin.
                    windows += [
                        (max(p - k, low), min(p - k + size + size // 10, high))
                        for k, word in enumerate(template.words[:3]) for p in where[word] if low <= p < high
                    ]
                own.update(match for a, b in windows if (match := self._try(words, a, b, number)))
            found += _apart(own)
        out: list[Match] = []
        taken: list[tuple[int, int]] = []
        for match in sorted(found, key=lambda m: (-m.matched, -m.matched / m.template_words, m.end - m.start, m.start, m.template)):
            if all(match.end <= a or match.start >= b for a, b in taken):
                taken.append((match.start, match.end))
                out.append(match)
        return sorted(out, key=lambda m: m.start)


_FOUND = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.string())
_NAMES = ["license", "matched_words", "template_words", "coverage", "start_word", "end_word", "passage"]


def _scan(batches: Iterator[pa.RecordBatch], known: list[Template] | None, coverage: float, reach: int) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(known, coverage, reach)
    for batch in batches:
        rows, out = [], []
        for row, text in enumerate(batch.column(1)):
            text = text.as_py()
            if not text:
                continue
            lowered = text.lower()
            words = _WORD.findall(lowered)
            for match in scanner.scan(words):
                passage = " ... ".join(" ".join(words[a:b]) for a, b in match.passages)
                rows.append(row)
                out.append((match.license, match.matched, match.template_words, match.matched / match.template_words, match.start, match.end, passage))
        columns = [pa.array(c, t) for c, t in zip(zip(*out), _FOUND)] if out else [pa.array([], t) for t in _FOUND]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], names=["doc_id", *_NAMES])


def license_matches(
    docs: DataFrame, *, known: list[Template] | None = None, coverage: float = COVERAGE, reach: int = REACH, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """A row for each license passage of each document: one map over the texts, no shuffle."""
    ship_package(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        partial(_scan, known=known, coverage=coverage, reach=reach),
        f"doc_id {kind}, license string, matched_words bigint, template_words bigint, coverage double, start_word bigint, end_word bigint, passage string",
    )
