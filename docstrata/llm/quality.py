"""Quality rules combined by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document.  Expectation
maximisation, without labels, estimates how accurate every rule's votes are on good and on
bad documents, and the share of good documents; an abstention says nothing.  A document's posterior
probability of being good replaces the demand that every rule passes: a rule that fires alone on
many documents is found to be inaccurate, and its bad votes reject nothing by themselves.  The documents enter
as counts of vote patterns, of which there are at most 3 ** (number of rules), so the steps
of the estimate run over that bounded table and the texts are read once.

Defined cases: a null or wordless text has no words, every ratio rule abstains and it fails
the base rule.  Rules with empty denominators abstain.  An empty table gives no rows and no
estimate.  Added columns keep clear of the input's by ``free_name``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.llm.storage import staged, workspace
from docstrata.llm.words import SPACES

SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_calls"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that the text has twice or more.

    Windows are hashed; sorted by hash, equal neighbours are repeats.  The sorted starts of
    the repeated windows then cover min(3, distance to the next start) words each.
    """

    def starts_of(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            def start(x: Column, k: Column) -> Column:
                twin = (F.coalesce(F.get(s, k - 1).getField("h") == x.getField("h"), F.lit(False))) | (
                    F.coalesce(F.get(s, k + 1).getField("h") == x.getField("h"), F.lit(False))
                )
                return F.when(twin, x.getField("i")).otherwise(-1)

            return F.sort_array(F.filter(F.transform(s, start), lambda i: i >= 0))

        return _let(placed, repeated)

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - i, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def of_hashes(h: Column) -> Column:
        windows = F.transform(F.slice(h, 1, F.size(h) - 2), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
        return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_let(starts_of(w), covered)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 4, 0).otherwise(_let(hashes, of_hashes)).cast("bigint")


def measures(text: str | Column) -> list[Column]:
    """The columns of ``MEASURES`` for a text."""
    content = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    solid = _without(content, SPACES)
    words = F.split(F.trim(F.translate(content, SPACES, " " * len(SPACES))), " +")
    lines = F.filter(F.split(content, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)

    def dup_lines(own: Column) -> Column:
        return F.struct(F.size(own).cast("bigint").alias("n"), (F.size(own) - F.size(F.array_distinct(own))).cast("bigint").alias("dup"))

    counted = _let(lines, dup_lines)
    by_words = _let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n"), _repeat_words(w).alias("repeat")))
    by_words = F.when(solid == 0, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("repeat"))).otherwise(by_words)
    length = F.length(content)
    return [
        by_words.alias("by_words"), counted.alias("by_lines"), solid.cast("bigint").alias("word_chars"),
        (length - _without(content, SYMBOLS)).cast("bigint").alias("n_symbols"),
        (length - _without(content, _CAPITALS)).cast("bigint").alias("n_capitals"), (length - _without(content, "!?")).cast("bigint").alias("n_calls"),
    ]


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(
        *keys, F.col("by_words.n").alias("n_words"), "word_chars", "n_symbols", F.col("by_lines.dup").alias("n_dup_lines"), F.col("by_words.repeat").alias("n_repeat_words"),
        F.col("by_lines.n").alias("n_lines"), "n_capitals", "n_calls",
    )


def measured(docs: DataFrame, keys: list[Column], text: str = "text") -> DataFrame:
    """``keys`` and the measures of every document."""
    rows = docs.select(*keys, *measures(text))
    return _named(rows, [c for c in rows.columns if c not in ("by_words", "by_lines", *MEASURES)])


@dataclass(frozen=True)
class Rule:
    """A rule on ``part / whole``: good inside [good_from, good_to], bad outside [bad_below, bad_above]."""

    name: str
    part: str
    whole: str | None
    good_from: float
    good_to: float
    bad_below: float
    bad_above: float

    def vote(self) -> Column:
        value = F.col(self.part).cast("double") if self.whole is None else F.col(self.part) / F.nullif(F.col(self.whole).cast("double"), F.lit(0.0))
        return (
            F.when((value < self.bad_below) | (value > self.bad_above), -1)
            .when((value >= self.good_from) & (value <= self.good_to), 1).otherwise(0).cast("int").alias(self.name)
        )


_ANY = float("inf")
# Every kind of junk is seen by two rules or more: what one rule alone sees can be told from
# its own error only by what the others say.
RULES = [
    Rule("length", "n_words", None, 60, _ANY, 20, _ANY),
    Rule("characters", "word_chars", None, 250, _ANY, 90, _ANY),
    Rule("symbols", "n_symbols", "word_chars", 0, 0.03, 0, 0.10),
    Rule("symbols_a_word", "n_symbols", "n_words", 0, 0.12, 0, 0.25),
    Rule("line_copies", "n_dup_lines", "n_lines", 0, 0.20, 0, 0.50),
    Rule("line_copies_a_word", "n_dup_lines", "n_words", 0, 0.01, 0, 0.04),
    Rule("repeats", "n_repeat_words", "n_words", 0, 0.15, 0, 0.35),
    Rule("word_length", "word_chars", "n_words", 3, 10, 2, 14),
    Rule("capitals", "n_capitals", "word_chars", 0, 0.15, 0, 0.40),
    Rule("capitals_a_word", "n_capitals", "n_words", 0, 0.90, 0, 1.80),
    Rule("calls", "n_calls", "n_words", 0, 0.10, 0, 0.40),
    Rule("calls_a_character", "n_calls", "word_chars", 0, 0.02, 0, 0.08),
]


@dataclass(frozen=True)
class Estimate:
    """Log odds of good: ``prior`` plus one weight for each rule that votes."""

    prior: float
    weights: dict[str, tuple[float, float]]  # by rule: for a bad, a good vote
    rates: dict[str, tuple[tuple[float, ...], tuple[float, ...]]]  # vote rates on bad, on good documents

    def posterior(self) -> Column:
        odds = F.lit(self.prior)
        for name, (bad, good) in self.weights.items():
            odds = odds + F.when(F.col(name) < 0, bad).when(F.col(name) > 0, good).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


# What a rule is expected to do before any document is seen, as pseudo-counts of votes
# (bad, good): a bad vote is rare on good documents.  Votes outweigh them, so a rule that
# fires on many good documents comes to count for little.
_PRIOR_BAD, _PRIOR_GOOD, _PRIOR_SHARE = (4.0, 6.0), (0.05, 19.95), (4.0, 1.0)


def _weights(good: list[float], bad: list[float]) -> tuple[float, float]:
    """Log odds of a bad and of a good vote: the one never speaks for a document, the other never against it."""
    return min(0.0, math.log(good[0] / bad[0])), max(0.0, math.log(good[1] / bad[1]))


def estimate(patterns: list[tuple[tuple[int, ...], int]], names: list[str], steps: int = 200, tolerance: float = 1e-7) -> Estimate:
    """Expectation maximisation over counted vote patterns; with no patterns, the priors."""
    total = lambda p: [x / sum(p) for x in p]
    share = _PRIOR_SHARE[0] / sum(_PRIOR_SHARE)
    bad, good = [total(_PRIOR_BAD) for _ in names], [total(_PRIOR_GOOD) for _ in names]
    everything = sum(n for _, n in patterns)
    for _ in range(steps):
        odds0 = math.log(share / (1 - share))
        weights = [_weights(good[j], bad[j]) for j in range(len(names))]
        mass = 0.0
        new_bad, new_good = [list(_PRIOR_BAD) for _ in names], [list(_PRIOR_GOOD) for _ in names]
        for votes, n in patterns:
            odds = odds0 + sum(weights[j][v > 0] for j, v in enumerate(votes) if v)
            p = 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0
            mass += n * p
            for j, v in enumerate(votes):
                if v:
                    new_good[j][v > 0] += n * p
                    new_bad[j][v > 0] += n * (1 - p)
        new_share = (mass + _PRIOR_SHARE[0]) / (everything + sum(_PRIOR_SHARE))
        moved = abs(new_share - share)
        share, bad, good = new_share, [total(x) for x in new_bad], [total(x) for x in new_good]
        if moved < tolerance:
            break
    weights = {name: _weights(good[j], bad[j]) for j, name in enumerate(names)}
    return Estimate(math.log(share / (1 - share)), weights, {name: (tuple(bad[j]), tuple(good[j])) for j, name in enumerate(names)})


def fit(voted: DataFrame, rules: list[Rule] = RULES) -> Estimate:
    """Estimate from all documents: at most 3 ** len(rules) counted patterns reach the driver."""
    names = [rule.name for rule in rules]
    counted = voted.groupBy(*names).count().collect()
    return estimate(sorted((tuple(row[name] for name in names), row["count"]) for row in counted), names)


def _judged(voted: DataFrame, found: Estimate, threshold: float) -> DataFrame:
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return voted.withColumn("base_failed", base_failed).withColumn("quality", found.posterior()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )


def judge(docs: DataFrame, keys: list[Column], *, text: str = "text", rules: list[Rule] = RULES, threshold: float = 0.5) -> DataFrame:
    """``keys``, measures, votes, base_failed, quality (the posterior) and kept of every document."""
    rows = staged(measured(docs, keys, text), f"{workspace(docs.sparkSession, 'quality')}/measures")
    voted = rows.select("*", *[rule.vote() for rule in rules])
    return _judged(voted, fit(voted, rules), threshold)


def good_documents(docs: DataFrame, *, text: str = "text", rules: list[Rule] = RULES, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept.

    Texts are measured once for the estimate and once for the verdict: nothing of them is
    stored or shuffled.
    """

    def voted(keys: list[Column]) -> DataFrame:
        rows = docs.select(*keys, *measures(text))
        return _named(rows, rows.columns[: len(keys)]).select("*", *[rule.vote() for rule in rules])

    found = fit(voted([]), rules)
    # The optimizer moves no filter below a column that is not deterministic: else it would
    # write the measures out in the condition, once for every use.
    rows = voted([F.struct(*docs.columns).alias("document"), F.monotonically_increasing_id().alias("row")])
    return _judged(rows, found, threshold).where(F.col("kept") & (F.col("row") >= 0)).select("document.*")
