"""Near copies, class scores, quality rules and the pipeline against brute force."""

from __future__ import annotations

import importlib
import itertools
import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docstrata.llm import classlm, mixing, neardup, quality
from docstrata.llm.storage import staged
from docstrata.llm.words import WORD_PATTERN, hash_words

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words_of(text):
    return re.findall(WORD_PATTERN, (text or "").translate(LOWER))


def corpus():
    """Originals, families of near copies around the threshold, exact copies, junk and edge cases."""
    rng = np.random.default_rng(5)
    vocabulary = [f"{a}{b}{c}" for a, b, c in itertools.product("bdlmr", "aeiou", ["n", "st", "", "ck"])]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    draw = lambda n: rng.choice(vocabulary, n, p=weights / weights.sum()).tolist()
    texts: list = []
    for base in range(12):
        words = draw(60 + 15 * base)
        texts.append(" ".join(words))
        for copy in range(9):
            edited = list(words)
            for place in rng.integers(0, len(words), 1 + copy // 2):
                edited[place] = f"edit{rng.integers(1000)}"
            texts.append(" ".join(edited).upper() if copy == 3 else "\n".join(edited) if copy == 4 else " ".join(edited))
        texts.append(" ".join(words))
    texts += [" ".join(f"{w}{'#*$'[k % 3] * 3}" for k, w in enumerate(draw(120))) for _ in range(12)]
    texts += ["\n".join(["THE SAME LINE!!"] * 40), None, "", " \n ", "one", "two words", "one", "a b c d", "A  B c\td", "a b c d e"]
    texts += [" ".join(draw(80)) for _ in range(60)]
    return [(k * 5 % 331 if k else None, t, "en", None if k % 13 == 0 else f"s{k % 4}", None if t is None else len(t)) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


def brute_components(rows):
    sets = []
    for _, text, *_ in rows:
        w = words_of(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least: dict = {}
    for i, row in enumerate(rows):
        key = 1 << 60 if row[0] is None else row[0]
        least[find(i)] = min(least.get(find(i), 1 << 60), key)
    out = []
    for i, row in enumerate(rows):
        component = None if least[find(i)] == 1 << 60 else least[find(i)]
        out.append((row[0], len(sets[i]), component, row[0] == component))
    return out


@pytest.mark.parametrize("block", [512, 3])
def test_near_copies_match_brute_force(docs, block):
    got = Counter(tuple(r) for r in neardup.near_duplicates(docs, block=block).collect())
    assert got == Counter(brute_components(corpus()))


def test_near_copies_of_odd_tables(spark, docs):
    assert neardup.near_duplicates(docs.limit(0)).collect() == []
    rows = [(7, "a b c d e f", "x"), (7, "a b c d e f", "y"), (7, None, "z"), (None, "a b c d e f", "x"), (2, "q r s t u v w", "x"), (9, "", "x")]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, class string")
    assert Counter(tuple(r) for r in neardup.near_duplicates(odd).collect()) == Counter(
        [(7, 2, 7, True), (7, 2, 7, True), (7, 0, 7, True), (None, 2, 7, False), (2, 3, 2, True), (9, 0, 9, True)]
    )
    kept = neardup.distinct_documents(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 9]


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(1, i) for i in range(2, 60)]
    links = spark.createDataFrame([(a.to_bytes(2, "big"), b.to_bytes(2, "big")) for a, b in chain + hub + [(700, 701)]], "a binary, b binary")
    from docstrata.llm.storage import workspace

    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["component"], "big") for r in neardup.components(links, workspace(spark, "chain")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 1 for i in range(1, 60)} | {700: 700, 701: 700}


def test_table_pairs_meet_half_keys():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 1 << 62, 400).astype(np.uint64))
    near = np.unique(np.r_[base[:375], rng.integers(0, 1 << 62, 25).astype(np.uint64)])  # likeness about 0.88
    far = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    keys = neardup.half_keys([base, near, np.unique(far)], 18, 3)
    same = keys[0] == keys[1]
    assert same[:18].any() and same[18:].any() and not (keys[0] == keys[2]).any()


def held_out(doc_id):
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 7 == 2


def test_scores_match_their_definition(docs):
    rows = corpus()
    out = zlib_split(rows)
    train = [words_of(t) for (i, t, *_), h in zip(rows, out) if not h]
    counts = Counter(w for words in train for w in words)
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    settings = {"classes": 8, "sweeps": 3, "groups": 32, "min_share": 0.002, "least_count": 5}
    got = classlm.score_corpus(docs, held_out, **settings).collect()
    joined = classlm.score_corpus(docs, held_out, local_words=0, **settings).collect()
    expected = Counter()
    for (i, text, *_), h in zip(rows, out):
        words = words_of(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((len(train) + 1) / (n + v + 1))
        expected[(i, h, len(words) + 1, sum(counts[w] > 0 for w in words) + 1, n, round(base, 6))] += 1
    keys = lambda found: Counter((*[r[k] for k in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")], round(r["base_score"], 6)) for r in found)
    assert keys(got) == expected and keys(joined) == expected
    assert sorted((r["doc_id"] or -1, round(r["score"], 6)) for r in got) == sorted((r["doc_id"] or -1, round(r["score"], 6)) for r in joined)
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def zlib_split(rows):
    return [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, *_ in rows]


def test_class_model_is_a_distribution(docs, spark):
    model = classlm.fit(docs, classes=8, sweeps=2, groups=32, min_share=0.002, least_count=3)
    vocabulary = spark.read.parquet(model.vocabulary.path).collect()
    assert len(vocabulary) == model.words - 1 and {row["class"] for row in vocabulary} <= set(range(7)) and (model.vocabulary.group_class < 7).all()
    words = np.zeros(8)
    for row in vocabulary:
        words[row["class"]] += 10 ** (math.log10(row["n"]) - model.known[row["class"]])
    words[7] += 10 ** (math.log10(model.docs) - model.known[7])
    words += 10**model.unknown
    for before in range(8):
        assert float((10 ** model.transitions[before] * words).sum()) == pytest.approx(1.0, abs=1e-6)


def hash_of(word):
    return int(hash_words(pa.array([word])).hashes.view(np.int64)[0])


@pytest.mark.parametrize("local_words", [0, 1000_000])
def test_scores_follow_from_the_classes(docs, spark, local_words):
    """Class bigrams counted in a loop, from the classes that the model gave to the words."""
    settings = {"classes": 6, "sweeps": 2, "groups": 8, "min_share": 0.004, "least_count": 4}
    rows = corpus()
    train = [words_of(r[1]) for r, out in zip(rows, zlib_split(rows)) if not out]
    model = classlm.fit(docs.where(~held_out("doc_id")), local_words=local_words, **settings)
    table = {r["hash"]: (r["n"], r["class"]) for r in spark.read.parquet(model.vocabulary.path).collect()}
    counts = Counter(w for words in train for w in words)
    assert table.keys() == {hash_of(w) for w in counts} and all(table[hash_of(w)][0] == n for w, n in counts.items())
    group = lambda w: int(model.vocabulary.group_class[classlm._groups(hash_words(pa.array([w])), 8)[0]])
    classes = {w: table[hash_of(w)][1] if w in counts else group(w) for w in {w for r in rows for w in words_of(r[1])}}
    assert all(classes[w] == group(w) for w, n in counts.items() if n < 4 and n < 0.004 * model.tokens)
    assert any(classes[w] != group(w) for w, n in counts.items() if 4 <= n < 0.004 * model.tokens)  # rarer than any unit of the first phase
    pairs, end = np.zeros((6, 6)), 5
    for words in train:
        line = [end, *(classes[w] for w in words), end]
        for x, y in zip(line[:-1], line[1:]):
            pairs[x, y] += 1
    share = pairs.sum(0) / pairs.sum() + 1e-9
    transition = np.log10((pairs + 10 * share / share.sum()) / (pairs.sum(1, keepdims=True) + 10))
    once = np.array([sum(n == 1 and classes[w] == c for w, n in counts.items()) + 0.5 for c in range(5)] + [0])
    mass = pairs.sum(0) + once
    got = Counter((r["doc_id"], round(r["score"], 5)) for r in classlm.score(docs, model, local_words=local_words).collect())
    want = Counter()
    for doc_id, text, *_ in rows:
        words, before, total = words_of(text), end, 0.0
        for w in words:
            c = classes[w]
            total += transition[before, c] + math.log10((counts[w] if w in counts else once[c]) / mass[c])
            before = c
        total += transition[before, end] + math.log10(len(train) / mass[end])
        want[(doc_id, round(total, 5))] += 1
    assert got == want


def test_exchange_raises_the_likelihood(docs):
    likelihood = []
    for sweeps in (0, 4):
        model = classlm.fit(docs, classes=6, sweeps=sweeps, groups=16, min_share=0.002)
        likelihood.append(classlm.score(docs, model).agg(F.sum("score")).first()[0])
    assert likelihood[1] > likelihood[0]


def test_scores_of_odd_tables(spark, docs):
    model = classlm.fit(docs.limit(0), classes=4, sweeps=1)
    for local in (0, 100):
        rows = classlm.score(docs.where("doc_id in (5, 10)"), model, local_words=local).collect()
        assert [(r["score"], r["base_score"], r["n_known"]) for r in rows] == [(0.0, 0.0, 0)] * 2
        assert classlm.score(docs.limit(0), model, local_words=local).collect() == []


def drawn_texts(n, size, kinds):
    rng = np.random.default_rng(3)
    return [" ".join(f"w{x}" for x in (rng.pareto(0.8, size) * 4).astype(int) % kinds) for _ in range(n)]


def primed(monkeypatch, texts, classes):
    """A vocabulary of all words of the texts as a worker has it loaded, and its words' counts and classes."""
    counts = Counter(w for t in texts for w in words_of(t))
    table = sorted((hash_of(w), n, zlib.crc32(w.encode()) % (classes - 1)) for w, n in counts.items())
    monkeypatch.setitem(classlm._tables, "primed", tuple(np.array(c, dtype=np.int64) for c in zip(*table)))
    return classlm.Vocabulary("primed", len(table), np.arange(8) % (classes - 1), classes), {h: (n, c) for h, n, c in table}


@pytest.mark.parametrize("keys", [60, 1_000_000])
def test_contexts_are_one_row_a_word(monkeypatch, keys):
    """Neighbours are summed in the task before they are handed over: 24 million rows on 0.1 GB filled the executors."""
    texts = [*drawn_texts(40, 50, 300), None, "", "w1", "w1 W1 w1 w2 w2"]
    monkeypatch.setattr(classlm, "_BLOCK_BYTES", 500)
    monkeypatch.setattr(classlm, "_BUFFER_KEYS", keys)
    vocabulary, table = primed(monkeypatch, texts, 6)
    batches = [pa.RecordBatch.from_arrays([pa.array(part, pa.string())], names=["text"]) for part in (texts[:17], texts[17:])]
    rows = [r for b in classlm._unit_contexts(vocabulary.lines(iter(batches), 0), 6, 5) for r in b.to_pylist()]
    want, own = Counter(), Counter()
    for text in texts:
        line = [None, *(hash_of(w) for w in words_of(text)), None]
        for x, y in zip(line[:-1], line[1:]):
            for unit, code, other in ((y, 0, x), (x, 6, y)):
                if unit is not None and table[unit][0] >= 5:
                    want[(unit, code + (5 if other is None else table[other][1]))] += 1
            if x is not None and x == y and table[x][0] >= 5:
                own[x] += 1
    got, got_own = Counter(), Counter()
    for r in rows:
        assert r["old"] == table[r["unit"]][1]
        got_own[r["unit"]] += r["own"]
        got.update({(r["unit"], code): n for code, n in zip(r["code"], r["n"])})
    assert got == want and +got_own == own
    if keys > len(want):
        assert len(rows) == sum(n >= 5 for n, _ in table.values())


def test_counting_holds_little(monkeypatch):
    """What a worker holds beside its table; it was 114 MB for these 3.5 MB of text."""
    texts = drawn_texts(1000, 1000, 60_000)
    vocabulary, _ = primed(monkeypatch, texts, 64)
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 200])], names=["text"]) for k in range(0, 1000, 200)]
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in classlm._unit_contexts(vocabulary.lines(iter(batches), 0), 64, 20))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows and peak < 70e6


def test_workers_load_single_words_only(docs, spark, tmp_path):
    """The table of the counting passes has no word that is in its group's class anyway."""
    model = classlm.fit(docs, classes=6, sweeps=2, groups=8, min_share=0.01, least_count=4, folder=str(tmp_path))
    every = spark.read.parquet(model.vocabulary.path)
    coarse, moved = (sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/{name}").select("hash").collect()) for name in ("coarse", "moved"))
    assert coarse == moved == sorted(r[0] for r in every.where("n >= 4").select("hash").collect())
    assert 0 < len(coarse) < every.count() == model.words - 1


def test_large_tables_are_read_in_parts(monkeypatch, spark, tmp_path):
    """Same tokens, a few reads for many blocks, no text held; all tokens were shuffled for such tables."""
    texts = [*drawn_texts(40, 50, 300), None, "", "not there", "w1 W1 w1"]
    primed_table, table = primed(monkeypatch, texts[:30], 6)
    rows = spark.createDataFrame([(h, n if k else 1 << 33, c) for k, (h, (n, c)) in enumerate(table.items())], "hash bigint, n bigint, class int")
    classlm._stored(rows.repartition(3), str(tmp_path / "words"))
    vocabulary = classlm.Vocabulary(str(tmp_path / "words"), len(table), primed_table.group_class, 6)
    monkeypatch.setattr(classlm, "_BLOCK_BYTES", 500)
    monkeypatch.setattr(classlm, "_HELD_TOKENS", 700)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    reads, parts = [], classlm._parts
    monkeypatch.setattr(classlm, "_parts", lambda path, most=None: reads.append(most) or parts(path, most))

    def found(local_words):
        reads.clear()
        return [(*(c.to_pylist() for c in others), line.counts.tolist(), line.classes.tolist(), line.bounds.tolist()) for others, line in vocabulary.lines(iter([batch, batch]), 1, local_words)]

    whole = found(len(table))
    assert reads == [None] and sum((ids for ids, *_ in whole), []) == [*range(len(texts))] * 2
    hashes = lambda ids: [hash_of(w) for k in ids for w in words_of(texts[k])]
    stored = {r["hash"]: (r["n"], r["class"]) for r in rows.collect()}
    for ids, n, classes, _ in whole:
        assert n == [stored.get(h, (0,))[0] for h in hashes(ids)]
        assert all(c == stored[h][1] for h, c in zip(hashes(ids), classes) if h in stored)
    assert any(0 in n for _, n, *_ in whole)
    for local_words in (0, 1, 7, len(table) - 1):
        assert found(local_words) == whole
        assert reads == [max(local_words, 1)] * len(reads) and 3 < len(reads) < len(whole)


def test_no_tokens_are_shuffled(docs, tmp_path):
    """At 6 GB the words outgrow a worker: every token went through two shuffles, 12 times the input."""
    model = classlm.fit(docs, classes=6, sweeps=1, groups=8, min_share=0.01, least_count=4, folder=str(tmp_path / "model"))
    stored = staged(docs, str(tmp_path / "docs"))
    whole, parts = (classlm.score(stored, model, local_words=n) for n in (classlm.LOCAL_WORDS, 10))
    assert "Exchange" not in parts._jdf.queryExecution().executedPlan().toString()
    assert Counter(map(tuple, parts.collect())) == Counter(map(tuple, whole.collect()))


def brute_measures(text):
    text = text or ""
    words = re.findall(WORD_PATTERN, text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(WORD_PATTERN, x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(docs):
    extra = ["a b c a b c", "a a a a a", "x\n\nx\n y\n y \n", "é ü z #|<>", "a b c d", "b a b a b a b", "\x0b\x0c w \r"]
    more = docs.sparkSession.createDataFrame([(1000 + k, t, "", "", 0) for k, t in enumerate(extra)], SCHEMA)
    rows = quality.judge(docs.unionByName(more), [F.col("doc_id"), F.col("text")]).collect()
    for r in rows:
        want = brute_measures(r["text"])
        assert tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, r["text"]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)


def test_rules_reject_junk_and_keep_the_rest(docs):
    rows = {r["doc_id"]: r for r in quality.judge(docs, [F.col("doc_id"), F.col("text")]).collect()}
    for r in rows.values():
        if not r["base_failed"] and r["text"].upper() != r["text"] and "\n" not in r["text"]:
            assert r["kept"] == ("###" not in r["text"]), r


def voted(rng, bad, rates, silent=0.2):
    """Votes of rules that vote bad with a rate on bad and a rate on good documents."""
    return np.stack([np.where(rng.random(len(bad)) < silent, 0, np.where(rng.random(len(bad)) < np.where(bad, *r), -1, 1)) for r in rates], axis=1)


def test_estimate_recovers_accuracies():
    rng = np.random.default_rng(4)
    bad, names = rng.random(40_000) < 0.15, ["a", "b", "c", "d"]
    rates = [(0.9, 0.001), (0.5, 0.05), (0.7, 0.2), (0.6, 0.01)]
    found = quality.estimate(sorted(Counter(map(tuple, voted(rng, bad, rates).tolist())).items()), names)
    assert 1 / (1 + math.exp(-found.prior)) == pytest.approx(0.85, abs=0.02)
    for name, (on_bad, on_good) in zip(names, rates):
        assert found.rates[name][0][0] == pytest.approx(on_bad, abs=0.05) and found.rates[name][1][0] == pytest.approx(on_good, abs=0.02)
    assert quality.estimate([], names).prior > 0


def plain_posterior(votes, steps=300):
    """The estimate over single documents instead of patterns."""
    rules, share = votes.shape[1], 0.8
    bad, good = np.full(rules, 0.4), np.full(rules, 0.0025)
    for _ in range(steps):
        against = np.minimum(0, np.log(good / bad))
        favour = np.maximum(0, np.log((1 - good) / (1 - bad)))
        odds = np.log(share / (1 - share)) + (votes < 0) @ against + (votes > 0) @ favour
        p = 1 / (1 + np.exp(-odds))
        share = (p.sum() + 4) / (len(p) + 5)
        good = (p @ (votes < 0) + 0.05) / (p @ (votes != 0) + 20)
        bad = ((1 - p) @ (votes < 0) + 4) / ((1 - p) @ (votes != 0) + 10)
    return p


@pytest.mark.parametrize("rate", [0.05, 0.15, 0.3])
@pytest.mark.parametrize("rule", [0, 2, 4])
def test_a_rule_that_misfires_rejects_nothing_alone(rate, rule):
    rng = np.random.default_rng(8)
    bad = rng.random(20_000) < 0.12
    rates = [(0.9, 0.002), (0.85, 0.002), (0.6, 0.001), (0.7, 0.003), (0.5, 0.001)]
    rates[rule] = (rates[rule][0], rate)
    votes = voted(rng, bad, rates)
    names = list("abcde")
    found = quality.estimate(sorted(Counter(map(tuple, votes.tolist())).items()), names)
    odds = found.prior + sum(np.where(votes[:, j] < 0, found.weights[n][0], np.where(votes[:, j] > 0, found.weights[n][1], 0)) for j, n in enumerate(names))
    kept = odds >= 0
    alone = ~bad & (votes[:, rule] < 0) & ((votes < 0).sum(axis=1) == 1)
    assert kept[alone & ((votes > 0).sum(axis=1) >= 3)].all() and kept[alone].mean() > 0.9  # with others that vote
    assert (~kept)[bad & ((votes < 0).sum(axis=1) >= 2)].mean() > 0.95
    assert np.allclose(1 / (1 + np.exp(-odds)), plain_posterior(votes), atol=1e-3)


def test_verdicts_equal_a_plain_estimate(docs):
    rows = quality.judge(docs, [F.col("doc_id")]).collect()
    names = [rule.name for rule in quality.RULES]
    quality_of = plain_posterior(np.array([[r[n] for n in names] for r in rows]))
    assert np.allclose([r["quality"] for r in rows], quality_of, atol=1e-3)
    assert [r["kept"] for r in rows] == [bool(not r["base_failed"] and q >= 0.5) for r, q in zip(rows, quality_of)]


def test_quality_of_odd_tables(spark, docs):
    assert quality.judge(docs.limit(0), [F.col("doc_id")]).collect() == []
    odd = spark.createDataFrame([(1, None, 3), (1, "w " * 60, 4)], "doc_id bigint, text string, n_words int")
    kept = quality.good_documents(odd)
    assert kept.columns == odd.columns and kept.collect() == []  # one repeats itself, one has no words


def test_good_documents_are_those_judged_good(docs):
    kept = Counter(r["doc_id"] for r in quality.judge(docs, [F.col("doc_id")]).where("kept").collect())
    good = quality.good_documents(docs)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert Counter(r["doc_id"] for r in good.collect()) == kept and good.columns == docs.columns
    assert "hashpartitioning" not in plan and not re.search("Python|Pandas|Arrow", plan)


def test_stages_keep_columns_with_clashing_names(spark):
    names = "_n _copies _id _key _kept_id _repeated _nth row id key rows upto0 copies nth document measures n_words hash least".split()
    texts = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(8)]
    rows = [(k, t, f"s{k % 2}", *[f"{c}{k}" for c in names]) for k, t in enumerate(texts + [texts[0], texts[1]])] + [(3, texts[3], "s1", *["again"] * len(names))]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in names)
    docs = spark.createDataFrame(rows, schema)
    own = {tuple(r) for r in rows}
    for stage, least in ((quality.good_documents, 8), (neardup.distinct_documents, 8), (mixing.mixed_documents, 8)):
        got = stage(docs)
        found = got.collect()
        assert got.columns == docs.columns and len(found) >= least and {tuple(r) for r in found} <= own, stage
    assert sorted(r["doc_id"] for r in neardup.distinct_documents(docs).collect()) == list(range(8))
    copies = Counter(r["doc_id"] for r in mixing.mixed_documents(docs).collect())
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r["doc_id"]] += r["copies"]
    assert copies == +taken
    null_ids = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert neardup.distinct_documents(null_ids).count() == 1 and mixing.mixed_documents(null_ids).count() > 8


def test_quality_runs_no_python(docs):
    plan = quality.judge(docs, [F.col("doc_id")])._jdf.queryExecution().toString()
    measured = quality.measured(docs, [F.col("doc_id")])._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan + measured)


def test_pipeline_matches_its_stages_by_hand(spark, docs, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    docs.where("doc_id is not null").write.parquet(str(tmp_path / "documents.parquet"))
    out = pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "piece_ids", "n_pieces", "lossless"]
    rows = out.collect()
    good = [r for r in corpus() if r[0] is not None]
    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(good, SCHEMA), [F.col("doc_id")]).collect()}
    good = [r for r in good if verdict[r[0]]]
    assert all(brute_measures(t)[0] >= 50 for _, t, *_ in good)
    single = [r for r, (_, _, _, kept) in zip(good, brute_components(good)) if kept]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(single, SCHEMA)).collect()}
    assert Counter(r["doc_id"] for r in rows) == Counter({k: n for k, n in copies.items() if n})
    assert all(r["lossless"] and r["n_pieces"] == len(r["piece_ids"]) > 0 for r in rows)
    assert [name for name, _ in pipeline.STAGES] == ["quality_rules", "near_dedup", "mix_sources", "encode_pieces"]
