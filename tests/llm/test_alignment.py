"""Alignment of two tokenizers against the libraries and a per-token loop."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from docstrata.llm import alignment

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", "a", " ", "  two  blanks ", "x <|endoftext|> y <s> </s>", "▁marked", "tab\tand\nline\r\n", "naïve café ﬁ Ⅳ", "日本語 text 中文", "é́ combining", "👍🏽 ok",
    "nul\x00byte", "it's we'll THEY'RE", "aaaa" * 3000, "word " * 4000, "12345 6,789.00 $%^", "﻿mark first", "same words here again", "same words here again",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def _spans(tokens):
    end, out = 0, []
    for number, content in tokens:
        out.append((number, end, end + len(content)))
        end += len(content)
    return out


def brute_force(texts, libraries):
    a, b = libraries
    stand_ins = alignment._byte_of()
    links, rows = [], []
    for text in texts:
        want = b" " + (text or "").encode()
        one = [(k, bytes(stand_ins[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        two = [(k, bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()) for k in b.encode(text)] if text else []
        if not text or b"".join(x for _, x in one) != want or b"".join(x for _, x in two) != want:
            rows.append((0, 0, 0, ""))
            links.append([])
            continue
        one, two = _spans(one), _spans(two)
        own, j = [], 0
        for number, begin, end in one:
            while j < len(two) and two[j][2] <= begin:
                j += 1
            k = j
            while k < len(two) and two[k][1] < end:
                own.append((number, two[k][0]))
                k += 1
        common = {e for _, _, e in one} & {e for _, _, e in two}
        groups, cut = [], 0
        for e in sorted(common):
            groups.append(",".join(str(n) for n, s, t in one if cut < t <= e) + "|" + ",".join(str(n) for n, s, t in two if cut < t <= e)) if len(one) < 200 else None
            cut = e
        text_groups = ";".join(groups) if len(one) < 200 else None
        rows.append((len(one), len(two), len(common), hashlib.sha256(text_groups.encode()).hexdigest() if text_groups is not None else None))
        links.append(own)
    counts = Counter(pair for own in links for pair in own)
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (n_a, n_b, n_g, len(own), sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), h) for (n_a, n_b, n_g, h), own in zip(rows, links)
    ]


@pytest.mark.parametrize("chunk_bytes", [1, 500, 4 << 20])
def test_align_matches_a_loop(spark, libraries, chunk_bytes, sf_texts):
    texts = ODD + sf_texts
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, chunk string, n_a int").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(frame, A_PATH, B_PATH, chunk_bytes=chunk_bytes).collect()}
    want = brute_force(texts, libraries)
    assert len(got) == len(texts)
    for k, row in enumerate(want):
        assert got[k][:-1] == row[:-1], texts[k]
        if row[-1] is not None:
            assert got[k][-1] == row[-1], texts[k]


@pytest.fixture(scope="module")
def sf_texts(spark):
    return [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(60).collect()]


def test_byte_tokens_are_the_librarys(libraries, sf_texts):
    own = alignment.tokenizers(A_PATH, B_PATH)[0]
    letters = [f" a{chr(c)}1{chr(c)}! {chr(c)} {chr(c)}{chr(c)}b" for c in [*range(0xD800), *range(0xE000, 0x3000, 7), *range(0x1F300, 0x1FB00)]]
    texts = [t for t in ODD if t] + sf_texts + letters
    assert own.encode(texts) == [e.ids for e in libraries[0].encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert alignment.align(empty, A_PATH, B_PATH).collect() == []
    rows = spark.createDataFrame([(None, None), (None, ""), ("b", None)], "doc_id string, text string")
    assert sorted(map(str, alignment.align(rows, A_PATH, B_PATH).drop("doc_id").collect())) == [str(r) for r in [_zero(spark)] * 3]
    same = spark.createDataFrame([("b", "one two"), ("b", "one two"), (None, "one two")], "doc_id string, text string")
    got = alignment.align(same, A_PATH, B_PATH).collect()
    assert len(got) == 3 and {r["n_links"] for r in got} == {2} and {r["count_sum"] for r in got} == {6}


def _zero(spark):
    return spark.createDataFrame([(0, 0, 0, 0, 0, 0, "")], "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string").first()


def test_bytes_that_are_no_text(spark):
    rows = spark.sql("SELECT 1L AS doc_id, CAST(unhex('61FF62') AS string) AS text")
    assert alignment.align(rows, A_PATH, B_PATH).first()["n_links"] == 0
