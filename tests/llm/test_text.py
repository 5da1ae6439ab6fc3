"""Word hashes, pieces, licenses, packed ids."""

from __future__ import annotations

import heapq
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from docstrata.llm import license_texts, licenses, packing, pieces
from docstrata.llm.license_texts import STATEMENTS, TEXTS
from docstrata.llm.storage import workspace
from docstrata.llm.words import WORD_PATTERN, blocks, hash_words, mix, shingle_sets

os.environ["TOKENIZERS_PARALLELISM"] = "false"
MODEL, TOKENIZER = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
TEXT = [
    None, "", " ", "a", "The  cat\x0bsat on\tthe mat.\r\n", "é à b c d e f", "x" * 3000, "word " * 2000, "日本語 テスト <s> </s>", "▁raw ▁▁ blank", "\x00 \x1f",
    "Don't I'LL 12345 a1b2!... foo.Bar <|endoftext|> A<|ENDOFTEXT|>b", "İstanbul ΣΑΣ ß ʼn", " lead and trail  ", "One two three four five six seven",
]


def test_words_match_the_pattern():
    got = hash_words(pa.array(TEXT))
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    names = [re.findall(WORD_PATTERN, (t or "").translate(lower)) for t in TEXT]
    assert np.diff(got.bounds).tolist() == [len(w) for w in names]
    flat = [w for words in names for w in words]
    seen: dict = {}
    for word, value in zip(flat, got.hashes.tolist()):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    assert sum(len(b) for _, b in blocks(pa.array(TEXT * 300))) == len(TEXT) * 300


def test_shingles_count_distinct_windows():
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for text, got in zip(TEXT, shingle_sets(pa.array(TEXT), 5)):
        w = re.findall(WORD_PATTERN, (text or "").translate(lower))
        want = len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) if len(w) >= 5 else min(len(w), 1)
        assert len(got) == want


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(MODEL)


def test_pieces_without_dropout_are_the_library_s(model):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=MODEL)
    texts = [t or "" for t in TEXT if "▁" not in (t or "")]
    got = model.encode(texts, np.zeros(len(texts), dtype=np.uint64), 5, 0.0, 4)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == library.encode(texts, num_threads=1)


def brute_segment(model, chunk, key, threshold):
    """The agenda of candidates, best score then leftmost, with the keyed skip."""
    spans = [[i, i + 1, int(model.symbols[ord(c)])] for i, c in enumerate(chunk)]
    left, right, alive = list(range(-1, len(chunk) - 1)), [*range(1, len(chunk)), -1], [True] * len(chunk)
    full = model.slot_pair >= 0
    merges = getattr(model, "merges", None) or dict(zip([*model.slot_pair[full].tolist(), *model.pairs.tolist()], [*model.slot_piece[full].tolist(), *model.merged.tolist()]))
    model.merges = merges
    agenda: list = []

    def propose(i):
        j = right[i]
        if i < 0 or j < 0 or spans[i][2] < 0 or spans[j][2] < 0:
            return
        piece = merges.get(spans[i][2] * model.size + spans[j][2])
        if piece is None:
            return
        place = np.array([((spans[i][0] << 42) ^ (spans[i][1] << 21) ^ spans[j][1]) * 0x9E3779B97F4A7C15 % (1 << 64)], dtype=np.uint64)
        skipped = int(mix(np.array([key], dtype=np.uint64) ^ mix(place))[0]) >> 11 < threshold
        heapq.heappush(agenda, (-int(model.ranks[piece]), spans[i][0], i, j, spans[i][1], spans[j][1], piece, skipped))

    for i in range(len(chunk) - 1):
        propose(i)
    while agenda:
        _, _, i, j, middle, end, piece, skipped = heapq.heappop(agenda)
        if skipped or not alive[i] or not alive[j] or spans[i][1] != middle or spans[j][1] != end or right[i] != j:
            continue
        spans[i][1], spans[i][2], alive[j], right[i] = end, piece, False, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        if left[i] >= 0:
            propose(left[i])
        propose(i)
    return [s[2] for s, a in zip(spans, alive) if a]


def test_dropout_matches_the_agenda(model):
    chunks = ["▁hello", "▁international", "▁▁▁word", "ing", "▁antidisestablishmentarianism", "▁été", "▁aaaaaaaaaaa", "▁▁▁▁▁▁▁"]
    keys = mix(np.arange(40 * len(chunks), dtype=np.uint64))
    many = chunks * 40
    for dropout in (0.0, 0.1, 0.6):
        threshold = round(dropout * (1 << 53))
        got = [np.frombuffer(g, "<u4").tolist() for g in model.segment(many, keys, threshold)]
        assert got == [brute_segment(model, c, int(k), threshold) for c, k in zip(many, keys)]
    assert len({tuple(g) for g, c in zip(got, many) if c == "▁international"}) > 5


def test_every_occurrence_draws_its_own_dropout(model):
    # 500 documents of 64 equal words: more segmentations than a few keys give, inside a text as well.
    texts = ["international " * 64] * 500 + ["antidisestablishmentarianism " * 3 + "x" * 300, "", "▁raw ▁▁ blank", "hello " * 2000]
    keys = mix(np.arange(len(texts), dtype=np.uint64))
    got = [np.frombuffer(g, "<u4").tolist() for g in model.encode(texts, keys, 5, 0.1)]
    assert got == [np.frombuffer(g, "<u4").tolist() for g in model.encode(texts, keys, 5, 0.1)]  # from memory
    assert got[3:4] == [np.frombuffer(g, "<u4").tolist() for g in pieces.Pieces(MODEL).encode(texts[3:4], keys[3:4], 5, 0.1)]
    forms = set()
    for ids in got[:500]:
        word, text = [], b""
        for i in ids:
            text += model.bytes_of[i]
            word.append(i)
            if text == b" international":
                forms.add(tuple(word))
                word, text = [], b""
    assert len(forms) > 20
    assert len({tuple(g) for g in got[:500]}) > 490
    # What is remembered gives what the definition gives, chunk by chunk.
    threshold = round(0.1 * (1 << 53))
    for text, key, ids in list(zip(texts, keys, got))[496:]:
        chunks = pieces._CHUNKS.findall(f"▁{text.replace('▁', pieces._LITERAL)}".replace(" ", "▁")) if text else []
        own = mix(key ^ mix(np.arange(len(chunks), dtype=np.uint64) + mix(np.full(1, 5, dtype=np.uint64))))
        afresh = model.segment(chunks, own, threshold) if chunks else []
        assert b"".join(afresh) == np.array(ids, dtype="<u4").tobytes()


def test_pieces_round_trip_on_tables(spark):
    docs = spark.createDataFrame([(i, t, "taken") for i, t in enumerate(TEXT)] + [(4, TEXT[4], "taken"), (None, "null id here", "x")], "doc_id bigint, text string, n_pieces string")
    out = pieces.encode(docs, MODEL, dropout=0.3)
    assert out.columns == ["doc_id", "text", "n_pieces", "piece_ids", "_n_pieces", "lossless"]
    rows = pieces.decode(out, MODEL).collect()
    assert all(r["lossless"] and r["decoded"] == (r["text"] or "") and r["_n_pieces"] == len(r["piece_ids"]) for r in rows)
    twice = [r["piece_ids"] for r in rows if r["doc_id"] == 4]
    assert twice[0] == twice[1]
    again = {r["doc_id"]: r["piece_ids"] for r in pieces.encode(docs.repartition(3), MODEL, dropout=0.3).collect()}
    assert all(again[r["doc_id"]] == r["piece_ids"] for r in rows)
    other = {r["doc_id"]: r["piece_ids"] for r in pieces.encode(docs, MODEL, dropout=0.3, seed=99).collect()}
    assert other[7] != again[7]
    assert pieces.encode(docs.limit(0), MODEL).collect() == []
    with pytest.raises(ValueError):
        pieces.encode(docs, MODEL, dropout=1.0)


def brute_align(text, template):
    """Patience alignment by its definition, recursively and with a quadratic subsequence."""
    a, b = 0, 0
    while a < len(text) and a < len(template) and text[a] == template[a]:
        a += 1
    while b < len(text) - a and b < len(template) - a and text[-1 - b] == template[-1 - b]:
        b += 1
    n = a + b
    text, template = text[a : len(text) - b], template[a : len(template) - b]
    anchors = [(i, template.index(w)) for i, w in enumerate(text) if text.count(w) == 1 and template.count(w) == 1]
    best: list = []
    for i, j in anchors:
        best.append(1 + max((best[k] for k in range(len(best)) if anchors[k][1] < j), default=0))
    if not anchors:
        return n
    chain, want, last = [], max(best), 1 << 60
    for k in range(len(anchors) - 1, -1, -1):
        if best[k] == want and anchors[k][1] < last:
            chain.append(anchors[k])
            want, last = want - 1, anchors[k][1]
    edges = [(-1, -1), *chain[::-1], (len(text), len(template))]
    return n + len(chain) + sum(brute_align(text[i + 1 : k], template[j + 1 : m]) for (i, j), (k, m) in zip(edges, edges[1:]))


def test_alignment_matches_its_definition():
    rng = np.random.default_rng(3)
    template = licenses.words_of(TEXTS["ISC"])
    for trial in range(30):
        text = [w for w in template if rng.random() > 0.1]
        for _ in range(trial):
            text.insert(int(rng.integers(len(text))), f"z{rng.integers(9)}")
        pairs = licenses.align(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
        # Several longest subsequences can differ in what their gaps give.
        assert abs(len(pairs) - brute_align(text, template)) <= 3


def test_licenses_in_texts(spark):
    filler = "Lorem ipsum the software of a copy and to the license without " * 30
    edited = TEXTS["MIT"].replace("Software", "Program", 2).replace("free of charge", "gratis")
    texts = {
        1: filler + TEXTS["MIT"] + filler, 2: filler + edited, 3: filler, 4: None, 5: "", 6: "Released under the MIT License. " * 3,
        7: TEXTS["BSD-3-Clause"] + " and " + TEXTS["BSD-3-Clause"], 8: "x Licensed under CC BY-NC 4.0. y", 9: "Released under the GPL License.",
        10: " ".join(TEXTS["Apache-2.0"].split()[: len(TEXTS["Apache-2.0"].split()) // 2]),
    }
    docs = spark.createDataFrame([(k, t, "c") for k, t in texts.items()], "doc_id bigint, text string, license string")
    found = sorted((r["doc_id"], r["license"], r["coverage"]) for r in licenses.license_matches(docs).collect())
    assert [(k, n) for k, n, _ in found if k != 10] == [(1, "MIT"), (2, "MIT"), (6, "MIT"), (6, "MIT"), (6, "MIT"), (7, "BSD-3-Clause"), (7, "BSD-3-Clause"), (8, "CC-BY-NC-4.0")]
    assert [n for k, n, _ in found if k == 10] == ["Apache-2.0"]  # its opening statement
    assert found[0][2] == 1.0 and 0.8 <= found[1][2] < 1.0
    for license, statement, _ in STATEMENTS:
        assert [m.license for m in licenses.Scanner().scan(licenses.words_of(f"{filler} {statement} {filler}"))] == [license]
    assert licenses.license_matches(docs.limit(0)).collect() == []


def test_each_notice_is_its_own_license_only():
    scanner, filler = licenses.Scanner(), "Lorem ipsum the software of a copy and to the license without " * 5
    found = lambda text: [m.license for m in scanner.scan(licenses.words_of(text))]
    assert {"GPL-2.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later"} <= TEXTS.keys()
    for license, text in TEXTS.items():
        assert found(text) == found(f"{filler} {text} {filler}") == [license]
        # Slightly edited it keeps its license and version, or is none; it never becomes a relative's.
        words = text.split()
        for k in range(len(words)):
            assert set(found(" ".join(words[:k] + words[k + 1 :]))) <= {license}, (license, words[k])
    gpl = TEXTS["GPL-3.0-or-later"]
    assert found(gpl.replace("version 3", "version 2")) == ["GPL-2.0-or-later"]
    assert found(gpl.replace("GNU\nGeneral", "GNU Affero General").replace("GNU General", "GNU Affero General")) == ["AGPL-3.0-or-later"]
    assert found(gpl.replace("version 3", "version 4")) == []
    assert found("This work is licensed under the GNU Lesser General Public License, version 3.") == []
    assert found(TEXTS["BSD-3-Clause"].split("IN NO EVENT")[0]) == []  # not the whole text


def plain_scan(words, scanner):
    """The best license of a text that holds one, by aligning the text as a whole, without any filter."""
    best = []
    for number, template in enumerate(scanner.templates):
        passages = licenses._passages(licenses.align(words, template.words), scanner.reach, scanner._bridge(number))
        pairs = [p for passage in passages for p in passage]
        if pairs and len(pairs) >= scanner.coverage * len(template.words) and template.accepts(words, pairs):
            best.append((len(pairs), template.license))
    return max(best)[1] if best else None


def test_scan_finds_what_aligning_everything_finds():
    scanner, rng, seen = licenses.Scanner(), np.random.default_rng(6), 0
    for license, text in TEXTS.items():
        words = licenses.words_of(text)
        naming = {w for name in ("NAMING", "FOREIGN") for p in getattr(license_texts, name).get(license, []) for w in p.split()}
        for share in (0.05, 0.12, 0.19, 0.2, 0.25):
            for _ in range(6):
                free = [k for k, w in enumerate(words) if w not in naming]
                gone = set(rng.choice(free, min(len(free), int(share * len(words))), replace=False).tolist())
                kept = [w for k, w in enumerate(words) if k not in gone]
                for place in rng.integers(0, len(kept), rng.integers(0, 4)):
                    kept.insert(int(place), "foreign")
                want = plain_scan(kept, scanner)
                got = [m.license for m in scanner.scan(["filler"] * 50 + kept + ["filler"] * 50)]
                assert got == [want] * (want is not None), (license, share)
                seen += want == license
    assert seen > 5 * 6 * len(TEXTS) * 0.6


def test_a_match_goes_on_after_a_long_gap(spark):
    words = licenses.words_of(TEXTS["MIT"])
    text = words[:80] + [f"foreign{k}" for k in range(14)] + words[80:]
    (match,) = licenses.Scanner().scan(["filler"] * 30 + text + ["filler"] * 30)
    assert (match.license, match.matched, match.passages) == ("MIT", len(words), ((30, 110), (124, 44 + len(words) - 0)))
    docs = spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string")
    assert licenses.license_matches(docs).first()["passage"] == " ".join(words[:80]) + " ... " + " ".join(words[80:])


@pytest.mark.parametrize("after", ["or any later version", "or later", "of the License, or (at your option) any later version"])
def test_or_later_is_not_the_plain_license(after):
    scanner = licenses.Scanner()
    for version in (2, 3):
        text = f"This work is licensed under the GNU General Public License, version {version}"
        assert [m.license for m in scanner.scan(licenses.words_of(f"{text}."))] == [f"GPL-{version}.0"]
        assert scanner.scan(licenses.words_of(f"{text} {after}.")) == []


def test_edited_copies_side_by_side():
    words = [f"w{k}" for k in range(100)]
    plain = licenses.Scanner([licenses.Template("X", tuple(words))])
    for left, right in ((50, 50), (10, 90), (90, 10), (50, 20), (1, 1)):
        text = words[:left] + words[left + 1 :] + words[:right] + words[right + 1 :]
        assert [(m.matched, m.start, m.end) for m in plain.scan(text)] == [(99, 0, 99), (99, 99, 198)]
    fewer = [w for k, w in enumerate(words) if k % 6 or k < 6]
    assert [m.matched for m in plain.scan(fewer + fewer)] == [len(fewer)] * 2
    scanner, text = licenses.Scanner(), licenses.words_of(TEXTS["MIT"])
    for k in range(10, len(text) - 10, 9):
        copy = text[:k] + text[k + 1 :]
        if copy.count("permission") == text.count("permission") and copy.count("notice") == text.count("notice"):
            assert [m.license for m in scanner.scan(copy + copy)] == ["MIT", "MIT"], text[k]
    for license, statement, needed in STATEMENTS:
        short = licenses.words_of(statement)
        for word in set(short) - set(needed.split()):
            copy = [w for w in short if w != word]
            if len(copy) >= licenses.COVERAGE * len(short):
                assert [m.license for m in scanner.scan(copy + copy)] == [license] * 2, (statement, word)


def test_increasing_is_longest():
    rng = np.random.default_rng(1)
    for _ in range(50):
        values = rng.integers(0, 20, rng.integers(0, 15)).tolist()
        best = [1] * len(values)
        for i in range(len(values)):
            best[i] = 1 + max((best[k] for k in range(i) if values[k] < values[i]), default=0)
        got = [values[i] for i in licenses.increasing(values)]
        assert len(got) == max(best, default=0) and all(a < b for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << min(bits, 32), 1003, dtype=np.uint64).astype(np.uint32)
    packed = packing.pack(ids, bits)
    assert len(packed) == -(-1003 * bits // 8) and (packing.unpack(packed, bits, 1003) == ids).all()


def test_word_encoder_matches_the_library():
    from tokenizers import Tokenizer

    marked = [f"see {c}{rest} now" for c in ("J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a") for rest in ("", "an", "AN!", "É")]
    texts = [t or "" for t in TEXT] + marked
    want = [e.ids for e in Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)]
    encoder = packing.WordEncoder(TOKENIZER)
    for _ in range(2):  # from scratch and from memory
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([t.encode() for t in texts])] == want


def test_word_encoder_looks_up_each_distinct_word_once():
    class Counting(dict):
        looked_up = 0

        def get(self, key, default=None):
            self.looked_up += 1
            return super().get(key, default)

        def __getitem__(self, key):
            self.looked_up += 1
            return super().__getitem__(key)

    encoder = packing.WordEncoder(TOKENIZER)
    texts = [b"the cat sat on the mat " * 100, b"The MAT"] * 20
    first = encoder.encode(texts)
    encoder.known = Counting(encoder.known)
    assert encoder.encode(texts) == first and encoder.known.looked_up <= 8  # with the empty one
    # Slices, nulls and empty texts.
    assert [x.tobytes() for x in encoder.encode_array(pa.array([b"a", None, b"", *texts], pa.binary()).slice(1))] == [b"", b"", *first]
    assert encoder.encode([]) == []


def test_id_files(spark):
    from tokenizers import Tokenizer

    texts = TEXT * 8
    docs = spark.createDataFrame([(3 * i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, n int").repartition(4)
    folder = workspace(spark, "ids-test")
    packing.write_ids(docs, folder, TOKENIZER, range_bytes=6000)
    rows = sorted(packing.read_ids(spark, folder).collect())
    ids = [np.array([*e.ids, 1], "<u4") for e in Tokenizer.from_file(TOKENIZER).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    before = 0
    for row, own, i in zip(rows, ids, range(len(texts)), strict=True):
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (3 * i, before, len(own), zlib.crc32(own.tobytes()))
        before += len(own)
    names = sorted({r["file"] for r in rows})
    assert len(names) > 3
    reader = packing.FileReader(f"{folder}/{names[0]}")
    flat = np.concatenate(ids)[: reader.n]
    assert reader.bits == 16 and (reader.ids(5, 37) == flat[5:37]).all() and (reader.document(4) == ids[4]).all() and not len(reader.ids(3, 3))
    packing.write_ids(docs.limit(0), empty := workspace(spark, "ids-test"), TOKENIZER)
    assert packing.read_ids(spark, empty).collect() == []


def test_id_file_blocks(tmp_path):
    writer = packing.FileWriter(packing.Publisher(str(tmp_path)), "a.bin", 17)
    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 1 << 17, n).astype(np.uint32) for n in (3, 0, 150_000, 70_000, 1)]
    for k, part in enumerate(parts):
        writer.add(f"doc {k}", part)
    assert writer.close(pa.string()) == 220_004
    reader, flat = packing.FileReader(str(tmp_path / "a.bin")), np.concatenate(parts)
    for begin, end in ((0, 1), (65_535, 65_537), (131_072, 131_073), (10, 220_004)):
        assert (reader.ids(begin, end) == flat[begin:end]).all()
    assert reader.index["doc_id"].to_pylist() == [f"doc {k}" for k in range(5)] and (reader.document(3) == parts[3]).all()
    assert [p.name for p in tmp_path.iterdir()] == ["a.bin"]
