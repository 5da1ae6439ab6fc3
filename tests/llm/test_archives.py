"""WARC archives, registration and task-side files."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
from pathlib import Path
from urllib.parse import urlparse

import pytest

from docstrata.llm import warc
from docstrata.llm.storage import Publisher, free_name, settings, workspace

PAGES = [
    (4, "http://a.example/x?y=1", "<p>one</p>"), (2, "http://b.example/a b\r\nX: 1", "<p>é</p>" * 400), (9, None, "<p>one</p>"), (3, "http://c.example", None),
    (7, "http://d.example", ""), (2, "http://b.example/a b\r\nX: 1", "<p>é</p>" * 400), (None, "http://n.example", "<p>one</p>"), (None, None, "<p>alone</p>"), (12, "u", "<p>last</p>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "extra", 1) for p in PAGES], "page_id bigint, url string, html string, digest string, range int").repartition(3)


def expected(least):
    owner, out = {}, []
    for page_id, _, html in PAGES:
        body = html or ""
        if len(body.encode()) >= least and page_id is not None:
            owner[body] = min(owner.get(body, page_id), page_id)
    first = set()
    for page_id, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        data = (html or "").encode()
        own = owner.get(html or "")
        response = own is None or (own == page_id and (own, data) not in first) or len(data) < least
        first.add((page_id, data))
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if response else "revisit", None if response else own))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1, 5000])
def test_archives_round_trip(pages, spark, least):
    folder = workspace(spark, "warc-test")
    warc.write_warc(pages, folder, revisit_bytes=least)
    rows = [tuple(r)[:5] for r in warc.read_warc(spark, folder).collect()]
    assert sorted(rows, key=str) == expected(least)


def local(folder):
    return Path(urlparse(folder).path)


def test_archives_are_sorted_rolled_and_repeatable(pages, spark):
    first, second = workspace(spark, "warc-test"), workspace(spark, "warc-test")
    warc.write_warc(pages, first, range_bytes=500, roll_bytes=400)
    warc.write_warc(pages.repartition(5), second, range_bytes=500, roll_bytes=400)
    names = sorted(p.name for p in local(first).iterdir())
    assert names == sorted(p.name for p in local(second).iterdir()) and len(names) > 4 and not any(n.startswith(".") for n in names)
    assert all((local(first) / n).read_bytes() == (local(second) / n).read_bytes() for n in names)
    manifest = json.loads((local(first) / "manifest.json").read_text())
    assert manifest["records"] == len(PAGES) and [f["file"] for f in manifest["files"]] == [n for n in names if n != "manifest.json"]
    ids = [fields.get("X-Page-Id") for f in manifest["files"] for fields, _ in warc.records(f"{first}/{f['file']}")]
    assert ids == ["2", "2", "3", "4", "7", "9", "12", None, None]
    (local(first) / ".pages-junk.tmp").write_bytes(b"left by a lost attempt")
    (local(first) / "pages-999999-0000.warc.gz").write_bytes(b"not in the manifest")
    assert warc.read_warc(spark, first).count() == len(PAGES)


def test_records_are_well_formed(pages, spark):
    folder = workspace(spark, "warc-test")
    warc.write_warc(pages, folder)
    for path in sorted(local(folder).glob("*.warc.gz")):
        data = gzip.decompress(path.read_bytes())
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        for fields, block in warc.records(f"{folder}/{path.name}"):
            assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Block-Digest", "Content-Type", "Content-Length"} <= set(fields)
            assert " " not in fields["WARC-Target-URI"] and "X" not in fields
            assert block.startswith(b"HTTP/1.1 200 OK\r\n") and (fields["WARC-Type"] == "response" or block.endswith(b"\r\n\r\n"))


def test_damage_is_found(pages, spark):
    folder = workspace(spark, "warc-test")
    warc.write_warc(pages, folder)
    path = sorted(local(folder).glob("*.warc.gz"))[0]
    data = gzip.decompress(path.read_bytes())
    path.write_bytes(gzip.compress(data.replace(b"<p>", b"<q>", 1)))
    with pytest.raises(ValueError):
        list(warc.records(f"{folder}/{path.name}"))
    path.write_bytes(gzip.compress(data)[:-30])
    with pytest.raises(ValueError):
        list(warc.records(f"{folder}/{path.name}"))


def test_no_pages(pages, spark):
    folder = workspace(spark, "warc-test")
    warc.write_warc(pages.limit(0), folder)
    assert warc.read_warc(spark, folder).collect() == []


def test_unfinished_files_stay_hidden(tmp_path):
    publisher = Publisher(str(tmp_path))
    pending = publisher.open("a.bin")
    pending.write(b"abc")
    assert not (tmp_path / "a.bin").exists()
    Publisher(str(tmp_path)).write("a.bin", [b"whole"])
    pending.publish()
    assert (tmp_path / "a.bin").read_bytes() == b"abc" and [p.name for p in tmp_path.iterdir()] == ["a.bin"]


def test_names_and_settings(spark):
    assert free_name(["Slot", "_slot"], "slot") == "__slot"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with settings(spark, {"spark.sql.shuffle.partitions": "77"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert {"op5_tensored_minhash", "op10_sharded_warc"} <= set(entry.oracle_sql())
