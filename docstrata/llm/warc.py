"""Deterministic WARC archives of pages: range-sorted records in files rolled by compressed size.

Each page is one record with a payload of its HTML in UTF-8.  Of the records with equal
payloads of at least ``revisit_bytes`` bytes, the one of the smallest page id is a response
and the others are revisits that refer to it; smaller payloads are always responses.
Headers and digests are made anew from the row, record ids are derived from page and
payload and the date is a parameter, so a rerun over the same ranges writes the same bytes.

Rows are dealt to ranges of page ids and sorted; the task of a range writes its files one
after the other, each record a gzip member, and starts a new file when the compressed size
passes ``roll_bytes``.  A file is written under a temporary name of the attempt and renamed;
the driver writes the manifest last, and readers follow the manifest only.

Defined cases: null HTML is the empty payload.  Null page ids come last and are a response
only if no row with an id has the payload.  Of rows that repeat page id and payload, the
first is as above and the others revisit it (a null id refers to nothing).  A null URL becomes
``urn:page:<id>``; characters that would break a header are percent-encoded.  An empty table
gives a manifest without files.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.llm.ranks import key_ranges
from docstrata.llm.storage import Publisher, filesystem, staged, workspace
from docstrata.session import ship_package

DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LEVEL, _RANGE_BYTES, _ROLL_BYTES = 4, 96 << 20, 64 << 20
_CHUNK = 1 << 20


def digest(data: bytes) -> str:
    """Upper-case Base32 of SHA-1, as WARC digests are written."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{payload_digest}')}>"


def _target(url: str | None, page_id) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"


def record(page_id, url: str | None, payload: bytes, payload_digest: str, refers_to, revisit: bool, date: str = DATE) -> bytes:
    """One record, uncompressed; a revisit has the HTTP headers but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, payload_digest)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {_target(url, page_id)}", f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines.append(f"WARC-Profile: {_PROFILE}")
        if refers_to is not None:
            lines += [f"WARC-Refers-To: {record_id(refers_to, payload_digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write(batches: Iterator[pa.RecordBatch], folder: str, roll_bytes: int, date: str) -> Iterator[pa.RecordBatch]:
    publisher, file, at, part, records, done = Publisher(folder), None, None, 0, 0, []
    last, seen = None, set()  # the page id of the row before, and its payloads

    def finish() -> None:
        done.append((at, part, file.name, records, file.size))
        file.publish()

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("range", "page_id", "url", "html", "refers_to", "revisit")]
        for number, page_id, url, html, refers_to, revisit in zip(*columns):
            if file and (number != at or file.size >= roll_bytes):
                finish()
                file, part = None, part + 1 if number == at else 0
            if not file:
                at, records = number, 0
                file = publisher.open(f"pages-{number:06d}-{part:04d}.warc.gz")
            payload = html or b""
            own = digest(payload)
            if page_id is None or page_id != last:
                last, seen = page_id, set()
            if page_id is not None and own in seen and revisit is not None:
                refers_to, revisit = page_id if not revisit else refers_to, True
            seen.add(own)
            file.write(_member(record(page_id, url, payload, own, refers_to, bool(revisit), date)))
            records += 1
    if file:
        finish()
    if done:
        types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=["range", "part", "file", "records", "bytes"])


def write_warc(
    pages: DataFrame, folder: str, *, revisit_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html",
    range_bytes: int = _RANGE_BYTES, roll_bytes: int = _ROLL_BYTES, date: str = DATE,
) -> None:
    """Write the archives and ``manifest.json`` to a folder that all executors reach.

    First owners of repeated payloads are found on (page id, digest) rows alone; the join
    back is by payload digest with a written right side, so Spark can split a hot payload.
    """
    spark = pages.sparkSession
    work = workspace(spark, "warc")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("html"))
    keyed = rows.select("page_id", F.sha1("html").alias("digest"), F.octet_length("html").alias("n")).where(F.col("n") >= revisit_bytes)
    owners = staged(
        keyed.groupBy("digest", "n").agg(F.count("*").alias("k"), F.min("page_id").alias("owner")).where("k > 1").select("digest", "n", "owner"),
        f"{work}/owners",
    )
    ranges = key_ranges(rows, "page_id", "html", range_bytes)
    marked = rows.withColumn("range", ranges.of("page_id")).withColumn("digest", F.sha1("html")).withColumn("n", F.octet_length("html"))
    known = marked.join(owners, ["digest", "n"], "left")
    # revisit: null where payloads are never compared, else whether another page owns it.
    other = ~F.col("page_id").eqNullSafe(F.col("owner"))
    revisit = F.when(F.col("n") < revisit_bytes, F.lit(None)).otherwise(F.col("owner").isNotNull() & other)
    ready = known.select("range", "page_id", "url", "html", F.when(F.col("owner").isNotNull() & other, F.col("owner")).alias("refers_to"), revisit.alias("revisit"))
    written = (
        ready.repartitionById(ranges.count, "range").sortWithinPartitions("range", F.col("page_id").asc_nulls_last(), "url", "html")
        .mapInArrow(partial(_write, folder=folder, roll_bytes=roll_bytes, date=date), "range int, part int, file string, records bigint, bytes bigint")
    )
    files = [row.asDict() for row in sorted(written.collect())]
    Publisher(folder).write("manifest.json", [json.dumps({"records": sum(f["records"] for f in files), "files": files}).encode()])


def records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of one archive, checked against its block digest."""
    store, path = filesystem(uri)
    with store.open_input_stream(path, compression=None) as stream:
        data, plain = b"", None
        while True:
            if not data:
                data = stream.read(_CHUNK)
                if not data:
                    break
            plain = plain or (zlib.decompressobj(31), [])
            unpacker, parts = plain
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if not unpacker.eof:
                continue
            whole, plain = b"".join(parts), None
            head, _, rest = whole.partition(b"\r\n\r\n")
            first, *lines = head.decode("utf-8").split("\r\n")
            fields = {name: value for name, _, value in (line.partition(": ") for line in lines)}
            block = rest[: int(fields["Content-Length"])]
            if first != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
                raise ValueError(f"damaged record in {uri}")
            yield fields, block
        if plain:
            raise ValueError(f"{uri} ends inside a record")


def _number(text: str | None, kind: pa.DataType):
    return None if text is None else text if pa.types.is_string(kind) else int(text)


def _read(batches: Iterator[pa.RecordBatch], folder: str, text_ids: bool) -> Iterator[pa.RecordBatch]:
    kind = pa.string() if text_ids else pa.int64()
    types = [kind, pa.int64(), pa.string(), pa.string(), kind, pa.string(), pa.string()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "file"]
    for batch in batches:
        for name in batch.column(0).to_pylist():
            out = []
            for fields, block in records(f"{folder}/{name}"):
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                own = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and (len(payload) != size or digest(payload) != own):
                    raise ValueError(f"damaged payload in {name}")
                out.append((_number(fields.get("X-Page-Id"), kind), size, own, fields["WARC-Type"], _number(fields.get("X-Refers-To-Page-Id"), kind), fields["WARC-Target-URI"], name))
                if len(out) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def read_warc(spark: SparkSession, folder: str, text_ids: bool = False) -> DataFrame:
    """One row per record of the archives that a manifest names."""
    ship_package(spark)
    store, path = filesystem(f"{folder}/manifest.json")
    with store.open_input_stream(path) as stream:
        files = [(f["file"],) for f in json.loads(stream.read())["files"]]
    kind = "string" if text_ids else "bigint"
    return spark.createDataFrame(files, "file string").repartition(max(len(files), 1)).mapInArrow(
        partial(_read, folder=folder, text_ids=text_ids),
        f"page_id {kind}, payload_bytes bigint, payload_digest string, record_type string, refers_to {kind}, target_uri string, file string",
    )
