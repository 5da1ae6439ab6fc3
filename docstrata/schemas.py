"""Row types of the lake.  Metadata is all nullable strings, as captured."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


BODIES = T.StructType(_strings("body", "body_id"))

SEARCH_PAGES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("partition_start", T.DateType()),
        T.StructField("partition_end", T.DateType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("captured_at", T.TimestampType()),
        T.StructField("html", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

DOC_RESPONSES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("error", T.StringType()),
        T.StructField("captured_at", T.TimestampType()),
    ]
)

LISTING_FIELDS = [
    "identifier", "description", "published_date", "published_date_iso",
    "ref_no", "doc_url", "body", "partition_date", "scraped_at",
]
FILE_FIELDS = ["file_path", "file_hash", "file_type"]
LANDING_FIELDS = [*LISTING_FIELDS, *FILE_FIELDS, "updated_at"]

TRANSFORMED_FIELDS = [
    "identifier", "description", "published_date", "ref_no", "doc_url", "body",
    "partition_date", "file_type", "file_hash", "file_path", "original_file_path",
    "transformed_at", "original_file_hash",
]

LANDING_METADATA = T.StructType(_strings(*LANDING_FIELDS))
TRANSFORMED_METADATA = T.StructType(_strings(*TRANSFORMED_FIELDS))

# Change-log rows: metadata plus what the run did with it and which stored object the
# path got.  ``partition_date`` stays a string, so an explicit schema is passed on read.
# ``text_id`` names the result on a parsed page whose text is the row's description; a row
# without it holds its description itself.
_LOG_EXTRA = [
    T.StructField("action", T.StringType()),
    T.StructField("blob_id", T.StringType()),
    T.StructField("blob_day", T.StringType()),
    T.StructField("arrived", T.TimestampType()),
    T.StructField("text_id", T.StringType()),
    T.StructField("version", T.LongType()),
]
LANDING_LOG = T.StructType([*LANDING_METADATA.fields, *_LOG_EXTRA])
TRANSFORMED_LOG = T.StructType([*TRANSFORMED_METADATA.fields, *_LOG_EXTRA])

# Stored objects, once per captured document however many records point at it; ``day`` is the
# first partition of these records and a folder of the table.
BLOBS = T.StructType(
    [
        T.StructField("blob_id", T.StringType()),
        T.StructField("file_type", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("error", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("version", T.LongType()),
    ]
)
# Documents and result pages that could not be read, with the reason.
QUARANTINE = T.StructType(
    [*_strings("identifier", "url", "body", "partition_date", "error"), T.StructField("version", T.LongType())]
)
# Of the parsed pages that a run keeps, what their results' texts are read from.
_TEXTS = T.ArrayType(T.StructType([T.StructField("description", T.ArrayType(T.StringType()))]))
TEXT_PAGES = T.StructType(
    [
        T.StructField("_page", T.LongType()),
        T.StructField("page", T.StructType([T.StructField("items", _TEXTS)])),
        *_strings("day", "attempt"),
    ]
)
# Results whose document has not been captured yet, as they stood on their page.
PENDING = T.StructType(
    [
        *_strings(*LISTING_FIELDS, "partition_end", "text_id"),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("captured_at", T.TimestampType()),
    ]
)
# Headers of captured responses, and the file that holds each.
HEADS = T.StructType([f for f in DOC_RESPONSES.fields if f.name != "content"] + _strings("file"))
# Path -> object, the newest per path.
BLOB_INDEX = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("blob_id", T.StringType()),
        T.StructField("blob_version", T.LongType()),
        T.StructField("blob_day", T.StringType()),
        T.StructField("version", T.LongType()),
    ]
)

FAILED_URL = T.StructType(_strings("url", "error"))
PARTITION_SUMMARY = T.StructType(
    [
        *_strings("body", "partition_start", "partition_end"),
        T.StructField("total_results", T.LongType()),
        T.StructField("records_scraped", T.LongType()),
        T.StructField("records_skipped", T.LongType()),
        T.StructField("records_failed", T.LongType()),
        T.StructField("failed_urls", T.ArrayType(FAILED_URL)),
        T.StructField("chunk", T.LongType()),
        T.StructField("chunks", T.LongType()),
    ]
)
CRAWL_SUMMARY = T.StructType(
    [
        *_strings("event", "reason"),
        T.StructField("total_expected", T.LongType()),
        T.StructField("total_scraped", T.LongType()),
        T.StructField("total_skipped", T.LongType()),
        T.StructField("total_failed", T.LongType()),
        T.StructField("partitions_processed", T.LongType()),
    ]
)
