"""Column builders; all run on the JVM inside whole-stage code generation."""

from docstrata.functions.dates import (
    date_partitions, format_search_date, iso_from_slashes, partition_start_of, published_day,
)
from docstrata.functions.files import (
    BINARY_TYPES, file_type, landing_key, mime_type, sha256_hex, transformed_name,
)
from docstrata.functions.text import collapse, join_stripped, parse_int, strip, total_results, words
from docstrata.functions.urls import document_url, query_string, resolve_url, search_url

__all__ = [
    "BINARY_TYPES", "collapse", "date_partitions", "document_url", "file_type", "format_search_date",
    "iso_from_slashes", "join_stripped", "landing_key", "mime_type", "parse_int", "partition_start_of",
    "published_day", "query_string", "resolve_url", "search_url", "sha256_hex", "strip",
    "total_results", "transformed_name", "words",
]
