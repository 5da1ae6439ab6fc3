"""File types, MIME types, object keys and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BINARY_TYPES = ("pdf", "doc")


def file_type(content_type: Column) -> Column:
    """pdf / doc / html from a Content-Type header; html when in doubt or absent."""
    header = F.lower(content_type)
    return (
        F.when(F.contains(header, F.lit("pdf")), "pdf")
        .when(F.contains(header, F.lit("msword")) | F.contains(header, F.lit("officedocument")), "doc")
        .otherwise("html")
    )


def mime_type(ftype: Column) -> Column:
    """MIME type stored with a blob."""
    return (
        F.when(ftype == "html", "text/html")
        .when(ftype == "pdf", "application/pdf")
        .when(ftype == "doc", "application/msword")
        .otherwise("application/octet-stream")
    )


def landing_key(body: Column, partition_date: Column, identifier: Column, ftype: Column) -> Column:
    """``body/partition/identifier.ext``; spaces go from the body, slashes from the identifier."""
    unknown = F.lit("unknown")
    return F.concat(
        F.translate(F.coalesce(body, unknown), " ", "_"),
        F.lit("/"),
        F.coalesce(partition_date, unknown),
        F.lit("/"),
        F.translate(F.coalesce(identifier, unknown), "/", "-"),
        F.lit("."),
        ftype,
    )


def transformed_name(identifier: Column, ftype: Column) -> Column:
    """Flat ``identifier.ext``; both slashes and spaces are replaced."""
    return F.concat(F.translate(F.coalesce(identifier, F.lit("unknown")), "/ ", "-_"), F.lit("."), ftype)


def sha256_hex(data: Column) -> Column:
    """SHA-256 of bytes (or of a string's UTF-8 bytes), lower-case hex."""
    return F.sha2(data, 256)
