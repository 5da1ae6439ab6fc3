"""HTML cleaning, text normalisation and content hashes as Arrow-batched stages.

Only the document column crosses into Python; every other column stays on the JVM.
The builders take a Column and are null-safe, so documents that need no parsing are
passed as null and cost nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docstrata.functions.files import BINARY_TYPES, sha256_hex
from docstrata.operators.markup import Removal, decode, prune

# What the cleaner removes.
CLEAN_TAGS = ["script", "style", "nav", "footer", "header", "noscript", "iframe"]
CLEAN_CLASSES = [
    "cookie-banner", "navbar", "footer-one", "footer-two", "footer-nav",
    "social-banner", "no-print", "return-to-search", "ptools-pager",
]
CLEAN_IDS = ["binderFixed", "advancedSearchControls", "searchPnl"]
# What the hash leaves out on top of that.
HASH_EXTRA_TAGS = ["link", "meta"]
HASH_EXTRA_CLASSES = ["aspNetHidden"]
LINK_TEXT = "Return to Search"

CLEANING = Removal(frozenset(CLEAN_TAGS), frozenset(CLEAN_CLASSES), frozenset(CLEAN_IDS), False, LINK_TEXT)
HASHING = Removal(
    frozenset(CLEAN_TAGS + HASH_EXTRA_TAGS),
    frozenset(CLEAN_CLASSES + HASH_EXTRA_CLASSES),
    frozenset(CLEAN_IDS),
    True,
    LINK_TEXT,
)


def _as_text(value: bytes | str) -> str:
    return value if isinstance(value, str) else decode(value)


CHECKED = T.StructType([T.StructField("value", T.StringType()), T.StructField("error", T.StringType())])
_ERROR_CHARS = 500


def error_text(error: Exception) -> str:
    """What is kept of a document's failure: its kind and message."""
    return f"{type(error).__name__}: {error}"[:_ERROR_CHARS]


def check_size(document: bytes | str, max_bytes: int | None) -> None:
    """Raise for a document of more than ``max_bytes``; text counts in UTF-8."""
    if max_bytes is not None and len(document) > max_bytes // 4:
        size = len(document.encode("utf-8", "replace")) if isinstance(document, str) else len(document)
        if size > max_bytes:
            raise ValueError(f"{size} bytes, more than {max_bytes}")


def _checked(convert: Callable[[str], str], max_bytes: int | None) -> Callable[[bytes | str], tuple[str | None, str | None]]:
    def one(document: bytes | str) -> tuple[str | None, str | None]:
        try:
            check_size(document, max_bytes)
            value = convert(_as_text(document))
            value.encode("utf-8")  # a lone surrogate is no text
            return value, None
        except Exception as error:  # counted by the jobs, whatever it is
            return None, error_text(error)

    return one


# Documents that are Python objects at the same time, and their characters or bytes.
_SLICE_ROWS, _SLICE_SIZE = 256, 1 << 20


def in_slices(docs: pa.Array, one: Callable[[bytes | str | None], object], pack: Callable[[list], pa.Array]) -> Iterator[pa.Array]:
    """Results of ``one`` for each document of a batch, packed a few documents at a time.

    A session's batch may hold 10,000 documents: as Python objects all at once, with all that
    is made of them, they would be several times the batch.
    """
    found, size = [], 0
    for doc in docs:
        source = doc.as_py()
        found.append(one(source))
        size += len(source or "")
        if len(found) >= _SLICE_ROWS or size >= _SLICE_SIZE:
            yield pack(found)
            found, size = [], 0
    if found:
        yield pack(found)


def document_udf(convert: Callable[[str], str], max_bytes: int | None = None):
    """Arrow UDF: ``struct<value, error>`` of each non-null document (string or bytes) of a batch.

    A document on which ``convert`` fails, or that is longer than ``max_bytes``, has an error
    and no value; the others of its batch are not touched by it.
    """
    one = _checked(convert, max_bytes)

    def pack(found: list[tuple[str | None, str | None]]) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array([v for v, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())], names=["value", "error"])

    @F.arrow_udf(CHECKED)
    def stage(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for docs in batches:
            yield from in_slices(docs, lambda d: (None, None) if d is None else one(d), pack)

    return stage


def value_udf(convert: Callable[[str], str]):
    """Arrow UDF with the value alone, null for a document that fails.

    Not over an iterator, of which Spark runs only one a stage: several of these share one.
    """
    one = _checked(convert, None)

    @F.arrow_udf(T.StringType())
    def stage(docs: pa.Array) -> pa.Array:
        parts = in_slices(docs, lambda d: None if d is None else one(d)[0], lambda found: pa.array(found, pa.string()))
        return pa.concat_arrays([pa.array([], pa.string()), *parts])

    return stage


def text_of(source: str) -> str:
    """Normalised text of one document."""
    return prune(source, HASHING, keep_html=False)[0]


def digest_of(source: str) -> str:
    """Hash of the normalised text of one document."""
    return hashlib.sha256(text_of(source).encode("utf-8")).hexdigest()


def main_of(source: str, main_id: str = "main") -> str:
    """Cleaned main content of one document."""
    return prune(source, CLEANING, keep_html=True, main_id=main_id)[1]


def normalized_text(doc: Column) -> Column:
    """Visible text of an HTML document (string or bytes), volatile parts left out; null if it fails."""
    return value_udf(text_of)(doc)


def cleaned_html(doc: Column, main_id: str = "main") -> Column:
    """Main content of an HTML document, boilerplate removed, as HTML text; null if it fails."""
    return value_udf(lambda source: main_of(source, main_id))(doc)


def content_hash(content: Column, file_type: Column) -> Column:
    """``checked_hash`` without its errors: null for a document that fails."""
    return checked_hash(content, file_type)["value"]


def checked_hash(content: Column, file_type: Column, max_bytes: int | None = None) -> Column:
    """``struct<value, error>``: a SHA-256 that is stable under volatile markup.

    pdf/doc: hash of the raw bytes, on the JVM.  Everything else: hash of the normalised
    text; it is taken next to the parser, so the text itself never travels back.
    """
    binary = file_type.isin(*BINARY_TYPES)
    parsed = document_udf(digest_of, max_bytes)(F.when(~F.coalesce(binary, F.lit(False)), content))
    return F.when(binary, _no_error(sha256_hex(content))).otherwise(parsed)


def _no_error(value: Column) -> Column:
    return F.struct(value.alias("value"), F.lit(None).cast("string").alias("error"))


def transformed_content(content: Column, file_type: Column) -> Column:
    """Bytes of the transformed zone, null for a document that fails."""
    return checked_transform(content, file_type)["value"]


def checked_transform(content: Column, file_type: Column, max_bytes: int | None = None) -> Column:
    """``struct<value, error>``: html cleaned, any other type passed through."""
    is_html = file_type == "html"
    cleaned = document_udf(main_of, max_bytes)(F.when(is_html, content))
    return F.when(is_html, F.struct(F.encode(cleaned["value"], "UTF-8").alias("value"), cleaned["error"].alias("error"))).otherwise(_no_error(content))


def normalize_html(df: DataFrame, html_col: str, out_col: str = "normalized_text") -> DataFrame:
    """Table form of ``normalized_text``."""
    return df.withColumn(out_col, normalized_text(F.col(html_col)))


def clean_html(df: DataFrame, html_col: str, out_col: str = "cleaned_html", main_id: str = "main") -> DataFrame:
    """Table form of ``cleaned_html``."""
    return df.withColumn(out_col, cleaned_html(F.col(html_col), main_id))
