"""Readers for captured responses, logs and the body dimension."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata import schemas

# The default search categories and their parameter values.
BODIES = {
    "Employment Appeals Tribunal": "1",
    "Equality Tribunal": "2",
    "Labour Court": "3",
    "Workplace Relations Commission": "4",
}


def body_dimension(spark: SparkSession, bodies: Mapping[str, str] | None = None) -> DataFrame:
    """Bodies to search, name and parameter value."""
    rows = list((BODIES if bodies is None else bodies).items())
    return spark.createDataFrame(rows, schemas.BODIES)


def search_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured result pages (Parquet)."""
    return spark.read.schema(schemas.SEARCH_PAGES).parquet(path)


def doc_responses(spark: SparkSession, path: str) -> DataFrame:
    """Captured document responses (Parquet)."""
    return spark.read.schema(schemas.DOC_RESPONSES).parquet(path)


@dataclass(frozen=True)
class ResponseLog:
    """A folder to which captured responses are added as Parquet files; files do not change.

    Jobs given the folder instead of its rows index the headers of new files once, read the
    content of the files they need alone, and see what was added since they were started.
    """

    spark: SparkSession
    path: str

    def files(self) -> list[str]:
        """All files there are now."""
        return sorted(doc_responses(self.spark, self.path).inputFiles())

    def read(self, files: Iterable[str] | None = None) -> DataFrame:
        """The responses of some files (default: of all)."""
        names = [self.path] if files is None else [unquote(name) for name in files]  # Spark names files as URLs
        if not names:
            return self.spark.createDataFrame([], schemas.DOC_RESPONSES)
        return self.spark.read.schema(schemas.DOC_RESPONSES).parquet(*names)

    def heads(self, files: Iterable[str]) -> DataFrame:
        """Headers, with the file that holds each."""
        rows = self.read(files).withColumn("file", F.col("_metadata.file_path"))
        return rows.select(*schemas.HEADS.fieldNames())

    def arrivals(self, max_files: int | None = None) -> DataFrame:
        """A stream with a row for each response that is added; no column of it is read."""
        reader = self.spark.readStream.schema(schemas.DOC_RESPONSES)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path).select(F.lit(True).alias("arrived"))


def search_pages_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Captured result pages as a file stream."""
    reader = spark.readStream.schema(schemas.SEARCH_PAGES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def object_tree(spark: SparkSession, path: str, root: str, glob: str | None = None) -> DataFrame:
    """Files below a folder of an object store as (file_path, content, length).

    ``root`` is the prefix that is cut off to give the object key.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    key = F.substring_index(F.col("path"), root.rstrip("/") + "/", -1)
    return reader.load(path).select(key.alias("file_path"), "content", "length")


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with their file and a position that orders them inside it."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def log_stream(spark: SparkSession, path: str) -> DataFrame:
    """Log lines as a stream of newly arriving files."""
    return spark.readStream.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
