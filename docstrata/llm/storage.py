"""Shared storage of the operators: staged tables, and files written and published by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlparse

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from docstrata.session import scratch_dir, ship_package


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors can reach, for one run of an operator."""
    ship_package(spark)
    folder = f"{scratch_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(folder)
    return folder


@contextmanager
def passing_workspaces(spark: SparkSession) -> Iterator[None]:
    """Workspaces made inside are deleted at the end: for steps whose results are written by then."""
    token = _made.set([])
    try:
        yield
        for folder in _made.get():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    finally:
        _made.reset(token)


def staged(frame: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: the lineage is cut and lost executors lose nothing."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """SQL settings for the actions inside; the session's own come back after."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system and path of a URI; a path without a scheme is local."""
    scheme = urlparse(uri).scheme
    if not scheme:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(f"s3://{uri.split('://', 1)[1]}" if scheme in ("s3a", "s3n") else uri)


class Publisher:
    """Files of one task: each is written under a name of the attempt and renamed when complete.

    A repeated or speculative attempt writes the same bytes under its own temporary name, so
    the file under the final name is whole at any time.
    """

    def __init__(self, folder: str):
        self.store, self.root = filesystem(folder)
        self.store.create_dir(self.root, recursive=True)
        context = TaskContext.get()
        self.attempt = f"{context.taskAttemptId() if context else 0}-{uuid.uuid4().hex[:8]}"

    def write(self, name: str, chunks) -> int:
        temporary, size = f"{self.root}/.{name}.{self.attempt}.tmp", 0
        with self.store.open_output_stream(temporary, compression=None) as out:
            for chunk in chunks:
                out.write(chunk)
                size += len(chunk)
        self.store.move(temporary, f"{self.root}/{name}")
        return size

    def open(self, name: str) -> _Pending:
        return _Pending(self, name)


class _Pending:
    """A file that grows until it is published."""

    def __init__(self, owner: Publisher, name: str):
        self.owner, self.name, self.size = owner, name, 0
        self.temporary = f"{owner.root}/.{name}.{owner.attempt}.tmp"
        self.stream = owner.store.open_output_stream(self.temporary, compression=None)

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def publish(self) -> None:
        self.stream.close()
        self.owner.store.move(self.temporary, f"{self.owner.root}/{self.name}")


def free_name(taken: list[str], base: str) -> str:
    """A column name that no input column has."""
    lowered = {name.lower() for name in taken}
    while base.lower() in lowered:
        base = f"_{base}"
    return base
