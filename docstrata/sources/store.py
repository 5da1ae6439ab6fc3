"""Parquet tables of the two zones.

Each run writes its own ``version=N`` folder of a zone:

* ``blobs``  the stored bytes, one row per object, in a folder per partition day, by key,
* ``log``    metadata rows with the action taken, partitioned by ``partition_date``,
* ``parsed`` the parsed result pages, as they were captured: log rows of both zones name the place of
  their text there (``pages``, in folders by day, in lakes that held pages before),
* ``quarantine`` documents and pages that could not be read, with the reason,
* ``pending`` results whose document has not been captured yet, if the run keeps them,
* ``heads``  headers of captured responses, and ``headfiles``, the files they came from,
* ``commits`` one row, written last, which names the attempt that counts.

Every attempt at a version writes to folders of its own (``version=N/attempt=A``) and is
published by its marker alone, so a run that died half-way is invisible, and a version that
is run again keeps its old rows and objects until the new ones are all there.

Current state is the newest applied log row per identifier.  ``compact`` stores it as a
snapshot; readers then aggregate only the log rows after the snapshot.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docstrata import schemas
from docstrata.operators.listing import result_texts
from docstrata.operators.reconcile import last_per_key, require_unique, spread_nulls
from docstrata.sources.captures import ResponseLog

LANDING = "landing"
TRANSFORMED = "transformed"
_LOG_SCHEMAS = {LANDING: schemas.LANDING_LOG, TRANSFORMED: schemas.TRANSFORMED_LOG}
_COMMITS = T.StructType(
    [T.StructField("at", T.StringType()), T.StructField("version", T.LongType()), T.StructField("attempt", T.StringType())]
)
APPLIED = ("insert", "update")
# Fixed value: tables hold texts, which it makes much smaller than the default codec does.
_CODEC = ("compression", "zstd")


class Lake:
    """The tables below one root folder (any Hadoop file system path)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # By zone and version: the attempt that this object is writing.
        self._attempts: dict[tuple[str, int], str] = {}

    def _attempt(self, zone: str, version: int) -> str:
        """Later attempts sort after earlier ones."""
        return self._attempts.setdefault((zone, version), f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _read(self, schema: T.StructType, *parts: str) -> DataFrame:
        """Table at a path, empty when nothing has been written yet."""
        try:
            return self.spark.read.schema(schema).parquet(self.path(*parts))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._empty(schema)

    def _empty(self, schema: T.StructType) -> DataFrame:
        """No rows, in a form the optimizer recognises as such."""
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return self.spark.range(1).filter(F.lit(False)).select(*columns)

    def _read_versions(self, schema: T.StructType, attempts: Mapping[int, str], *parts: str) -> DataFrame:
        """Only the folders of the given versions' attempts; the others are not even listed."""
        paths = [self.path(*parts, f"version={v}", f"attempt={a}") for v, a in attempts.items()]
        if not paths:
            return self._empty(schema)
        rows = self.spark.read.schema(schema).option("basePath", self.path(*parts)).parquet(*paths)
        return rows.select(*schema.fieldNames())

    # -- intermediate tables -------------------------------------------------

    def stage(self, rows: DataFrame, name: str, version: int) -> DataFrame:
        """Write an intermediate table of a run and read it back.

        Cuts lineage durably (an executor loss does not repeat the stage before it) and
        gives the planner true sizes, so joins below the broadcast threshold are
        broadcast and larger ones are not.
        """
        attempt = self._attempt("staging", version)
        target = self.path("staging", f"version={version}", f"attempt={attempt}", name)
        rows.write.mode("overwrite").option(*_CODEC).parquet(target)
        return self.spark.read.schema(rows.schema).parquet(target)

    # -- commits ---------------------------------------------------------------

    def _markers(self, *parts: str) -> list[tuple[int, str]]:
        """All versions and attempts that were ever published, in order."""
        # One small file per run, whatever the size of the data; listing needs no job.
        files = self._read(_COMMITS, *parts).inputFiles()
        found = (re.search(r"/version=(\d+)/attempt=([^/]+)/", f).groups() for f in files)
        return sorted((int(version), attempt) for version, attempt in found)

    def _marked(self, *parts: str) -> dict[int, str]:
        """Published versions in order, each with its latest attempt."""
        return dict(self._markers(*parts))

    def _mark(self, at: str, version: int, attempt: str, *parts: str) -> None:
        """Add a marker; those of earlier attempts stay and no longer count."""
        row = self.spark.range(1).select(F.lit(at).alias("at"))
        row.coalesce(1).write.mode("overwrite").parquet(self.path(*parts, f"version={version}", f"attempt={attempt}"))

    def committed(self, zone: str) -> list[int]:
        return list(self._marked(zone, "commits"))

    def commit(self, zone: str, version: int, at: str) -> None:
        """Publish what this object has written of a version."""
        self._mark(at, version, self._attempt(zone, version), zone, "commits")
        del self._attempts[(zone, version)]
        self._attempts.pop(("staging", version), None)

    def commit_stream(self, zone: str) -> DataFrame:
        """Versions as they are committed."""
        return self.spark.readStream.schema(_COMMITS).parquet(self.path(zone, "commits"))

    def next_version(self, zone: str) -> int:
        return max(self.committed(zone), default=0) + 1

    # -- writing -----------------------------------------------------------------

    def write_blobs(self, blobs: DataFrame, zone: str, version: int) -> DataFrame:
        """Store objects of a run; returns the written table."""
        columns = [c for c in schemas.BLOBS.fieldNames() if c != "version"]
        attempt = self._attempt(zone, version)
        target = self.path(zone, "blobs", f"version={version}", f"attempt={attempt}")
        # In order of the key, and with Bloom filters on it, most row groups can be skipped.
        ordered = blobs.select(*columns).sortWithinPartitions("day", "blob_id")
        writer = ordered.write.mode("overwrite").option(*_CODEC).partitionBy("day").option("parquet.bloom.filter.enabled#blob_id", "true")
        # Filters of the size that the keys need: a fixed one takes 1 MB of every file.
        writer.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(target)
        return self._read_versions(schemas.BLOBS, {version: attempt}, zone, "blobs")

    def write_pages(self, pages: DataFrame, version: int) -> DataFrame:
        """Keep the parsed result pages of a run, each with a number ``_page``; returns the written table.

        They are written where they are parsed: a result's text does not move.
        """
        day = F.date_format("partition_start", "yyyy-MM-dd")
        rows = pages.withColumns({"day": day, "_page": F.monotonically_increasing_id()})
        target = self.path(LANDING, "parsed", f"version={version}", f"attempt={self._attempt(LANDING, version)}")
        rows.write.mode("overwrite").option(*_CODEC).parquet(target)
        return self.spark.read.schema(rows.schema).parquet(target).select(*rows.columns)

    def text_id(self, version: int) -> Column:
        """The name of a result's text from ``_page`` and ``pos`` of the pages that this object is writing."""
        return F.concat_ws("|", F.lit(self._attempt(LANDING, version)), "_page", "pos")

    def _with_texts(self, rows: DataFrame, droppable: bool = False) -> DataFrame:
        """Rows of a log or a queue with the descriptions that they name.

        ``droppable`` shows the optimizer that a name has one text, so that it leaves the
        texts out if no description is used.
        """
        attempts = [attempt for _, attempt in self._markers(LANDING, "commits")]
        kept = [self._read(schemas.TEXT_PAGES, LANDING, name).select(*schemas.TEXT_PAGES.fieldNames()) for name in ("parsed", "pages")]
        pages = kept[0].unionByName(kept[1]).filter(F.col("attempt").isin(*attempts))
        found = result_texts(pages, ["day", "attempt", "_page"]).select(
            F.col("day").alias("_day"), F.concat_ws("|", "attempt", "_page", "pos").alias("_name"), F.col("description").alias("_text")
        )
        if droppable:
            found = found.groupBy("_day", "_name").agg(F.first("_text").alias("_text"))
        named = rows.withColumn("_wanted", spread_nulls(F.col("text_id"), "identifier"))
        same = (F.col("partition_date") == F.col("_day")) & (F.col("_wanted") == F.col("_name"))
        described = named.join(found, same, "left").withColumn("description", F.coalesce("description", "_text"))
        return described.select(*rows.columns)

    def write_log(self, rows: DataFrame, zone: str, version: int) -> None:
        """Append the metadata changes of a run."""
        columns = [c for c in _LOG_SCHEMAS[zone].fieldNames() if c != "version"]
        attempt = self._attempt(zone, version)
        _by_partition(rows.select(*columns)).parquet(self.path(zone, "log", f"version={version}", f"attempt={attempt}"))

    def _write(self, rows: DataFrame, schema: T.StructType, zone: str, name: str, version: int) -> DataFrame:
        """Write a further table of a run; returns what was written."""
        attempt = self._attempt(zone, version)
        columns = [c for c in schema.fieldNames() if c != "version"]
        rows.select(*columns).write.mode("overwrite").option(*_CODEC).parquet(self.path(zone, name, f"version={version}", f"attempt={attempt}"))
        return self._read_versions(schema, {version: attempt}, zone, name)

    def _read_committed(self, schema: T.StructType, zone: str, name: str, before: int | None = None, last: bool = False) -> DataFrame:
        """A further table in the versions that have it (``last``: in the newest of these)."""
        kept = self._marked(zone, name, "commits")
        wanted = {v: a for v, a in self._marked(zone, "commits").items() if kept.get(v) == a and (before is None or v < before)}
        if last:
            wanted = dict([max(wanted.items())]) if wanted else {}
        return self._read_versions(schema, wanted, zone, name)

    def write_quarantine(self, rows: DataFrame, zone: str, version: int) -> None:
        """Keep what a run could not read; nothing is written if there is none."""
        if not rows.isEmpty():
            self._write(rows, schemas.QUARANTINE, zone, "quarantine", version)
            self._mark("", version, self._attempt(zone, version), zone, "quarantine", "commits")

    def quarantine(self, zone: str) -> DataFrame:
        """All documents and pages that runs could not read."""
        return self._read_committed(schemas.QUARANTINE, zone, "quarantine")

    def write_pending(self, rows: DataFrame, version: int) -> None:
        """Keep the results that still wait for their document: the whole queue, as of this version."""
        self._write(rows, schemas.PENDING, LANDING, "pending", version)
        self._mark("", version, self._attempt(LANDING, version), LANDING, "pending", "commits")

    def pending(self, before: int | None = None, texts: bool = True) -> DataFrame:
        """The queue of results without a captured document, as it was before a version.

        Without ``texts`` the descriptions stay on their pages.
        """
        queue = self._read_committed(schemas.PENDING, LANDING, "pending", before, last=True)
        return self._with_texts(queue) if texts else queue

    def heads(self, responses: ResponseLog, version: int) -> DataFrame:
        """Headers of all responses in a folder; those of new files are added to the index.

        Earlier versions' files are not opened again: their headers are in the index.
        """
        names = T.StructType([T.StructField("name", T.StringType())])
        before = self._read_committed(schemas.HEADS, LANDING, "heads", version)
        # As many names as the folder has files, which listing it brings to the driver anyway.
        known = {row["name"] for row in self._read_committed(names, LANDING, "headfiles", version).collect()}
        new = [name for name in responses.files() if name not in known]
        if not new:
            return before
        added = self._write(responses.heads(new), schemas.HEADS, LANDING, "heads", version)
        self._write(self.spark.createDataFrame([(name,) for name in new], names), names, LANDING, "headfiles", version)
        for name in ("heads", "headfiles"):
            self._mark("", version, self._attempt(LANDING, version), LANDING, name, "commits")
        return before.unionByName(added)

    # -- reading -----------------------------------------------------------------

    def blobs(self, zone: str, versions: Iterable[int] | None = None) -> DataFrame:
        """Stored objects of the given versions (default: all committed ones)."""
        published = self._marked(zone, "commits")
        wanted = published if versions is None else {v: published[v] for v in versions if v in published}
        return self._read_versions(schemas.BLOBS, wanted, zone, "blobs")

    def log(self, zone: str, before: int | None = None, after: int = 0, texts: bool = True) -> DataFrame:
        """Committed log rows with ``after < version < before``; without ``texts`` as they are stored."""
        published = self._marked(zone, "commits")
        wanted = {v: a for v, a in published.items() if v > after and (before is None or v < before)}
        rows = self._read_versions(_LOG_SCHEMAS[zone], wanted, zone, "log")
        return self._with_texts(rows) if texts else rows

    def current(self, zone: str, before: int | None = None, columns: Iterable[str] | None = None,
                days: Iterable[str] | None = None, droppable: bool = False) -> DataFrame:
        """Current metadata, one row per identifier; as it was before a version if given.

        ``columns`` are those wanted besides the identifier (default: all).  Naming them
        keeps the others out of the scan and the shuffle: the optimizer cannot see
        through the newest-row aggregate.  ``days`` reads these ``partition_date`` folders
        alone: right for identifiers whose current row is known to be in them.
        ``droppable`` descriptions are not read if they are not used.
        """
        names = _LOG_SCHEMAS[zone].fieldNames()
        wanted = {"identifier", "version", "arrived", *([c for c in names if c != "text_id"] if columns is None else columns)}
        wanted = [c for c in names if c in wanted]
        if "description" not in wanted:
            return self._current(zone, before, wanted, days)
        stored = self._current(zone, before, [c for c in names if c in {*wanted, "partition_date", "text_id"}], days)
        return self._with_texts(stored, droppable).select(*wanted)

    def _current(self, zone: str, before: int | None, kept: list[str], days: Iterable[str] | None = None) -> DataFrame:
        """``current`` with descriptions as they are stored."""
        base = self._snapshot_version(zone, before)
        in_days = F.lit(True) if days is None else F.col("partition_date").isin(*days)
        applied = self.log(zone, before, base, texts=False).filter(F.col("action").isin(*APPLIED) & in_days).select(*kept)
        recent = last_per_key(applied, "identifier", ["version", "arrived"])
        if not base:
            return recent
        snapshot = self._read_snapshot(_LOG_SCHEMAS[zone], base, zone, "state").filter(in_days).select(*kept)
        return snapshot.join(recent.select("identifier"), "identifier", "left_anti").unionByName(recent)

    def blob_index(self, zone: str, before: int | None = None) -> DataFrame:
        """file_path -> (blob_version, blob_day, blob_id); the latest upload of a path wins."""
        base = self._snapshot_version(zone, before)
        uploads = self.log(zone, before, base, texts=False).filter(F.col("blob_id").isNotNull())
        ranked = uploads.select(
            "file_path", "blob_id", F.col("version").alias("blob_version"), "blob_day", "version", "arrived", "identifier"
        )
        recent = last_per_key(ranked, "file_path", ["version", "arrived", "identifier"]).select(
            "file_path", "blob_id", "blob_version", "blob_day"
        )
        if not base:
            return recent
        snapshot = self._read_snapshot(schemas.BLOB_INDEX, base, zone, "index").drop("version")
        return snapshot.join(recent.select("file_path"), "file_path", "left_anti").unionByName(recent)

    def objects(self, zone: str, keys: Iterable[str] | DataFrame | None = None) -> DataFrame:
        """Current objects by path: (file_path, content, content_type, length).

        ``keys`` are the paths wanted (default: all).  Listed paths are looked up first, and
        only the row groups that may hold them are read; paths in a DataFrame (``file_path``)
        narrow it to the day folders that they are in.  Paths without an object give no row.
        """
        index = self.blob_index(zone)
        if keys is None:
            stored = self.blobs(zone)
        elif isinstance(keys, DataFrame):
            index = index.join(keys.select("file_path").distinct(), "file_path", "left_semi")
            stored = self.blobs_of(zone, index)
        else:
            found = index.filter(F.col("file_path").isin(*set(keys))).collect()  # one row a listed path
            index = self.spark.createDataFrame(found, index.schema)
            stored = self.blobs_of(zone, index).filter(F.col("blob_id").isin(*{row["blob_id"] for row in found}))
        return index.join(stored.withColumnRenamed("version", "blob_version"), ["blob_version", "blob_id"]).select(
            "file_path", "content", "content_type", "length"
        )

    def blobs_of(self, zone: str, places: DataFrame) -> DataFrame:
        """The blob folders named by (blob_version, blob_day) rows; no other folder is read."""
        # One row for each folder, as many as listing them has.
        folders = places.select("blob_version", "blob_day").distinct().collect()
        days = {row["blob_day"] for row in folders}
        return self.blobs(zone, {row["blob_version"] for row in folders}).filter(F.col("day").isin(*days))

    def in_range(self, zone: str, start: str, end: str, before: int | None = None,
                 date_col: str = "partition_date", columns: Iterable[str] | None = None) -> DataFrame:
        """Current rows whose ``date_col`` lies in [start, end], compared as text.

        The filter follows the choice of the newest row: a later version may have moved
        an identifier to another partition.
        """
        return self.current(zone, before, columns, droppable=columns is None).filter(F.col(date_col).between(start, end))

    def create_views(self) -> None:
        """Temp views over the current state, for SQL: ``<zone>_metadata``, ``<zone>_objects``."""
        for zone in (LANDING, TRANSFORMED):
            self.current(zone).createOrReplaceTempView(f"{zone}_metadata")
            self.objects(zone).createOrReplaceTempView(f"{zone}_objects")

    # -- snapshots -----------------------------------------------------------------

    def _snapshot_version(self, zone: str, before: int | None) -> int:
        found = [v for v in self._marked(zone, "snapshot", "commits") if before is None or v < before]
        return max(found, default=0)

    def _read_snapshot(self, schema: T.StructType, version: int, zone: str, name: str) -> DataFrame:
        attempt = self._marked(zone, "snapshot", "commits")[version]
        return self._read_versions(schema, {version: attempt}, zone, "snapshot", name)

    def compact(self, zone: str, at: str) -> int:
        """Store the current state and path index as a snapshot; returns its version."""
        version = max(self.committed(zone), default=0)
        if version == 0 or version == self._snapshot_version(zone, None):
            return version
        attempt = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        folder = [f"version={version}", f"attempt={attempt}"]
        state = self._current(zone, None, _LOG_SCHEMAS[zone].fieldNames()).drop("version")
        _by_partition(state).parquet(self.path(zone, "snapshot", "state", *folder))
        written = self._read_versions(_LOG_SCHEMAS[zone], {version: attempt}, zone, "snapshot", "state")
        require_unique(written.select("identifier"))
        index = self.blob_index(zone)
        index.write.mode("overwrite").parquet(self.path(zone, "snapshot", "index", *folder))
        self._mark(at, version, attempt, zone, "snapshot", "commits")
        return version


def _by_partition(rows: DataFrame):
    """Writer for partition_date folders: AQE gathers each date and splits the large ones."""
    return rows.hint("rebalance", "partition_date").write.mode("overwrite").option(*_CODEC).partitionBy("partition_date")
