"""The transform job: landing zone to transformed zone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata import schemas
from docstrata.functions.files import mime_type, sha256_hex, transformed_name
from docstrata.operators import stats
from docstrata.operators.frontier import validate_range
from docstrata.operators.html import checked_transform
from docstrata.operators.reconcile import spread_nulls, upsert_action
from docstrata.sources.store import LANDING, TRANSFORMED, Lake

MODES = ("code", "source_hash")


@dataclass(frozen=True)
class TransformRun:
    """Parameters of one transform run.

    ``mode``: ``code`` cleans every document in range and compares the result;
    ``source_hash`` first skips documents whose landing hash was transformed already.
    A document that cannot be cleaned, or has more than ``max_bytes``, is a ``clean_error``,
    counted as failed and kept in the quarantine.
    """

    start_date: str
    end_date: str
    version: int
    run_ts: str
    date_col: str = "partition_date"
    mode: str = "code"
    max_bytes: int | None = None


@dataclass(frozen=True)
class TransformResult:
    version: int
    statuses: DataFrame

    def counts(self) -> DataFrame:
        return stats.transform_counts(self.statuses)


def transform(lake: Lake, run: TransformRun, only: DataFrame | None = None) -> TransformResult:
    """Clean the landed documents of a date range; ``only`` restricts it to some identifiers."""
    if run.mode not in MODES:
        raise ValueError(f"mode {run.mode!r} is none of {', '.join(MODES)}")
    start, end = (day.isoformat() for day in validate_range(run.start_date, run.end_date))
    before = lake.next_version(LANDING)
    columns = [c for c in schemas.LANDING_LOG.fieldNames() if c != "description"]
    landed = lake.in_range(LANDING, start, end, before, run.date_col, columns)
    if only is not None:
        landed = landed.join(only.select("identifier").distinct(), "identifier", "left_semi")

    work = lake.stage(_plan(lake, landed, run), "work", run.version)
    cleaned = _store_cleaned(lake, work, run)
    decided = lake.stage(_decide(work, cleaned, run), "transformed", run.version)
    changed = decided.filter(F.col("status").isin("inserted", "updated"))
    # The descriptions decide nothing and stay where they are: the log names their places.
    logged = changed.filter(F.col("text_id").isNotNull()).withColumn("description", F.lit(None).cast("string"))
    unnamed = changed.filter(F.col("text_id").isNull())
    if not unnamed.isEmpty():
        # Landed rows that hold their descriptions themselves, read from the days they are in.
        days = [row["partition_date"] for row in unnamed.select("partition_date").distinct().collect()]
        texts = lake.current(LANDING, before, ["description"], days).select("identifier", "description")
        logged = logged.unionByName(unnamed.join(texts, "identifier"))
    lake.write_log(logged, TRANSFORMED, run.version)
    lake.write_quarantine(_quarantined(decided), TRANSFORMED, run.version)
    lake.commit(TRANSFORMED, run.version, run.run_ts)
    return TransformResult(run.version, decided.select("identifier", "status"))


def _quarantined(decided: DataFrame) -> DataFrame:
    bad = decided.filter(F.col("status") == "clean_error")
    return bad.select("identifier", F.col("doc_url").alias("url"), "body", "partition_date", "error")


def _plan(lake: Lake, landed: DataFrame, run: TransformRun) -> DataFrame:
    """Metadata of the run with object location, earlier result and a preliminary status.

    Only narrow columns: this is where skipping happens, before any document is read.
    """
    index = lake.blob_index(LANDING).withColumnRenamed("file_path", "_path")
    prior = lake.current(TRANSFORMED, run.version, ["file_hash", "original_file_hash"]).select(
        "identifier", F.col("file_hash").alias("prior_hash"), F.col("original_file_hash").alias("prior_source"),
        F.lit(True).alias("has_prior"),
    )
    status = F.when(F.coalesce("file_path", F.lit("")) == "", "no_path").when(
        F.col("source_id").isNull(), "missing_blob"
    )
    if run.mode == "source_hash":
        status = status.when(F.col("source_hash") == F.col("prior_source"), "skipped")
    return (
        landed.drop("blob_id", "blob_day", "version")
        .withColumn("_key", spread_nulls(F.col("file_path"), "identifier"))
        .join(index, F.col("_key") == F.col("_path"), "left")
        .join(prior, "identifier", "left")
        .select(
            "identifier", "published_date", "ref_no", "doc_url", "body", "partition_date", "text_id",
            F.coalesce("file_type", F.lit("html")).alias("file_type"),
            "file_path",
            F.col("file_hash").alias("source_hash"),
            F.col("blob_id").alias("source_id"),
            F.col("blob_version").alias("source_version"),
            F.col("blob_day").alias("source_day"),
            "prior_hash", "prior_source",
            F.coalesce("has_prior", F.lit(False)).alias("has_prior"),
        )
        .withColumn("status", status)
    )


def _store_cleaned(lake: Lake, work: DataFrame, run: TransformRun) -> DataFrame:
    """Clean each needed object once and store it, unless all its records have it already."""
    # Per object: do all records using it carry one and the same earlier hash?
    needed = (
        work.filter(F.col("status").isNull())
        .groupBy("source_version", "source_day", "source_id", "file_type")
        .agg(
            F.min("partition_date").alias("day"),
            F.min("prior_hash").alias("_low"), F.max("prior_hash").alias("_high"),
            F.bool_and(F.col("prior_hash").isNotNull()).alias("_all"),
        )
    )
    places = needed.select(F.col("source_version").alias("blob_version"), F.col("source_day").alias("blob_day"))
    sources = lake.blobs_of(LANDING, places).select(
        F.col("version").alias("source_version"), F.col("blob_id").alias("source_id"), "content"
    )
    cleaned = checked_transform(F.col("content"), F.col("file_type"), run.max_bytes)
    output = sources.join(needed, ["source_version", "source_id"]).withColumn("cleaned", cleaned).withColumns(
        {"content": F.col("cleaned.value"), "error": F.col("cleaned.error")}
    )
    new_hash = sha256_hex(F.col("content"))
    unchanged = F.col("_all") & (F.col("_low") == F.col("file_hash")) & (F.col("_high") == F.col("file_hash"))
    blobs = output.withColumn("file_hash", new_hash).select(
        _blob_id().alias("blob_id"),
        "file_type",
        "file_hash",
        mime_type(F.col("file_type")).alias("content_type"),
        F.octet_length("content").cast("bigint").alias("length"),
        F.when(~F.coalesce(unchanged, F.lit(False)), F.col("content")).alias("content"),
        "error",
        "day",
    )
    return lake.write_blobs(blobs, TRANSFORMED, run.version)


def _blob_id():
    return F.concat_ws("|", "source_version", "source_id", "file_type")


def _decide(work: DataFrame, cleaned: DataFrame, run: TransformRun) -> DataFrame:
    """Final status and transformed metadata record of every row of the run."""
    done = cleaned.select("blob_id", "file_hash", "error", "day")
    todo = F.col("status").isNull()
    key = spread_nulls(F.when(todo, _blob_id()), "identifier")
    joined = work.withColumn("_blob", key).join(done, F.col("_blob") == F.col("blob_id"), "left")
    status = F.coalesce(
        "status",
        F.when(F.col("blob_id").isNull(), "missing_blob").when(F.col("error").isNotNull(), "clean_error"),
        upsert_action(F.col("has_prior"), F.col("prior_hash"), F.col("file_hash")),
    )
    changed = F.col("status").isin("inserted", "updated")
    return joined.withColumn("status", status).select(
        "identifier", "published_date", "ref_no", "doc_url", "body", "partition_date", "text_id",
        "file_type", "file_hash",
        transformed_name(F.col("identifier"), F.col("file_type")).alias("file_path"),
        F.col("file_path").alias("original_file_path"),
        F.lit(run.run_ts).alias("transformed_at"),
        F.col("source_hash").alias("original_file_hash"),
        "status", "error",
        F.when(F.col("status") == "inserted", "insert").when(F.col("status") == "updated", "update").alias("action"),
        F.when(changed, F.col("blob_id")).alias("blob_id"),
        F.when(changed, F.col("day")).alias("blob_day"),
        F.to_timestamp(F.lit(run.run_ts)).alias("arrived"),
    )
