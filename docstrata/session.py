"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package.  Shuffle partition numbers are
# left to the cluster: AQE coalesces them, so a generous value is safe.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Split hot join keys even if that costs an extra exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Batches sent to the HTML stage are bounded by bytes, so a few very large
    # documents cannot blow up a Python worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # partition_date must stay a string when partition folders are discovered.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app_name: str = "docstrata", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session carrying ``SETTINGS``; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of the machine,
    because there the driver and the executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="docstrata-")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per context.

    The HTML stages import it on the executors; a cluster that installs the package or
    lists it in spark.submit.pyFiles does not need this.
    """
    context = spark.sparkContext
    if getattr(context, "_docstrata_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="docstrata-pkg-")) / "docstrata"), "zip", package.parent, package.name
    )
    context.addPyFile(archive)
    context._docstrata_shipped = True
