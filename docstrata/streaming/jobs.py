"""Structured Streaming forms of the jobs.

State lives in the zone tables, not in the stream: a watermark would forget identifiers.
Each micro-batch calls the batch job with a version derived from its batch id, so a batch
that is delivered again rewrites its own version and changes nothing.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docstrata.plans.landing import LandingRun, land
from docstrata.plans.transform import TransformRun, transform
from docstrata.sources.captures import ResponseLog
from docstrata.sources.store import APPLIED, LANDING, TRANSFORMED, Lake


def stream_landing(
    lake: Lake, pages: DataFrame, responses: DataFrame | ResponseLog, run: LandingRun, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Land arriving result pages; ``run.version`` is the version of the first batch.

    Results whose document is not there yet wait in the lake's queue and are taken up again
    by every later batch.  A ``ResponseLog`` is read anew in each batch, and responses that
    are added to it start a batch as pages do; a DataFrame shows the responses that it listed
    when it was made, and no others.

    Stops after what is there, or keeps going with a batch ``every`` interval.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        captured = batch.filter(F.col("url").isNotNull())
        land(lake, captured, responses, replace(run, version=run.version + batch_id, keep_pending=True))

    arriving = pages
    if isinstance(responses, ResponseLog):
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in pages.schema]
        arriving = pages.unionByName(responses.arrivals().select(*nothing))
    return (
        arriving.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def _trigger(every: str | None) -> dict[str, str | bool]:
    return {"processingTime": every} if every else {"availableNow": True}


def stream_transform(lake: Lake, run: TransformRun, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Transform what newly committed landing versions changed.

    The stream follows the commit markers, which are written last: a version is seen only
    when all of its rows are readable.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        versions = [r.version for r in batch.select("version").distinct().collect()]
        changed = lake.log(LANDING, texts=False).filter(F.col("version").isin(versions) & F.col("action").isin(*APPLIED))
        transform(lake, replace(run, version=run.version + batch_id), only=changed)

    return (
        lake.commit_stream(LANDING)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )
