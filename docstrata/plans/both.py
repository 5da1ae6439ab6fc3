"""Landing followed by transform, the second only after the first has committed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from docstrata.plans.landing import LandingResult, LandingRun, land
from docstrata.plans.transform import TransformResult, TransformRun, transform
from docstrata.sources.store import TRANSFORMED, Lake


@dataclass(frozen=True)
class Results:
    landing: LandingResult
    transform: TransformResult


def land_and_transform(
    lake: Lake, search_pages: DataFrame, responses: DataFrame, run: LandingRun, mode: str = "code"
) -> Results:
    """Run both jobs for one date range."""
    landed = land(lake, search_pages, responses, run)
    after = TransformRun(
        run.start_date, run.end_date, lake.next_version(TRANSFORMED), run.run_ts, mode=mode
    )
    return Results(landed, transform(lake, after))
