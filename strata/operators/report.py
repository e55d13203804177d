"""Text report of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import fmt
from strata.model import LAYERS
from strata.operators import runs
from strata.operators.lineage import side_by_side

# Wording of the report.
TITLE = "PIPELINE EXECUTION REPORT\n=========================\n"
NO_METRICS = " - Status: No metrics found (Job may have failed or skipped)\n"


def render(metrics: DataFrame, at: str | None = None) -> DataFrame:
    """One text per run as ``(run_id, report)``: a header, then a block per layer.

    The lines of a record are joined within its row; a run then gathers three
    texts, so no task holds more than the records it is given.
    """
    date = F.date_format(F.current_timestamp(), fmt.RECORD_PATTERN) if at is None else F.lit(at)
    lines = F.transform(
        runs.entries(metrics), lambda row: F.concat(F.lit(" - "), row["key"], F.lit(": "), row["value"], F.lit("\n"))
    )
    wide = side_by_side(metrics, [F.array_join(lines, "").alias("text")])
    blocks = []
    for layer in LAYERS:
        text = F.coalesce(F.col(layer.lower())["text"], F.lit(NO_METRICS))
        blocks.append(F.concat(F.lit(f"[{layer.upper()} LAYER]\n"), text, F.lit("\n")))
    header = F.concat(F.lit(TITLE + "Run ID: "), F.col("run_id"), F.lit("\nDate:   "), date, F.lit("\n\n"))
    return wide.select("run_id", F.concat(header, *blocks).alias("report"))
