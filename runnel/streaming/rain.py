"""Rainfall as a stream: points to interval depths, and the batch stages run on each closed batch.

An extension: the batch plans stay as they are, a stream only feeds them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def interval_depths(points: DataFrame, minutes: int = 30, late: str = "10 minutes") -> DataFrame:
    """scenario_id, window and mm of gauge readings (scenario_id, ts, rainfall_mm_hr): mean intensity times duration.

    Readings later than ``late`` behind the newest one are left out; state is one row per scenario and open window.
    """
    by = F.window("ts", f"{minutes} minutes")
    return (
        points.withWatermark("ts", late).groupBy("scenario_id", by.alias("window"))
        .agg((F.avg("rainfall_mm_hr") * minutes / 60).alias("mm"), F.count(F.lit(1)).alias("readings"))
    )


def start(depths: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand each batch of closed intervals to ``run``; the checkpoint makes a restart go on where it stopped."""
    return depths.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(run).start()
