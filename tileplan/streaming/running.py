"""How a continuous job is started."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tileplan.session import scratch


def start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None):
    """Run ``work`` on every micro-batch: all that is there and then stop, or, with ``every``, for good.

    Folders that the work has written for itself are removed when a micro-batch ends.
    """
    def batch(rows: DataFrame, n: int) -> None:
        with scratch(rows.sparkSession):
            work(rows, n)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
