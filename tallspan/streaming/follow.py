"""Following a cell table as a stream: each micro-batch is an incremental load up to its newest cell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..catalog import SourceSpec, TargetSpec
from ..plans.engine import delete_rows, incremental, plan_of
from ..sources.sinks import Sink


def follow(stream: DataFrame, stored: Callable[[], DataFrame], spec: SourceSpec, text: str, target: TargetSpec, sink: Sink, checkpoint: str) -> StreamingQuery:
    """stream: new cells as they arrive; stored(): all cells. Each batch deletes and re-inserts what it touched.

    Deletes come first, so a batch that is run again after a failure leaves the same target.
    """
    plan = plan_of(spec, text, target)

    def batch(cells: DataFrame, _: int) -> None:
        ends = cells.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
        if ends["low"] is not None:
            found, rows = incremental(stored(), plan, target, ends["low"], ends["high"] + 1)
            sink.delete(*delete_rows(found, plan))
            sink.write(rows)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
