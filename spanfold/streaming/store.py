"""A stream of assignment rows into a stored summary.

Each micro-batch is an increment of a ``SummaryStore``, under its number and the name of the
stream. A batch that Spark replays after a failure was either published, and is left out, or was
not, and is folded in whole: its rows count once either way. Nothing waits for a watermark,
and rows may be as late as they like: an increment merges with what is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from spanfold.operators.hot import Hot, Limits
from spanfold.plans.increments import SummaryStore
from spanfold.plans.summary import LIMITS


def stream_into(
    rows: DataFrame, store: SummaryStore, checkpoint: str, name: str = "rows",
    hot: Limits | Hot = LIMITS, **trigger: object,
) -> StreamingQuery:
    """Start the stream. ``trigger`` as for ``DataStreamWriter.trigger``; by default it takes what
    is there and ends."""

    def add(batch: DataFrame, number: int) -> None:
        store.add(batch, hot, source=name, batch=number)

    writer = rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
