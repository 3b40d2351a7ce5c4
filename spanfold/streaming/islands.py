"""Islands of a stream of assignment rows.

An island is emitted once the watermark has passed its end. Runs and absorption
need a household's whole period, so they stay batch jobs over emitted islands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from spanfold.operators.islands import session_islands, with_event_time
from spanfold.sources.rows import spans


def stream_islands(rows: DataFrame, lateness: str) -> DataFrame:
    """``rows`` is a streaming frame; rows later than ``lateness`` are dropped."""
    return session_islands(with_event_time(spans(rows)).withWatermark("at", lateness))
