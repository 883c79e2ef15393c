"""Micro-batches through the batch engine: each adds what the store still lacks, so replays are harmless."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..run import Outcome, update


def stream_updates(rows: DataFrame, source: str, mapping: str, config: Config, checkpoint: str, seen: Callable[[int, Outcome], None] | None = None) -> StreamingQuery:
    """Run ``mapping`` on every micro-batch of ``rows``, which stands in for the logical source (path or table) ``source``."""

    def batch(df: DataFrame, number: int) -> None:
        outcome = update(df.sparkSession, mapping, config, {source: df})
        if seen:
            seen(number, outcome)

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
