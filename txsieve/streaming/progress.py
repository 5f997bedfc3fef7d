"""Live metrics from the progress reports of a streaming query."""

from __future__ import annotations

import json
from collections.abc import Mapping


def messages_behind(progress: Mapping) -> int:
    """Messages between the offsets read and the newest ones, over all sources.

    Works on Kafka-style offsets ``{topic: {partition: offset}}``; sources that
    report no such offsets count as up to date.
    """
    behind = 0
    for source in progress["sources"]:
        read, newest = (_partitions(source.get(key)) for key in ("endOffset", "latestOffset"))
        behind += sum(max(0, offset - read.get(part, 0)) for part, offset in newest.items())
    return behind


def _partitions(offsets: object) -> dict[tuple[str, str], int]:
    if isinstance(offsets, str):
        offsets = json.loads(offsets)
    if not isinstance(offsets, Mapping):
        return {}
    return {
        (topic, part): int(offset)
        for topic, parts in offsets.items()
        if isinstance(parts, Mapping)
        for part, offset in parts.items()
    }


def rows_dropped_late(progress: Mapping) -> int:
    """Rows that arrived below the watermark and were left out of the statistics."""
    return sum(state["numRowsDroppedByWatermark"] for state in progress["stateOperators"])


def processing_seconds(progress: Mapping) -> float:
    """Wall time of the batch, an observation for the latency histogram."""
    return progress["durationMs"]["triggerExecution"] / 1000
