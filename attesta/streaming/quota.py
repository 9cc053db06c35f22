"""The job queue as Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def quota_stream(jobs: DataFrame, who: str, hours: int = 24, late: int = 24) -> DataFrame:
    """jobs (event_id, us, who; a stream) -> event_id, who, before: jobs of the same client in the hours before, among all
    that have come. The watermark is `late` hours behind the newest event: an event less late is counted exactly at its
    own time and does not change counts already given, a later one is dropped. A client's state is the sorted times of
    hours + late, and goes when the watermark has passed them."""
    span, keep = hours * 3600 * 1_000_000, (hours + late) * 3600 * 1_000_000

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        new = pd.concat(list(batches))
        times = np.sort(np.concatenate([np.array(state.get[0] if state.exists else [], np.int64), new["us"].to_numpy(np.int64)]))
        at = new["us"].to_numpy(np.int64)
        before = np.searchsorted(times, at, "right") - np.searchsorted(times, at - span, "right") - 1
        state.update((times[times > times[-1] - keep].tolist(),))
        state.setTimeoutTimestamp(int(times[-1] + keep) // 1000)
        yield pd.DataFrame({"event_id": new["event_id"].to_numpy(), who: key[0], "before": before})

    timed = jobs.withColumn("_at", F.timestamp_micros("us")).withWatermark("_at", f"{late} hours")
    return timed.groupBy(who).applyInPandasWithState(step, f"event_id long, {who} long, before long", "recent array<long>", "append", GroupStateTimeout.EventTimeTimeout)
