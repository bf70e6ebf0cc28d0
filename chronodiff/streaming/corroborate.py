"""The dispatch of changes as a stream: state per key, dropped when its last candidate has expired."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chronodiff.operators.corroborate import GROUP, HOUR, OUT, clean, dump, load, rows_in, step
from chronodiff.operators.events import ATTACH_HOURS


def dispatch_stream(changes: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The rows of :func:`chronodiff.operators.corroborate.dispatch` for a streaming input with a column observed_at.

    The changes of a key in one micro-batch are taken in order of time; one that comes in a later batch than a younger
    one sees the candidates that are open at its own time. The watermark only bounds the state.
    """

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        opened = load(state.get[0]) if state.exists else []
        rows = pd.concat(list(parts)).sort_values(["at", "id", "source_id"])
        out = []
        for r in map(clean, rows.to_dict("records")):
            action, candidate = step(opened, r)
            out.append((r["id"], action, candidate, r["source_id"], r["at"]))
        state.update((dump(opened),))
        end = max((o.at for o in opened), default=0) + ATTACH_HOURS * HOUR
        state.setTimeoutTimestamp(max(end // 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["id", "action", "candidate", "source_id", "at"])

    rows = rows_in(changes.withWatermark("observed_at", delay), "observed_at")
    return rows.groupBy(*GROUP).applyInPandasWithState(run, OUT, "opened string", "append", GroupStateTimeout.EventTimeTimeout)
