"""Rate limits and quotas over streams: state for each key, warnings given out once.

They need the RocksDB state store (spark.sql.streaming.stateStore.providerClass) and go on
from a checkpoint where they stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LEVELS = ((1.0, "over"), (0.9, "90%"), (0.8, "80%"))


def level(used: float, limit: float) -> int:
    """0 below 80 %, then 1, 2, and 3 for more than the limit."""
    return 3 if used > limit else 2 if used >= 0.9 * limit else 1 if used >= 0.8 * limit else 0


NAMES = ("ok", "80%", "90%", "over")


class Quota(StatefulProcessor):
    """Running cost of a key; a row each time it reaches a higher level for the first time."""

    def __init__(self, limit: float, forget_ms: int | None):
        self.limit, self.forget_ms = limit, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("used", "used double, level int", self.forget_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        used, warned = self.state.get() if self.state.exists() else (0.0, 0)
        batch = pd.concat(list(rows)).sort_values(["at", "id"], kind="stable")
        out = []
        for at, i, cost in zip(batch["at"], batch["id"], batch["cost"]):
            used += float(cost)
            now = level(used, self.limit)
            if now > warned:
                out.append((key[0], at, i, used, NAMES[now]))
                warned = now
        self.state.update((used, warned))
        yield pd.DataFrame(out, columns=["key", "at", "id", "used", "level"])

    def close(self) -> None:
        pass


class Rate(StatefulProcessor):
    """How many rows of a key there are in the time up to each row, itself included."""

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["at", "id"], kind="stable")
        micros = (batch["at"].astype("datetime64[us]").astype("int64")).tolist()
        held = sorted([r[0] for r in self.recent.get()] + micros)
        width, out = self.width_ms * 1000, []
        first = past = 0
        for at, i, m in zip(batch["at"], batch["id"], micros):
            while past < len(held) and held[past] <= m:
                past += 1
            while held[first] < m - width:
                first += 1
            out.append((key[0], at, i, past - first))
        left = [(m,) for m in held if m >= held[-1] - width]
        self.recent.put(left)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(held[-1] // 1000 + self.width_ms + 1)
        yield pd.DataFrame(out, columns=["key", "at", "id", "in_window"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Nothing of the key is within the time any more."""
        self.recent.clear()
        return iter([])

    def close(self) -> None:
        pass


def quota_warnings(stream: DataFrame, key: str, at: str, row: str, cost, limit: float, forget_ms: int | None = None) -> DataFrame:
    """(key, at, id, used, level): for each key the rows at which its running cost first reaches
    80 %, 90 % or more than the limit. Rows count in the order of `at` and id within a
    micro-batch, and batch by batch; a row with a higher level stands for those it skips.
    State is a number and a level a key; forget_ms: a key's count ends after so long without
    a row. Null keys are a key."""
    d = stream.select(F.col(key).alias("key"), F.col(at).cast("timestamp").alias("at"), F.col(row).alias("id"), cost.cast("double").alias("cost"))
    kinds = {f.name: f.dataType.simpleString() for f in d.schema}
    return d.groupBy("key").transformWithStateInPandas(Quota(limit, forget_ms), f"key {kinds['key']}, at {kinds['at']}, id {kinds['id']}, used double, level string", "Append", "none" if forget_ms is None else "processingTime")


def rate_counts(stream: DataFrame, key: str, at: str, row: str, width_ms: int, late: str = "10 minutes") -> DataFrame:
    """(key, at, id, in_window): for each row how many rows of its key there are from width_ms
    before it up to it, rows at the same time included, as far as they have come by then.
    State is the times within the width; a timer lets them go."""
    d = stream.select(F.col(key).alias("key"), F.col(at).cast("timestamp").alias("at"), F.col(row).alias("id")).withWatermark("at", late)
    kinds = {f.name: f.dataType.simpleString() for f in d.schema}
    return d.groupBy("key").transformWithStateInPandas(Rate(width_ms), f"key {kinds['key']}, at {kinds['at']}, id {kinds['id']}, in_window long", "Append", "eventTime")
