"""When each key was last seen, and whether that is too long ago, kept by a stateful processor with timers.

A key's state is its newest time. Each newer row moves its timer to that time plus ``span``; when the watermark has passed the timer, the key
turns stale, and a row that is newer than what is known makes it fresh again. Work and output follow the keys that
change: a key that is neither seen nor due costs nothing in a batch.

Cases: rows without a key or a time are left out; repeated and older rows change nothing; rows later than the watermark are dropped, as
any later state would be; an empty stream has no changes.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vacantia.storage import importable

#: The state store that timers need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class LastSeen(StatefulProcessor):
    """Gives a row (key, last_seen in ms, is_stale) for each change of a key."""

    def __init__(self, span_ms: int):
        self.span = span_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "ms long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        ms = max(row.ms for row in rows)
        known = self.newest.get()  # each call of the state is a message
        known = known[0] if known else None
        if known is not None and ms <= known:
            return
        if known is not None:
            self.handle.deleteTimer(known + self.span)
        self.newest.update((ms,))
        late = ms + self.span < timerValues.getCurrentWatermarkInMs()
        if not late:
            self.handle.registerTimer(ms + self.span)
        yield Row(key=key[0], ms=ms, is_stale=late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield Row(key=key[0], ms=self.newest.get()[0], is_stale=True)

    def close(self) -> None:
        pass


def last_seen_changes(stream: DataFrame, key: str, ts: str, span_ms: int, late: str) -> DataFrame:
    """(key, ms, is_stale): the changes of keys of a stream, for a query started with the state store of ``STORE``."""
    importable(stream.sparkSession)
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, late)
    rows = rows.select(F.col(key).alias("key"), F.unix_millis(ts).alias("ms"), ts)
    return rows.groupBy("key").transformWithState(LastSeen(span_ms), f"key {kind}, ms long, is_stale boolean", "Update", "EventTime")
