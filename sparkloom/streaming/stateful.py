"""State that a stream keeps itself: aggregates in the state store, and keys that fall due after a while.

A query started again on its checkpoint goes on from its state; a batch that is
repeated after a failure writes the same again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sparkloom.sources.keyed import KeyedTable

#: The state store that keeps state outside the heap and has timers.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

DUE = "key string, last_ms bigint, due_ms bigint"


def keep_aggregate(aggregated: DataFrame, table: KeyedTable, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Keep ``table`` at the values of an aggregate over a stream.

    ``aggregated`` is a streaming ``groupBy`` whose result has the table's key
    and cells.  Spark holds the partial aggregates; a batch hands on the keys
    that it changed, and the table writes the buckets that these fall in, under
    the batch's number, once.  Without ``interval`` all that is there is taken
    and the query ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        table.upsert(batch, number + 1, f"batch-{number}")

    writer = aggregated.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def keep_rows(rows: DataFrame, table: KeyedTable, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Upsert every batch of a stream of rows into ``table``, under the batch's number, once."""

    def write(batch: DataFrame, number: int) -> None:
        table.upsert(batch, number + 1, f"batch-{number}")

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


class _Due(StatefulProcessor):
    """The last visit of a key; a timer at its end of rest, moved by each later visit."""

    def __init__(self, interval_ms: int):
        self.interval = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "time_ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.last.get()
        old = held[0] if held else None
        new = max([int(r["time_ms"].max()) for r in rows] + ([old] if old is not None else []))
        if new != old:
            if old is not None:
                self.handle.deleteTimer(old + self.interval)
            self.last.update((new,))
            self.handle.registerTimer(new + self.interval)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0]
        self.last.clear()
        yield pd.DataFrame({"key": [str(key[0])], "last_ms": [last], "due_ms": [last + self.interval]})

    def close(self) -> None:
        pass


def due(stream: DataFrame, key: str, time: str, interval_ms: int, late: str = "0 seconds") -> DataFrame:
    """(key, last_ms, due_ms): a row when a key has rested ``interval_ms`` since its last visit.

    ``time`` is a timestamp and the stream's clock: a key falls due when visits
    of others, less ``late``, are that far ahead; a visit moves the end of its
    rest.  A key that comes again later rests anew.  The session's state store
    must be ``STORE`` when the query starts (``start_due`` sees to it).
    """
    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(time).alias("at")).where("key IS NOT NULL AND at IS NOT NULL").withWatermark("at", late)
    rows = rows.withColumn("time_ms", F.unix_millis("at"))
    return rows.groupBy("key").transformWithStateInPandas(_Due(interval_ms), DUE, "Append", "EventTime")


def start_due(stream: DataFrame, key: str, time: str, interval_ms: int, target: str, checkpoint: str, interval: str | None = None, late: str = "0 seconds") -> StreamingQuery:
    """Append what falls ``due`` to ``target``; without ``interval`` for all that is there, then the query ends."""
    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER)
    conf.set(_PROVIDER, STORE)
    try:
        writer = due(stream, key, time, interval_ms, late).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
    finally:
        conf.set(_PROVIDER, before)
