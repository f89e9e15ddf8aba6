"""Duplicate suppression with keyed state, and a side output in place of dropping.

Change ids are numbers of a sequence, so state is one bit per event: a block of 1024
consecutive ids of a table is a bitmap with the newest capture time in it. A block is
kept until the stream's newest capture time is ``within`` ahead of that. An event that is
not that late meets the state of its first delivery, if there was one, so the bit
decides. Of a later event a set bit still tells that it is a repetition; an unset one may
have been forgotten, so the event goes to the side output, and ``store_deduped`` compares
it with the stored log. Nothing is dropped, and state doesn't grow with the stream's age.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from chronomart.functions.times import parse_ts
from chronomart.operators.envelope import FIELDS, dedupe, image, with_capture_date
from chronomart.sources.changelog import PARTITIONS
from chronomart.sources.scratch import cut_lineage
from chronomart.streaming.ingest import EVERY, not_held, undated, write_batch

BITS = 10
BLOCK = 1 << BITS
LATE = "late"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_TEXT = T.StringType()
ROWS = T.StructType([
    T.StructField("table", _TEXT), T.StructField("operation", _TEXT), T.StructField("before", _TEXT), T.StructField("after", _TEXT),
    T.StructField("captured_at", _TEXT), T.StructField("change_id", T.LongType()), T.StructField(LATE, T.BooleanType()),
])
STATE = T.StructType([T.StructField("seen", T.BinaryType()), T.StructField("newest", T.LongType())])


class Blocks(StatefulProcessor):
    """One block of ids of one table."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("block", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held = self.state.get() if self.state.exists() else None
        seen = np.zeros(BLOCK, bool) if held is None else np.unpackbits(np.frombuffer(held[0], np.uint8)).astype(bool)
        newest = -1 if held is None else held[1]
        for batch in rows:
            place = (batch["change_id"] % BLOCK).to_numpy(np.int64)
            moment = batch["ms"].fillna(-1).to_numpy(np.int64)
            late = moment < max(watermark, 0)
            # A repetition inside the batch counts against the first on-time delivery.
            fresh = np.zeros(len(batch), bool)
            on_time = np.flatnonzero(~late)
            first = on_time[np.unique(place[on_time], return_index=True)[1]]
            fresh[first[~seen[place[first]]]] = True
            seen[place[on_time]] = True
            newest = max(newest, int(moment[on_time].max(initial=-1)))
            undecided = late & ~seen[place]
            yield batch.assign(**{LATE: late})[fresh | undecided][ROWS.names]
        if newest >= 0:
            if held is None:
                self.handle.registerTimer(newest + 1)
            self.state.update((np.packbits(seen).tobytes(), newest))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        newest = self.state.get()[1] if self.state.exists() else -1
        if newest >= timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(newest + 1)
        else:
            self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def dedupe_keyed(log: DataFrame, within: str) -> DataFrame:
    """First deliveries of a stream of envelope rows, with ``late``: true where only the stored log can tell.

    Events without a change id cannot be told apart and pass as they are. Events without
    a readable capture time count as late. The query needs the RocksDB state store;
    ``start_deduped`` sets it.
    """
    moment = parse_ts(F.col("captured_at")).cast("timestamp")
    timed = log.select(*FIELDS, moment.alias("_at")).withWatermark("_at", within)
    # The state gets the time as a plain number: Spark removes late rows by a column that it knows as event time.
    texts = [F.to_json(c).alias(c) if c in ("before", "after") else F.col(c) for c in FIELDS]
    block = F.shiftright("change_id", BITS).alias("block")
    rows = timed.filter(F.col("change_id").isNotNull()).select(*texts, F.unix_millis("_at").alias("ms"), block)
    found = rows.groupBy("table", "block").transformWithStateInPandas(
        statefulProcessor=Blocks(), outputStructType=ROWS, outputMode="Append", timeMode="EventTime"
    )
    found = found.select(*[image(F.col(c)).alias(c) if c in ("before", "after") else F.col(c) for c in FIELDS], LATE)
    return found.unionByName(timed.filter(F.col("change_id").isNull()).select(*FIELDS, F.lit(False).alias(LATE)))


def store_deduped(bronze: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: on-time rows are appended as they are, late ones after a comparison with the stored log."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = cut_lineage(with_capture_date(batch, undated()))
        late = dedupe(rows.filter(LATE).drop(LATE))
        fresh = not_held(late, bronze, batch_id).unionByName(rows.filter(~F.col(LATE)).drop(LATE))
        write_batch(fresh, bronze, batch_id, *PARTITIONS)

    return run


def start_deduped(log: DataFrame, within: str, bronze: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """``log`` to ``bronze``, every event once, however late."""
    conf = log.sparkSession.conf
    before = conf.get(PROVIDER)
    conf.set(PROVIDER, ROCKSDB)
    try:
        query = dedupe_keyed(log, within).writeStream.option("checkpointLocation", checkpoint).foreachBatch(store_deduped(bronze))
        return query.trigger(**(trigger or EVERY)).start()
    finally:
        conf.set(PROVIDER, before)
