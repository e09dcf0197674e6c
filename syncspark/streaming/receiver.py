"""The receiving side of a numbered topic: each record once, and which are lost.

Senders number their records and send the number along, so both sides count
the same records. A record that arrives again is dropped; a number that does not
arrive counts as lost only when the records behind it are older than a set
time, so records on their way are not asked for again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from syncspark.functions.messages import accepted, decode
from syncspark.operators.sequence import SEQ

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def received_once(
    stream: DataFrame, schema: T.StructType, time: str, delay: str, number: str = SEQ, sender: str | None = None
) -> DataFrame:
    """Accepted messages of a topic, the first arrival of each number.

    ``schema`` declares the fields, of them ``number`` required and ``time`` a
    timestamp. Repeats are dropped as long as they come within ``delay`` of each
    other; numbers older than that leave the state. With ``sender``, a
    field, each sender has numbers of its own.
    """
    required = [number, time] if sender is None else [number, time, sender]
    messages = accepted(decode(stream, schema, required))
    keys = [number] if sender is None else [sender, number]
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def _gaps_processor() -> StatefulProcessor:
    """The processor travels to the workers as a whole, so they need no package."""

    class Gaps(StatefulProcessor):
        """State of a sender: its greatest number, and the ranges missing below it with the time of the record behind each.

        Ranges are rows ``first, last, seen`` in order, packed by blocks of 65,536 numbers. A sender has one
        timer, for the range that is due first.
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.greatest = handle.getValueState("greatest", "n bigint")
            self.due = handle.getValueState("due", "millis bigint")
            self.gaps = handle.getMapState("gaps", "block bigint", "ranges binary")

        def _held(self) -> tuple[dict[int, bytes], np.ndarray]:
            """Blocks as they are kept, and the ranges of all of them."""
            blocks = {block[0]: bytes(packed[0]) for block, packed in self.gaps.iterator()}
            return blocks, np.frombuffer(b"".join(blocks[b] for b in sorted(blocks)), np.int64).reshape(-1, 3)

        def _keep(self, before: dict[int, bytes], ranges: np.ndarray) -> None:
            """Replace the blocks that changed, and set the timer to the range that is due first."""
            block = ranges[:, 0] >> 16
            cuts = np.flatnonzero(np.diff(block, prepend=-1))
            after = {int(block[a]): ranges[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(ranges)])}
            for number in before.keys() - after.keys():
                self.gaps.removeKey((number,))
            for number, packed in after.items():
                if before.get(number) != packed:
                    self.gaps.updateValue((number,), (packed,))
            due = self.due.get()[0] if self.due.exists() else None
            first_due = int(ranges[:, 2].min()) if len(ranges) else None
            if due == first_due:
                return
            if due is not None:
                self.handle.deleteTimer(due)
            if first_due is None:
                self.due.clear()
            else:
                self.due.update((first_due,))
                self.handle.registerTimer(first_due)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            pairs = np.fromiter((x for row in rows for x in (row["_number"], row["_millis"])), np.int64).reshape(-1, 2)
            pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
            numbers, earliest = np.unique(pairs[:, 0], return_index=True)
            times = pairs[earliest, 1]
            greatest = self.greatest.get()[0] if self.greatest.exists() else 0
            before, ranges = self._held()
            new = int(np.searchsorted(numbers, greatest, "right"))
            late = numbers[:new]
            if len(late) and len(ranges):
                # Late ones part their ranges: each ends one piece and begins another, which may be empty.
                at = np.searchsorted(ranges[:, 0], late, "right") - 1
                late = late[(at >= 0) & (ranges[at, 1] >= late)]
                firsts = np.sort(np.concatenate([ranges[:, 0], late + 1]))
                lasts = np.sort(np.concatenate([ranges[:, 1], late - 1]))
                seen = ranges[np.searchsorted(ranges[:, 0], firsts, "right") - 1, 2]
                ranges = np.stack([firsts, lasts, seen], 1)[firsts <= lasts]
            if new < len(numbers):
                below = np.concatenate([[greatest], numbers[new:-1]])
                missing = np.stack([below + 1, numbers[new:] - 1, times[new:]], 1)
                ranges = np.concatenate([ranges, missing[missing[:, 0] <= missing[:, 1]]])
                greatest = int(numbers[-1])
            self._keep(before, ranges)
            self.greatest.update((greatest,))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            # All ranges that the stream's time has passed go at once.
            now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
            before, ranges = self._held()
            over = ranges[:, 2] <= now
            self._keep(before, ranges[~over])
            for first, last in ranges[over, :2].tolist():
                yield Row(_key=key[0], first=first, last=last)

        def close(self) -> None:
            pass

    return Gaps()


def lost_ranges(stream: DataFrame, sender: str, number: str, time: str, delay: str) -> DataFrame:
    """Ranges of numbers of each sender that are lost: ``sender, first, last``, each reported once.

    Numbers begin at 1. A range is missing from the moment a higher number
    arrives, and lost when the stream's time is ``delay`` past that record;
    numbers that arrive until then leave the range. State holds the missing ranges
    and one number for each sender. Needs the state store of :func:`range_state`.
    """
    kind = stream.schema[sender].dataType
    out = T.StructType([T.StructField("_key", kind), T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
    numbered = stream.select(
        F.col(sender).alias("_key"),
        F.col(number).cast("long").alias("_number"),
        F.col(time).alias("_time"),
        F.unix_millis(time).alias("_millis"),
    )
    watched = numbered.filter("_number IS NOT NULL").withWatermark("_time", delay).groupBy("_key")
    found = watched.transformWithState(statefulProcessor=_gaps_processor(), outputStructType=out, outputMode="Append", timeMode="EventTime")
    return found.withColumnRenamed("_key", sender)


@contextmanager
def range_state(spark: SparkSession) -> Iterator[None]:
    """The state store that processors with timers need, for streams started inside the block."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)
