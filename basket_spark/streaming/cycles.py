"""Purchase cycles as a stream: the last two purchases of each customer as state that expires."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..plans.cards import NO_CYCLE

_DAY = 86_400_000
#: So many neighbouring keys share a state: it is fetched, written and timed once for all of them in a batch.
RANGE_BITS = 6
#: Times are milliseconds since 1970 here; one place of the arrays for each key of the range.
_STATE = "key array<long>, last array<long>, last_id array<long>, before array<long>, before_id array<long>"


class LastTwo(StatefulProcessor):
    """Keeps the last two purchases by time and id of each key of a range; says them whenever they change, and forgets a key
    when the watermark is ``days`` past its last one."""

    def __init__(self, days: int) -> None:
        self.span = days * _DAY

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.two = handle.getValueState("two", _STATE)

    def _known(self) -> dict[int, tuple]:
        return {k: ((last, last_id), None if before is None else (before, before_id)) for k, last, last_id, before, before_id in zip(*(self.two.get() or [()] * 5), strict=True)}

    def _first(self, known: dict[int, tuple]) -> int | None:
        """When the first of the keys is to be forgotten."""
        return min((last[0] for last, _ in known.values()), default=None)

    def _keep(self, known: dict[int, tuple]) -> None:
        rows = [(k, *last, *(before or (None, None))) for k, (last, before) in known.items()]
        self.two.update(tuple(list(c) for c in zip(*rows, strict=True)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: ANN001, N802, N803
        known, changed = self._known(), set()
        old = self._first(known)
        for r in rows:
            k, new = r["key"], (r["at"], r["id"])
            last, before = known.get(k, (None, None))
            # Repeated ids are one purchase; the two last of all are those of the two known and what came.
            if new in (last, before) or (before is not None and new < before):
                continue
            known[k] = (new, last) if last is None or new > last else (last, new)
            changed.add(k)
        if changed:
            self._keep(known)
            if (first := self._first(known)) != old:
                if old is not None:
                    self.handle.deleteTimer(old + self.span)
                self.handle.registerTimer(first + self.span)
        for k in changed:
            last, before = known[k]
            yield Row(key=k, last=last[0], before=before and before[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: ANN001, N802, N803
        now = timerValues.getCurrentWatermarkInMs()
        left = {k: two for k, two in self._known().items() if two[0][0] + self.span >= now}
        if left:
            self._keep(left)
            self.handle.registerTimer(self._first(left) + self.span)
        else:
            self.two.clear()
        return iter(())

    def close(self) -> None:
        pass


def write_last_two(purchases: DataFrame, key: str, time: str, order: str, path: str, checkpoint: str, delay: str = "40 days", days: int = 800) -> StreamingQuery:
    """The last two purchases of each key as they change, to a folder for each batch under ``path``; works off what is there.

    ``purchases`` is a stream with the columns ``key`` (long), ``time`` (timestamp) and ``order`` (long, decides between
    purchases of one time). Purchases that are later than ``delay`` don't count; keys without one for ``days`` after their
    last are forgotten, so state is bounded by the keys that are seen within that time. Needs the RocksDB state store.
    Neighbouring keys share a state, so keys should be numbers given in order; any others only make the states smaller.
    """
    rows = purchases.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(F.shiftright(F.col(key), RANGE_BITS).alias("range"), F.col(key).alias("key"), F.col(time).alias("ts"), F.unix_millis(F.col(time)).alias("at"), F.col(order).alias("id")).withWatermark("ts", delay)
    changed = rows.groupBy("range").transformWithState(LastTwo(days), "key long, last long, before long", "Update", "EventTime")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number:09d}")

    return changed.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def cycles(spark: SparkSession, path: str, start: str) -> DataFrame:
    """(customer_key, cycle) from what ``write_last_two`` wrote: days between the last two, if the last is on ``start`` or
    later, else ``NO_CYCLE``. The last batch that names a key is the one that counts."""
    said = spark.read.schema("key long, last long, before long, batch long").parquet(path).withColumns({c: F.timestamp_millis(c) for c in ("last", "before")})
    newest = said.groupBy("key").agg(F.max_by(F.struct("last", "before"), "batch").alias("l"))
    days = F.datediff("l.last", "l.before")
    return newest.select(F.col("key").alias("customer_key"), F.coalesce(F.when(F.col("l.last") >= F.lit(start).cast("timestamp"), days), F.lit(NO_CYCLE)).alias("cycle"))
