"""First-seen access with a state that does not grow for ever.

The state store keeps, for each (principal, connector) pair that history does not know, the place of its earliest access,
and a timer. When the timer fires the pair moves to the history table and its state goes, so the store holds
the pairs of one span of time. Later accesses of the pair meet history instead. Findings and history are
committed together, so no batch can see a pair in neither or in both.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wardline.operators.access import PAIR, first_accesses
from wardline.session import scratch_path
from wardline.streaming import commits

# timers need this state store; and as a timer may run out at any time, a run over what is there now would go on with
# batches without data for ever
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
FOUND, HISTORY = "found", "history"
_EXPIRED = "_expired"


def _ordered(values: Iterable) -> tuple:
    """Values as a key to sort by; what is missing comes last."""
    return tuple((value is None, value) for value in values)


class EarliestAccess(StatefulProcessor):
    """Reports a pair when it is first met and when an earlier access turns up; later, that it expired."""

    def __init__(self, state: T.StructType, names: Sequence[str], keep_ms: int):
        self._schema, self._names, self._keep = state, list(names), keep_ms
        self._out = Row(*names, _EXPIRED)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._first = handle.getValueState("first", self._schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = min(rows, key=self._place)
        known = self._first.get()
        if known is None:
            self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self._keep)
        if known is None or self._place(best) < _ordered(known):
            self._first.update(tuple(best[n] for n in self._schema.names))
            yield self._out(*(best[n] for n in self._names), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._first.clear()
        pair = dict(zip(PAIR, key))
        yield self._out(*(pair.get(n) for n in self._names), True)

    def _place(self, row: Row) -> tuple:
        return _ordered(row[n] for n in self._schema.names)

    def close(self) -> None:
        pass


@contextmanager
def timer_settings(spark: SparkSession):
    """``SETTINGS`` for queries that start inside."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def first_seen(spark: SparkSession, accesses: DataFrame, history: DataFrame, *, keep: dt.timedelta,
               base: str | None = None, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Each pair's earliest access, of the pairs history does not know; as ``streams.first_seen``, in bounded state.

    A pair stays in the state for ``keep`` after it is first met (by the clock of the run, so that no access counts as late),
    then, with the next batch, goes to the history of ``base``. While it is there an earlier access replaces the one reported; afterwards
    its accesses are known ones. A pair without a principal or a connector is one of its own.
    """
    base = base or scratch_path(spark, "first-seen-expiring")
    columns = accesses.columns
    schema = accesses.select(*columns).schema
    pairs = T.StructType([T.StructField(n, T.StringType()) for n in PAIR])
    given = history.select(*PAIR).distinct()
    given.write.mode("ignore").parquet(f"{base}/given")
    known = spark.read.schema(given.schema).parquet(f"{base}/given")
    commits.begin(spark, base, {FOUND: schema, HISTORY: pairs})

    # what has the earliest place travels as text, so that Python gives back what it got
    clocks = [f.name for f in schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    flat = accesses.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS") for n in clocks})
    state = T.StructType([flat.schema[n] for n in order])
    flagged = T.StructType([*flat.schema.fields, T.StructField(_EXPIRED, T.BooleanType())])
    new = flat.join(known, PAIR, "left_anti").select(*columns)
    reported = new.groupBy(*PAIR).transformWithState(
        EarliestAccess(state, columns, int(keep.total_seconds() * 1000)), flagged, "append", "processingTime")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch = batch.persist()
        try:
            gone = commits.read(session, base, HISTORY, pairs, before=batch_id).distinct()
            same = [batch[n].eqNullSafe(gone[n]) for n in PAIR]
            found = batch.filter(~F.col(_EXPIRED)).join(gone, same, "left_anti").select(
                *[F.col(f.name).cast(f.dataType) for f in schema.fields])
            commits.commit(session, base, batch_id, {
                FOUND: found, HISTORY: batch.filter(_EXPIRED).select(*PAIR)})
        finally:
            batch.unpersist()

    with timer_settings(spark):
        query = (reported.writeStream.outputMode("append").foreachBatch(on_batch)
                 .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    return first_accesses(commits.read(spark, base, FOUND, schema), order=order)
