"""Alerts counted once, in keyed state: windows that are emitted as they grow and closed by a timer, and first deliveries.

State is kept per window or per alert in the state store that spills to disk, is forgotten after a while (TTL), and
has no watermark in front of it: a record that comes late is counted as late, never dropped.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cardlens.schema import ALERT_FIELDS, FRAUD_ALERT, struct_of

# a window closes when it has got nothing for so long; what was seen is remembered longer, for what is delivered again
QUIET = datetime.timedelta(minutes=10)
REMEMBERED = datetime.timedelta(days=2)
WINDOW_COUNTS = "window_start timestamp, window_end timestamp, new_alerts bigint, late_alerts bigint, closed boolean, revision bigint"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession, available_now: bool = False) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, which timers and TTL need; other queries' settings are left alone.

    Timers ask for a batch at every trigger.  A query that is to end when it has read what there is must
    not wait for them: its timers go off in the next run.
    """
    wanted = {PROVIDER: ROCKSDB, **({NO_DATA: "false"} if available_now else {})}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _milliseconds(span: datetime.timedelta) -> int:
    return int(span.total_seconds() * 1000)


def _window_counter(quiet_ms: int, remember_ms: int) -> StatefulProcessor:
    """The processor of ``window_counts``; made here, so that it travels to the workers by value, without this library."""

    class WindowCounter(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.seen = handle.getMapState("seen", "at bigint, trans_num string", "times int", remember_ms)
            self.state = handle.getValueState("state", "window_end timestamp, alerts bigint, late bigint, closed boolean, revision bigint", remember_ms)

        def _emit(self, key, end, alerts, late, closed, revision):
            self.state.update((end, alerts, late, closed, revision))
            yield Row(window_start=key[0], window_end=end, new_alerts=alerts, late_alerts=late, closed=closed, revision=revision)

        def handleInputRows(self, key, rows, timerValues):
            end, alerts, late, closed, revision = tuple(self.state.get()) if self.state.exists() else (None, 0, 0, False, 0)
            fresh = 0
            for row in rows:
                end = row.window_end
                if not self.seen.containsKey((row.at, row.trans_num)):
                    self.seen.updateValue((row.at, row.trans_num), (1,))
                    fresh += 1
            if not fresh:
                return
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not closed:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + quiet_ms)
            yield from self._emit(key, end, alerts + fresh, late + (fresh if closed else 0), closed, revision + 1)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            if self.state.exists():
                end, alerts, late, _, revision = tuple(self.state.get())
                yield from self._emit(key, end, alerts, late, True, revision + 1)

        def close(self) -> None:
            pass

    return WindowCounter()


def window_counts(alerts: DataFrame, step: str = "5 minutes", quiet: datetime.timedelta = QUIET, remember: datetime.timedelta = REMEMBERED) -> DataFrame:
    """Different alerts per event-time window, as updates: a row whenever a batch adds some, and one when the window closes.

    A window closes when it has got nothing for ``quiet``; what comes after that still counts, and is counted as late too.
    An alert is told by its time and number, and counts once however often it is delivered within ``remember``.
    """
    window = F.window("trans_time", step)
    rows = alerts.select(window["start"].alias("window_start"), window["end"].alias("window_end"), F.unix_micros("trans_time").alias("at"), "trans_num")
    return rows.groupBy("window_start").transformWithState(
        statefulProcessor=_window_counter(_milliseconds(quiet), _milliseconds(remember)),
        outputStructType=WINDOW_COUNTS, outputMode="Update", timeMode="ProcessingTime",
    )


def _first_delivery(names: tuple[str, ...], newest: tuple[str, ...], remember_ms: int) -> StatefulProcessor:
    class FirstDelivery(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "times int", remember_ms)

        def handleInputRows(self, key, rows, timerValues):
            best = max(rows, key=lambda row: tuple((row[c] is not None, row[c]) for c in newest))
            if not self.seen.exists():
                self.seen.update((1,))
                yield Row(**{name: best[name] for name in names})

        def close(self) -> None:
            pass

    return FirstDelivery()


def first_deliveries(alerts: DataFrame, remember: datetime.timedelta = REMEMBERED) -> DataFrame:
    """Alerts that were not delivered before, within ``remember``; of one delivered twice at once the row that the table would keep."""
    names = tuple(ALERT_FIELDS)
    return alerts.select(*names).groupBy(*FRAUD_ALERT.key).transformWithState(
        statefulProcessor=_first_delivery(names, FRAUD_ALERT.newest, _milliseconds(remember)),
        outputStructType=struct_of(ALERT_FIELDS), outputMode="Update", timeMode="ProcessingTime",
    )
