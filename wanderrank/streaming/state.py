"""Stateful streams with event-time timers: live alarms, and a last-value store that
expires by event time. One small state per key; no grid of periods and no filter
over a whole table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wanderrank.session import ship_package
from wanderrank.streaming.metrics import ALARMS, PERIOD, PERIOD_SECONDS, Alarm

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_stateful(df: DataFrame, sink, checkpoint_dir: str, output_mode: str = "append",
                   available_now: bool = True) -> StreamingQuery:
    """Start a query with the state store that timers need, leaving the session's
    own setting as it was (a query keeps the settings of its start). ``sink``: a
    function from the stream writer to the stream writer with its sink."""
    spark = df.sparkSession
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        w = sink(df.writeStream.outputMode(output_mode)).option("checkpointLocation", checkpoint_dir)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
        return w.start()
    finally:
        spark.conf.set(key, before)


def _micros(t) -> int:
    return int(pd.Timestamp(t).value // 1000)


# ------------------------------------------------------------------------ alarms
class _Alarm(StatefulProcessor):
    """Per (alarm, name): the last period told and the breaches in a row up to it.

    Periods come in order (an append-mode window is emitted once it is final). A
    period that is skipped is told as not breaching when the next one comes; the
    first one skipped is told by a timer already when the watermark passes it, so a
    live alarm ends without data."""

    def __init__(self, seconds: int):
        self.step = seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", "last bigint, run int")

    def _rows(self, key, told: list[tuple[int, float | None, bool, str]]) -> pd.DataFrame:
        return pd.DataFrame({
            "alarm": [key[0]] * len(told), "name": [key[1]] * len(told),
            "window_start": pd.to_datetime([t for t, *_ in told], unit="us"),
            "value": pd.array([v for _, v, *_ in told], dtype="float64"),
            "breaching": [b for *_, b, _ in told], "state": [s for *_, s in told]})

    def _timer(self, last: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        # the next period is over at last + 2 steps
        self.handle.registerTimer((last + 2 * self.step) // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, run = self.state.get() if self.state.exists() else (None, 0)
        told = []
        for r in pd.concat(list(rows)).sort_values("window_start").itertuples():  # new periods of one key
            at = _micros(r.window_start)
            if last is not None and at <= last:
                continue  # told as missing already
            for missing in range(last + self.step, at, self.step) if last is not None else ():
                told.append((missing, None, False, "OK"))
                run = 0
            value = None if pd.isna(r.value) else float(r.value)
            breach = value is not None and value > r.threshold
            run = min(run + 1, r.periods) if breach else 0
            told.append((at, value, breach, "ALARM" if run == r.periods else "OK"))
            last = at
        if told:
            self.state.update((last, run))
            self._timer(last)
            yield self._rows(key, told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, run = self.state.get()
        self.state.update((last + self.step, 0))
        yield self._rows(key, [(last + self.step, None, False, "OK")])

    def close(self) -> None:
        pass


def alarm_values(log: DataFrame, alarms: list[Alarm] | None = None, period: str = PERIOD,
                 watermark: str = "10 minutes") -> DataFrame:
    """A log stream -> one row per rule, name and final period: alarm, name,
    window_start, window_time, value, threshold, periods. One aggregation over the
    log serves the rules per name and those over all names."""
    alarms = alarms or ALARMS
    scopes = F.array(F.struct(F.lit("name").alias("level"), F.col("name").alias("who")),
                     F.struct(F.lit("all").alias("level"), F.lit("all").alias("who")))
    s = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    agg = (s.withColumn("_s", F.explode(scopes)).groupBy("_s.level", "_s.who", F.window("ts", period).alias("w")).agg(
        F.sum("invocations").alias("invocations"), F.sum("errors").alias("errors"),
        F.percentile_approx("duration_ms", 0.99).alias("p99_duration_ms")))
    rules = F.array(*[F.struct(F.lit(a.name).alias("alarm"), F.lit(a.level).alias("on"), F.col(a.metric).cast("double").alias("value"),
                               F.lit(float(a.threshold)).alias("threshold"), F.lit(a.periods).alias("periods")) for a in alarms])
    return (agg.withColumn("window_time", F.window_time("w")).withColumn("_r", F.explode(rules)).where("_r.on = level")
            .select("_r.alarm", F.col("who").alias("name"), F.col("w.start").alias("window_start"), "window_time",
                    "_r.value", "_r.threshold", "_r.periods"))


def stream_alarms(log: DataFrame, alarms: list[Alarm] | None = None, period: str = PERIOD,
                  period_seconds: int = PERIOD_SECONDS, watermark: str = "10 minutes") -> DataFrame:
    """alarm_eval over a stream (append): alarm, name, window_start, value,
    breaching, state. As the batch form, up to each name's last period; beyond it
    the first missing period is told as OK once the watermark passes it."""
    ship_package(log.sparkSession)
    out = "alarm string, name string, window_start timestamp, value double, breaching boolean, state string"
    return alarm_values(log, alarms, period, watermark).groupBy("alarm", "name").transformWithStateInPandas(
        statefulProcessor=_Alarm(period_seconds), outputStructType=out, outputMode="Append", timeMode="EventTime")


# ------------------------------------------------------------------- expiring store
class _LastValue(StatefulProcessor):
    """Per key the row of the largest event time, until it is ``seconds`` old."""

    def __init__(self, seconds: int):
        self.ttl = seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", "ts bigint, value string")

    def _row(self, key, op: str, ts: int, value) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "op": [op], "ts": pd.to_datetime([ts], unit="us"), "value": [value]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = self.state.get() if self.state.exists() else None
        new = best
        for frame in rows:  # ties by value, so replays agree
            for ts, value in zip(frame["ts"], frame["value"]):
                row = (_micros(ts), "" if value is None else value)
                if new is None or row > tuple(new):
                    new = row
        if best is not None and tuple(new) == tuple(best):
            return
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer((new[0] + self.ttl) // 1000)
        self.state.update(tuple(new))
        yield self._row(key, "put", *new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ts, value = self.state.get()
        self.state.clear()
        yield self._row(key, "expired", ts, value)

    def close(self) -> None:
        pass


def stream_expiring(stream: DataFrame, key: str, ts: str, value: str, ttl: dt.timedelta,
                    watermark: str = "0 seconds") -> DataFrame:
    """The store's put and expire rules as a change feed (append): key, op (put:
    this is the key's newest row; expired: its newest row is older than ``ttl`` by
    event time), ts, value. A null value is kept as empty text."""
    ship_package(stream.sparkSession)
    s = stream.select(F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("ts"),
                      F.col(value).cast("string").alias("value")).where("ts is not null").withWatermark("ts", watermark)
    return s.groupBy("key").transformWithStateInPandas(
        statefulProcessor=_LastValue(int(ttl.total_seconds())), outputStructType="key string, op string, ts timestamp, value string",
        outputMode="Append", timeMode="EventTime")
