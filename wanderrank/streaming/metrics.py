"""Metric windows, consecutive-breach alarms and quota usage.

The source system's dashboard and alarms are 5-minute aggregates of
invocation logs (Sum / Average / p99) and threshold rules over N
consecutive periods. Here the log is a DataFrame (name, ts, invocations,
errors, duration_ms); the windows are a grouped aggregate (batch: exact
percentile; stream: ``percentile_approx`` with a watermark), the alarms a
window function over a per-name grid of periods in which a missing period
counts as not breaching.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanderrank.functions.scalar import exact_avg
from wanderrank.session import saved

# ---- fixed values of the monitoring rules -------------------------------------
PERIOD = "5 minutes"
PERIOD_SECONDS = 300
MONTHLY_QUOTA = 10000


@dataclass(frozen=True)
class Alarm:
    name: str
    metric: str          # column of the window table
    threshold: float
    periods: int         # consecutive breaching periods needed
    level: str = "name"  # "name": per name; "all": summed over names


ALARMS = [
    Alarm("errors", "errors", 5, 2),
    Alarm("server_errors", "errors", 10, 1, level="all"),
    Alarm("latency_p99", "p99_duration_ms", 25000, 2),
]


def exact_percentile(df: DataFrame, keys: list[str], value: str, p: float,
                     out: str = "percentile") -> DataFrame:
    """Exact interpolated percentile per group (rank ``p * (n - 1)``).

    The rows are first reduced to (group, value, count) by a hash aggregate
    that combines map-side, so a hot group shrinks to its distinct values
    before anything moves; the order statistics are then read from running
    counts over those distinct values. No group's raw rows are ever gathered.
    """
    vc = df.groupBy(*keys, value).agg(F.count(value).alias("_c"))
    return _order_statistics(vc, keys, value, p).agg(_interpolated().alias(out))


def _order_statistics(vc: DataFrame, keys: list[str], value: str, p: float):
    """(keys, value, _c) grouped by the keys, with the two order statistics
    around rank ``p * (n - 1)`` marked in ``_x`` and ``_y``, their weight in
    ``_f``. Null values have ``_c`` 0 and do not count."""
    w_all = Window.partitionBy(*keys)
    w_run = w_all.orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    vc = vc.withColumn("_cum", F.sum("_c").over(w_run)).withColumn("_n", F.sum("_c").over(w_all))
    pos = F.lit(p) * (F.col("_n") - 1)
    return (vc.withColumn("_x", F.when(F.col("_cum") > F.floor(pos), F.col(value)).cast("double"))
            .withColumn("_y", F.when(F.col("_cum") > F.ceil(pos), F.col(value)).cast("double"))
            .withColumn("_f", pos - F.floor(pos)).groupBy(*keys))


def _interpolated():
    return F.min("_x") + (F.min("_y") - F.min("_x")) * F.first("_f")


def metric_windows(log: DataFrame, period: str = PERIOD, exact: bool = True) -> DataFrame:
    """Per name and tumbling period: invocations, errors (sums), mean and
    99th-percentile duration (exact in batch, a sketch in streams).

    The batch form reads the log once: rows are reduced to (name, period,
    duration) with a count and the sums, which combine map-side; mean and
    percentile both come from that table, so a hot name shrinks to its
    distinct durations before anything moves, and nothing is joined."""
    if not exact:
        # grouped by the window() column itself, so a stream's watermark applies
        return (log.groupBy("name", F.window("ts", period).alias("w")).agg(
            F.sum("invocations").alias("invocations"), F.sum("errors").alias("errors"),
            exact_avg(F.col("duration_ms")).alias("avg_duration_ms"),
            F.percentile_approx("duration_ms", 0.99).alias("p99_duration_ms"))
            .withColumn("window_start", F.col("w.start")).drop("w"))
    keys = ["name", "window_start"]
    vc = (log.withColumn("window_start", F.window("ts", period).start)
          .groupBy(*keys, "duration_ms")
          .agg(F.count("duration_ms").alias("_c"), F.sum("duration_ms").alias("_d"),
               F.sum("invocations").alias("_i"), F.sum("errors").alias("_e")))
    return _order_statistics(vc, keys, "duration_ms", 0.99).agg(
        F.sum("_i").alias("invocations"), F.sum("_e").alias("errors"),
        (F.sum("_d").cast("double") / F.sum("_c")).alias("avg_duration_ms"),
        _interpolated().alias("p99_duration_ms")).select(
            "name", "invocations", "errors", "avg_duration_ms", "window_start", "p99_duration_ms")


def stream_metric_windows(stream: DataFrame, period: str = PERIOD,
                          watermark: str = "10 minutes") -> DataFrame:
    """Streaming form (append): a period is emitted once the watermark passes it."""
    s = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return metric_windows(s, period, exact=False)


# ---- mergeable percentiles -----------------------------------------------------
SKETCH_K = 2000


def rank_error(k: int = SKETCH_K) -> float:
    """Rank error of a KLL sketch of size ``k`` at 99 % confidence (one quantile),
    the sketch library's own fit."""
    return 2.296 / k ** 0.9723


def metric_sketches(log: DataFrame, period: str = PERIOD, k: int = SKETCH_K) -> DataFrame:
    """Per name and period: sums, and a KLL sketch of the durations. Works on a
    stream (with a watermark) as on a table; the rows are small, mergeable states."""
    return (log.groupBy("name", F.window("ts", period).alias("w")).agg(
        F.sum("invocations").alias("invocations"), F.sum("errors").alias("errors"),
        F.count("duration_ms").alias("n"), F.sum(F.col("duration_ms").cast("double")).alias("duration_sum"),
        F.kll_sketch_agg_double(F.col("duration_ms").cast("double"), k).alias("sketch"))
        .withColumn("window_start", F.col("w.start")).drop("w"))


def stream_metric_sketches(stream: DataFrame, period: str = PERIOD, watermark: str = "10 minutes",
                           k: int = SKETCH_K) -> DataFrame:
    """Streaming form (append): a period's state is written once it is final."""
    return metric_sketches(stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark), period, k)


def merge_sketches(states: DataFrame, period: str, k: int = SKETCH_K) -> DataFrame:
    """States of short periods -> states of longer ones (an hour, a day): sums are
    added, sketches merged; the log is not read again."""
    start = F.window("window_start", period).start
    return states.withColumn("window_start", start).groupBy("name", "window_start").agg(
        *[F.sum(c).alias(c) for c in ("invocations", "errors", "n", "duration_sum")],
        F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_windows(states: DataFrame, p: float = 0.99) -> DataFrame:
    """States -> the columns of ``metric_windows``, with the sketched percentile."""
    return states.select("name", "invocations", "errors",
                         F.when(F.col("n") > 0, F.col("duration_sum") / F.col("n")).alias("avg_duration_ms"), "window_start",
                         F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))).alias("p99_duration_ms"))


def _grid(windows: DataFrame, key: str, period_seconds: int) -> DataFrame:
    """Every period between each key's first and last observed period."""
    step = F.make_dt_interval(secs=F.lit(period_seconds))
    span = windows.groupBy(key).agg(F.min("window_start").alias("_a"), F.max("window_start").alias("_b"))
    return span.select(key, F.explode(F.sequence("_a", "_b", step)).alias("window_start"))


def alarm_eval(windows: DataFrame, alarms: list[Alarm] | None = None,
               period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """Alarm state per (alarm, name, period): ALARM when this and the
    previous ``periods - 1`` periods all exceed the threshold (missing period
    = not breaching), else OK.

    The windows (one row per name and period) are written once and read by
    every rule, so the log below them is read once."""
    windows = windows.transform(saved)
    out = None
    for a in alarms or ALARMS:
        if a.level == "all":
            src = (windows.groupBy("window_start")
                   .agg(F.sum(a.metric).alias("value")).withColumn("name", F.lit("all")))
        else:
            src = windows.select("name", "window_start", F.col(a.metric).alias("value"))
        grid = _grid(src, "name", period_seconds)
        j = grid.join(src, ["name", "window_start"], "left")
        breach = F.coalesce(F.col("value") > F.lit(a.threshold), F.lit(False))
        w = (Window.partitionBy("name").orderBy("window_start")
             .rowsBetween(-(a.periods - 1), Window.currentRow))
        run = F.sum(breach.cast("int")).over(w)
        res = j.select(F.lit(a.name).alias("alarm"), "name", "window_start",
                       F.col("value").cast("double").alias("value"), breach.alias("breaching"),
                       F.when(run == a.periods, "ALARM").otherwise("OK").alias("state"))
        out = res if out is None else out.unionByName(res)
    return out


def quota_usage(calls: DataFrame, key: str = "user_id", quota: int = MONTHLY_QUOTA) -> DataFrame:
    """Calls per key per calendar month against the quota."""
    return (calls.groupBy(key, F.date_trunc("month", F.col("ts")).alias("month"))
            .agg(F.count(F.lit(1)).alias("calls"))
            .withColumn("remaining", F.greatest(F.lit(quota) - F.col("calls"), F.lit(0)))
            .withColumn("over_quota", F.col("calls") > quota))


def log_from_events(events: DataFrame) -> DataFrame:
    """Invocation log from the driver's event stream: one invocation per event,
    name = event type, an error when the value is out of the 0..100 range,
    duration = the value (exact decimal)."""
    return events.select(
        F.col("event_type").alias("name"), F.col("ts"),
        F.lit(1).cast("long").alias("invocations"),
        (F.col("value") > 100).cast("long").alias("errors"),
        F.col("value").cast("decimal(12,2)").alias("duration_ms"))
