"""Catalog: streaming monitor (SC7) over the events table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tessera.plans.catalog import register
from tessera.plans.catalog.common import rnd
from tessera.session import table
from tessera.sources import io
from tessera.streaming.monitor import stream_monitor

WATERMARK_HOURS = 1
ALARM = 50.0  # a value from here on predicts an error


def _sql(by: str | None) -> str:
    sel = f", {by}" if by else ""
    return f"""
WITH e AS (SELECT date_trunc('day', ts) AS ws, * FROM events),
w AS (SELECT ws{sel}, count(*) AS n, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS n_error,
             CAST(count(*) FILTER (WHERE event_type = 'error' AND value >= {ALARM}) AS BIGINT) AS tp,
             CAST(count(*) FILTER (WHERE event_type <> 'error' AND value >= {ALARM}) AS BIGINT) AS fp,
             CAST(count(*) FILTER (WHERE event_type = 'error' AND value < {ALARM}) AS BIGINT) AS fn,
             CAST(count(*) FILTER (WHERE event_type <> 'error' AND value < {ALARM}) AS BIGINT) AS tn,
             round(sum(value), 6) AS value_sum, min(value) AS value_min, max(value) AS value_max
      FROM e GROUP BY ws{sel})
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(ws + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end{sel},
       n, n_error, tp, fp, fn, tn, round((tp + fn) / n::DOUBLE, 6) AS real_rate, round((tp + fp) / n::DOUBLE, 6) AS predicted_rate,
       round((tp + tn) / n::DOUBLE, 6) AS accuracy, value_sum, value_min, value_max
FROM w WHERE ws + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL {WATERMARK_HOURS} HOUR"""


def _stream(spark, sf, by=()):
    src = os.path.join(sf, "events.parquet")
    schema = table(spark, sf, "events").schema
    sink, ck = io.scratch_dir(spark, "events-windows"), io.scratch_dir(spark, "events-windows-ckpt")
    out = stream_monitor(spark, src, schema, sink, ck, "1 day", f"{WATERMARK_HOURS} hour", by,
                         predicted=(F.col("value") >= ALARM).cast("int"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return out.select(F.date_format("window_start", fmt).alias("window_start"),
                      F.date_format("window_end", fmt).alias("window_end"), *by,
                      "n", "n_error", "tp", "fp", "fn", "tn", rnd("real_rate").alias("real_rate"),
                      rnd("predicted_rate").alias("predicted_rate"), rnd("accuracy").alias("accuracy"), rnd("value_sum").alias("value_sum"), "value_min", "value_max")


@register("sc7_stream_monitor", _sql(None))
def sc7_stream_monitor(spark, sf):
    return _stream(spark, sf)


@register("sc7_stream_monitor_by_type", _sql("event_type"))
def sc7_stream_monitor_by_type(spark, sf):
    return _stream(spark, sf, ("event_type",))
