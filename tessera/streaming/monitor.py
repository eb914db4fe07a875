"""Structured Streaming: monitoring windows (SC7) and incremental ingest (IO11).

Both run with ``trigger(availableNow=True)``: everything present is
processed in micro-batches, the watermark advances, and the query stops —
the same job runs continuously with a processing-time trigger.  State and
progress live in a checkpoint under the shared checkpoint folder, so a
restarted job resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_path(spark: SparkSession, path: str) -> str:
    """A file-stream source path: folders as they are; a single file becomes a
    one-file glob (the file source lists a folder or a glob, not a file)."""
    from tessera.sources.io import _fs
    fs, p = _fs(spark, path)
    if fs.exists(p) and fs.isFile(p):
        head, base = path.rstrip("/").rsplit("/", 1)
        return f"{head}/[{base[0]}]{base[1:]}"
    return path


def window_metrics(stream: DataFrame, ts: str = "ts", window: str = "1 day", watermark: str = "1 hour",
                   by: tuple[str, ...] = (), real: Column | None = None, predicted: Column | None = None) -> DataFrame:
    """SC7 plan: event-time windows (late rows beyond the watermark dropped) with the
    count, confusion counts of ``predicted`` against ``real`` (0/1 columns; by
    default the class is "error" and nothing is predicted), and value statistics.
    """
    y = (F.col("event_type") == "error").cast("int") if real is None else real
    yhat = F.lit(0) if predicted is None else predicted
    w = F.window(F.col(ts), window)
    return (stream.withWatermark(ts, watermark)
            .groupBy(w.alias("window"), *by)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(y.cast("long")).alias("n_error"),
                 *[F.sum(((y == a) & (yhat == b)).cast("long")).alias(name)
                   for name, a, b in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))],
                 F.sum("value").alias("value_sum"),
                 F.min("value").alias("value_min"), F.max("value").alias("value_max")))


def with_rates(windows: DataFrame) -> DataFrame:
    """Real and predicted share of class 1, and the accuracy, of every window."""
    n = F.col("n").cast("double")
    return windows.withColumns({"real_rate": (F.col("tp") + F.col("fn")) / n,
                                "predicted_rate": (F.col("tp") + F.col("fp")) / n,
                                "accuracy": (F.col("tp") + F.col("tn")) / n})


def run_available(df: DataFrame, sink_path: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet") -> None:
    """Run a streaming plan over everything available, then stop."""
    q = (df.writeStream.format(fmt).outputMode(mode)
         .option("path", sink_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_monitor(spark: SparkSession, source_dir: str, schema: T.StructType | str, sink_path: str,
                   checkpoint: str, window: str = "1 day", watermark: str = "1 hour",
                   by: tuple[str, ...] = (), real: Column | None = None,
                   predicted: Column | None = None) -> DataFrame:
    """SC7: parquet event files → windowed metrics (append mode: closed windows) → sink.

    Returns the sink read back as a batch table, flattened to
    (window_start, window_end, by..., metrics).
    """
    src = (spark.readStream.schema(schema).parquet(stream_path(spark, source_dir))
           .withColumn("ts", as_utc_instant(F.col("ts"))))
    run_available(window_metrics(src, "ts", window, watermark, by, real, predicted), sink_path, checkpoint)
    out = with_rates(spark.read.parquet(sink_path))
    return out.select(utc_wall_clock(F.col("window.start")).alias("window_start"),
                      utc_wall_clock(F.col("window.end")).alias("window_end"),
                      *by, "n", "n_error", "tp", "fp", "fn", "tn", "real_rate", "predicted_rate", "accuracy",
                      "value_sum", "value_min", "value_max")


def as_utc_instant(ntz: Column) -> Column:
    """TIMESTAMP_NTZ read as a UTC wall clock → TIMESTAMP (instant), whatever
    the session time zone (watermarks need TIMESTAMP)."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ntz.cast("timestamp_ntz")).cast("timestamp")


def utc_wall_clock(ts: Column) -> Column:
    """TIMESTAMP (instant) → its UTC wall clock as TIMESTAMP_NTZ."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def stream_ingest(spark: SparkSession, csv_dir: str, schema: T.StructType | str, output_path: str,
                  checkpoint: str, compression: str = "snappy") -> DataFrame:
    """IO11: CSV files appended to a Parquet table as they arrive (file source,
    exactly-once file sink), returned as a batch read of the table."""
    src = (spark.readStream.schema(schema).option("enforceSchema", False).option("header", True).option("quote", '"')
           .option("escape", '"').option("mode", "FAILFAST").csv(csv_dir))
    q = (src.writeStream.format("parquet").option("compression", compression)
         .option("path", output_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(output_path)
