"""Scans, sources and sinks (IO1-IO10).

CSV ingestion reads with an explicit schema (no inference) and FAILFAST
parsing; Parquet scans are plain ``spark.read.parquet`` so pruning and
pushdown apply.  File listing, existence checks and the ingest audit use the
Hadoop FileSystem of the session, so paths may be local, HDFS or object
stores alike.  Small reports are written with ``coalesce(1)``: it keeps the
row order of a sorted report (a ``repartition(1)`` shuffle would not), and
after a sort or an aggregate it only merges that last, small stage.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir

CODECS = {"snappy", "gzip", "brotli", "none", "uncompressed", "zstd", "lz4"}


# ---- file system helpers ----------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted paths matching a glob (empty list when nothing matches)."""
    fs, p = _fs(spark, pattern)
    st = fs.globStatus(p)
    return sorted(s.getPath().toString() for s in (st or []) if s.isFile())


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def exists_nonempty(spark: SparkSession, path: str) -> bool:
    """True when ``path`` is a file with content or a completed Spark write (it has
    ``_SUCCESS``); what a failed write left behind does not count."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    if fs.isFile(p):
        return fs.getFileStatus(p).getLen() > 0
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate outputs."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-scratch/{name}-{uuid.uuid4().hex[:12]}"


# ---- IO4 / IO7 ---------------------------------------------------------------------
def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """IO4: raise listing the absent columns (schema only, no rows read)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns absent: {missing}")


def schema_profile(df: DataFrame) -> DataFrame:
    """IO7: (position, name, type) per column, from the schema (no job on data)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


# ---- IO1 / IO5 -------------------------------------------------------------------------
def read_csv(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str) -> DataFrame:
    """Header, comma, '"' quotes with doubled quotes, no embedded newlines, FAILFAST.

    ``enforceSchema`` is off: the reader compares the header of every file with
    the schema, name by name, and fails on a file with other or reordered columns
    instead of putting values under wrong names.
    """
    return (spark.read.schema(schema).option("enforceSchema", False)
            .option("header", True).option("sep", ",").option("quote", '"').option("escape", '"')
            .option("multiLine", False).option("mode", "FAILFAST")
            .csv(list(paths)))


def ingest_audit(df: DataFrame) -> DataFrame:
    """IO5: rows and bytes per input file (one grouped aggregate over the scan); files
    of one name in several folders stay apart."""
    return (df.select("_metadata.file_path", "_metadata.file_name", "_metadata.file_size")
              .groupBy("file_path", "file_name").agg(F.count(F.lit(1)).alias("rows"),
                                        F.max("file_size").alias("bytes"))
              .orderBy("file_path"))


def ingest_csv(spark: SparkSession, raw_dir: str, output_path: str, schema: T.StructType | str,
               compression: str = "snappy", required_columns: Sequence[str] = (),
               skip_if_exists: bool = True, force: bool = False) -> dict:
    """IO1: every ``*.csv`` of a folder (sorted) → one Parquet table, audited.

    Missing input → error.  With ``skip_if_exists`` a non-empty output is
    left alone unless ``force`` (IO3).  Returns the audit: files, rows in
    total, bytes in and out, ratio, seconds, and ``per_file``, a DataFrame with
    rows and bytes per file (evaluated only when it is used).
    """
    t0 = time.time()
    files = list_files(spark, f"{raw_dir.rstrip('/')}/*.csv")
    if not files:
        raise FileNotFoundError(f"no CSV files under {raw_dir}")
    if skip_if_exists and not force and exists_nonempty(spark, output_path):
        return {"skipped": True, "output": output_path}
    df = read_csv(spark, files, schema)
    require_columns(df, required_columns)
    write_parquet(df, output_path, compression, mode="overwrite")
    rows = spark.read.schema(df.schema).parquet(output_path).count()  # from the footers: no column is read
    bytes_out, bytes_in = _dir_size(spark, output_path), sum(_dir_size(spark, f) for f in files)
    return {"skipped": False, "files": len(files), "rows": rows, "bytes_in": bytes_in,
            "bytes_out": bytes_out, "ratio": (bytes_in / bytes_out) if bytes_out else None,
            "per_file": ingest_audit(df), "seconds": time.time() - t0}


def _dir_size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


# ---- IO2 / IO3 / IO6 / IO8 / IO9 / IO10 ---------------------------------------------------
def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite") -> None:
    """IO2: Parquet with the chosen codec."""
    if compression not in CODECS:
        raise ValueError(f"unsupported codec {compression}")
    df.write.mode(mode).option("compression", "none" if compression == "uncompressed" else compression) \
        .parquet(path)


def write_once(spark: SparkSession, df: DataFrame, path: str, compression: str = "snappy",
               force: bool = False) -> bool:
    """IO3: write unless a non-empty output exists (or ``force``); True if written."""
    if exists_nonempty(spark, path) and not force:
        return False
    write_parquet(df, path, compression, "overwrite")
    return True


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """IO6: read a stage output; error when absent."""
    if not exists_nonempty(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def write_report_json(df: DataFrame, path: str) -> None:
    """IO8: a small report as one JSON file (the frame is a report, not data)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_stats_csv(df: DataFrame, path: str) -> None:
    """IO9: one small statistic as one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def verify_written(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """IO10: re-read the output; compare schema and row count (two counts)."""
    back = spark.read.parquet(path)
    same_schema = [(f.name, f.dataType) for f in back.schema.fields] == \
                  [(f.name, f.dataType) for f in expected.schema.fields]
    return back.agg(F.count(F.lit(1)).alias("rows_written")).withColumns({
        "rows_expected": expected.agg(F.count(F.lit(1))).scalar(),
        "columns": F.lit(len(back.columns)),
        "schema_equal": F.lit(same_schema)}).withColumn(
        "ok", F.col("schema_equal") & (F.col("rows_written") == F.col("rows_expected")))
