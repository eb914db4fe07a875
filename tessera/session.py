"""Session helpers shared by the library, the tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the library assumes.

    On a cluster the session is created by the launcher; this builder is for
    tests, the bench and local runs.  ``spark.sql.shuffle.partitions`` is left
    to AQE coalescing, and the session time zone is pinned to UTC because the
    test tables store ``TIMESTAMP_NTZ`` values that are cast to ``TIMESTAMP``
    before watermarks.
    """
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "6g"))
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Uses whatever the cluster configured (``spark.checkpoint.dir`` or the
    context's checkpoint dir).  Only a local session without one (tests, bench)
    gets a scratch folder; on a cluster executors would not share it, so there
    a missing setting raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables, read lazily (pruning and pushdown apply)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    return the frame read from there (``compression``: another codec than the
    session's).

    The lineage is cut (a lost executor re-reads files instead of recomputing
    the plan) and the plan runs once.  Reading the table back, the file source
    sizes partitions by ``spark.sql.files.maxPartitionBytes``, so a small
    frame becomes a few partitions and a large one stays spread; filters and
    column pruning of later plans reach the scan.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path, compression=compression)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def drop_tables(spark: SparkSession) -> int:
    """Delete the tables that ``materialize`` has written so far; call it when the
    results that read them have been used.  Returns how many there were."""
    jvm, n = spark.sparkContext._jvm, len(_WRITTEN)
    while _WRITTEN:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return n


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """The small side of a join keyed on a low-cardinality column (a class,
    a category): written once (``materialize``), counted, and marked for
    broadcast when it has at most ``max_rows`` rows — a measured bound, not
    an estimate.  Larger tables are returned unmarked, so the planner's
    shuffle join (with AQE skew splitting) applies.
    """
    from pyspark.sql import functions as F
    t = materialize(df)
    return F.broadcast(t) if t.count() <= max_rows else t
