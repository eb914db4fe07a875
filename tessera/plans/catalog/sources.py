"""Catalog: sources and sinks (IO1-IO11).

Write-side operators write into a fresh folder under the session's
checkpoint directory and return what they wrote, read back through Spark.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from tessera.operators import quality as qc
from tessera.plans.catalog import register
from tessera.plans.catalog.quality import RAW_COLUMNS, SUITE, suite_sql
from tessera.plans.config import QUALITY_SUITE
from tessera.session import table
from tessera.sources import frames
from tessera.sources import io
from tessera.streaming.monitor import stream_ingest

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _customer_csv(spark, sf) -> str:
    """customer written as several CSV files (header, quoted) in a scratch folder."""
    d = io.scratch_dir(spark, "customer-csv")
    table(spark, sf, "customer").repartition(3, "c_custkey").write.option("header", True) \
        .option("quote", '"').option("escape", '"').csv(d)
    return d


@register("io6_scan_orders", "SELECT * FROM orders")
def io6_scan_orders(spark, sf):
    return io.scan_parquet(spark, os.path.join(sf, "orders.parquet"))


@register("io6_scan_pushdown", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def io6_scan_pushdown(spark, sf):
    o = io.scan_parquet(spark, os.path.join(sf, "orders.parquet"))
    return o.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)).select(
        "o_orderkey", "o_totalprice")


@register("io1_ingest_csv", "SELECT * FROM customer")
def io1_ingest_csv(spark, sf):
    src = _customer_csv(spark, sf)
    out = io.scratch_dir(spark, "customer-parquet")
    audit = io.ingest_csv(spark, src, out, CUSTOMER_SCHEMA, "snappy",
                          required_columns=["c_custkey", "c_name"])
    assert audit["rows"] > 0
    return spark.read.parquet(out)


@register("io5_audit_per_file", """
SELECT c_nationkey, count(*) AS rows, true AS bytes_known FROM customer GROUP BY c_nationkey""")
def io5_audit_per_file(spark, sf):
    """One CSV file per nation; each file's audited rows stand beside its nation."""
    d = io.scratch_dir(spark, "customer-by-nation")
    table(spark, sf, "customer").withColumn("nation", F.col("c_nationkey")).repartition("nation").write \
        .partitionBy("nation").option("header", True).option("quote", '"').option("escape", '"').csv(d)
    read = io.read_csv(spark, io.list_files(spark, f"{d}/nation=*/*.csv"), CUSTOMER_SCHEMA)
    of = read.select("c_nationkey", "_metadata.file_path").distinct()
    return io.ingest_audit(read).join(of, "file_path").groupBy("c_nationkey").agg(
        F.sum("rows").alias("rows"), (F.min("bytes") > 0).alias("bytes_known"))


@register("io5_ingest_audit", "SELECT count(*) AS rows, 3 AS files, true AS bytes_known FROM customer")
def io5_ingest_audit(spark, sf):
    src = _customer_csv(spark, sf)
    files = io.list_files(spark, f"{src}/*.csv")
    audit = io.ingest_audit(io.read_csv(spark, files, CUSTOMER_SCHEMA))
    return audit.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).cast("int").alias("files"),
                     (F.min("bytes") > 0).alias("bytes_known"))


@register("io2_io3_write_codecs", """
SELECT codec, (SELECT count(*) FROM orders) AS rows, false AS rewritten
FROM (VALUES ('snappy'), ('gzip'), ('none')) AS c(codec)""")
def io2_io3_write_codecs(spark, sf):
    o = table(spark, sf, "orders")
    rows = []
    for codec in ("snappy", "gzip", "none"):
        p = io.scratch_dir(spark, f"orders-{codec}")
        io.write_parquet(o, p, codec)
        again = io.write_once(spark, o, p, codec)          # skipped: exists
        rows.append((codec, spark.read.parquet(p).count(), again))
    return spark.createDataFrame(rows, "codec string, rows long, rewritten boolean")


@register("io4_io7_schema_profile", """
SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS name,
       CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
            ELSE lower(column_type) END AS type
FROM (DESCRIBE lineitem)""")
def io4_io7_schema_profile(spark, sf):
    li = table(spark, sf, "lineitem")
    io.require_columns(li, ["l_orderkey", "l_extendedprice"])
    return io.schema_profile(li)


@register("io8_write_report_json", f"""
SELECT count(*) AS total, count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed,
       CAST(count(*) AS INTEGER) AS details FROM ({suite_sql(SUITE, "subscribers", RAW_COLUMNS)})""", ("subscribers",))
def io8_write_report_json(spark, sf):
    res = qc.run_suite(frames.subscribers(spark, sf), QUALITY_SUITE)
    p = io.scratch_dir(spark, "quality-report")
    io.write_report_json(qc.suite_report(res), p)
    back = spark.read.json(p)
    doc = json.loads(back.first()["report"])
    return spark.createDataFrame([(doc["total"], doc["passed"], doc["failed"], len(doc["details"]))],
                                 "total long, passed long, failed long, details int")


@register("io9_write_stats_csv", """
SELECT o_orderpriority AS value, CAST(count(*) AS VARCHAR) AS n,
       CAST(round(count(*) / CAST((SELECT count(*) FROM orders) AS DOUBLE), 4) AS VARCHAR) AS share
FROM orders GROUP BY o_orderpriority""")
def io9_write_stats_csv(spark, sf):
    from tessera.operators.profile import value_counts
    p = io.scratch_dir(spark, "stats-csv")
    io.write_stats_csv(value_counts(table(spark, sf, "orders"), "o_orderpriority"), p)
    return spark.read.option("header", True).csv(p)


@register("io10_verify_written", """
SELECT count(*) AS rows_written, count(*) AS rows_expected,
       (SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE lineitem)) AS columns, true AS schema_equal, true AS ok FROM lineitem""")
def io10_verify_written(spark, sf):
    li = table(spark, sf, "lineitem")
    p = io.scratch_dir(spark, "lineitem-copy")
    io.write_parquet(li, p)
    return io.verify_written(spark, p, li)


@register("io11_stream_ingest", "SELECT * FROM customer")
def io11_stream_ingest(spark, sf):
    src = _customer_csv(spark, sf)
    out = io.scratch_dir(spark, "customer-stream")
    ck = io.scratch_dir(spark, "customer-stream-ckpt")
    return stream_ingest(spark, src, CUSTOMER_SCHEMA, out, ck)
