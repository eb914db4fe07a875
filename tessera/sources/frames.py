"""Frames the operators run on, derived from the test tables.

``subscribers`` has the raw customer-table schema (one row per customer),
``scored`` is a (label, probability) table over ``lineitem`` and ``events``
is the event stream with a proper ``TIMESTAMP`` column.

Every frame is a lazy plan over the parquet files, so filters and column
pruning reach the scans.  The joins are keyed equi-joins; the dimension
tables (nation, region) are left to the planner, whose broadcast decision is
bounded by ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.features import round_to
from tessera.plans.config import ADDON_COLUMNS, PAYMENT_METHODS
from tessera.session import table

# FIXED VALUES: mapping of the TPC-H-like tables onto the customer schema.
HISTORY_CUT_DAYS = 300
ADDON_PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
ADDON_MIN_LINES = 6
MULTI_LINE_MIN_ORDERS = 10
REGION_INTERNET = {"AFRICA": "No", "ASIA": "Fiber optic", "AMERICA": "Fiber optic",
                   "EUROPE": "DSL", "MIDDLE EAST": "DSL"}
SEGMENT_CONTRACT = {"MACHINERY": "Two year", "FURNITURE": "One year"}  # else Month-to-month
SCORE_DIVISOR = 110000.0
SCORED_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def _lookup(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer table (schema of the original source) from the TPC-H tables.

    Features use orders up to ``cut`` (max order date minus 300 days); the
    label uses orders after it.  Three aggregations, each keyed by customer:
    orders per customer (one shuffle on o_custkey), history line items per
    customer and part-type word (lineitem ⋈ orders ⋈ part, then a partial +
    final aggregate on the customer key), and the customer dimension chain.
    """
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # the cut-off is computed once (one aggregate over one column) and used as
    # a literal: the plan below then scans orders only for its own two uses
    cut_text = table(spark, sf_dir, "orders").agg(F.date_format(
        F.max("o_orderdate") - F.expr(f"INTERVAL {HISTORY_CUT_DAYS} DAYS"),
        "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    cut = F.lit(cut_text).cast("timestamp_ntz")
    in_hist = F.col("o_orderdate") <= cut

    per_cust = orders.groupBy("o_custkey").agg(
        F.count_if(in_hist).alias("n_hist"),
        F.min(F.when(in_hist, F.col("o_orderdate"))).alias("first_order"),
        F.sum(F.when(in_hist, F.col("o_totalprice"))).alias("hist_total"),
        F.max(F.when(~in_hist, F.lit(1)).otherwise(F.lit(0))).alias("has_future"),
    )

    hist_orders = orders.filter(in_hist).select("o_orderkey", "o_custkey")
    type_word = F.substring_index(F.col("p_type"), " ", 1)
    lines = (lineitem.join(hist_orders, lineitem.l_orderkey == hist_orders.o_orderkey)
             .join(part, F.col("l_partkey") == F.col("p_partkey"))
             .groupBy("o_custkey")
             .agg(*[F.count_if(type_word == t).alias(f"n_{t.lower()}")
                    for t in ADDON_PART_TYPES])
             .withColumnRenamed("o_custkey", "l_custkey"))

    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    base = (customer
            .join(per_cust, F.col("c_custkey") == F.col("o_custkey"), "left")
            .join(lines, F.col("c_custkey") == F.col("l_custkey"), "left")
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left"))

    n_hist = F.coalesce(F.col("n_hist"), F.lit(0))
    months = (F.lit(12) * (F.year(cut) - F.year("first_order"))
              + F.month(cut) - F.month("first_order"))
    tenure = (F.when(n_hist == 0, F.lit(0))
              .otherwise(F.least(F.lit(72), months))).cast("bigint")
    internet = _lookup(F.col("r_name"), REGION_INTERNET)
    phone = F.when(F.col("c_custkey") % 10 == 0, "No").otherwise("Yes")
    yes_no = lambda cond: F.when(cond, "Yes").otherwise("No")
    total = F.col("hist_total") / 1000.0

    cols = [
        F.col("c_name").alias("customerID"),
        F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).cast("bigint").alias("SeniorCitizen"),
        yes_no(F.col("c_nationkey") % 2 == 0).alias("Partner"),
        yes_no(F.col("c_acctbal") > 6000).alias("Dependents"),
        F.col("_tenure").alias("tenure"),
        F.col("_phone").alias("PhoneService"),
        F.when(F.col("_phone") == "No", "No phone service")
         .otherwise(yes_no(n_hist >= MULTI_LINE_MIN_ORDERS)).alias("MultipleLines"),
        F.col("_internet").alias("InternetService"),
    ]
    for addon, word in zip(ADDON_COLUMNS, ADDON_PART_TYPES):
        n = F.coalesce(F.col(f"n_{word.lower()}"), F.lit(0))
        cols.append(F.when(F.col("_internet") == "No", "No internet service")
                    .otherwise(yes_no(n >= ADDON_MIN_LINES)).alias(addon))
    cols += [
        _lookup(F.col("c_mktsegment"), SEGMENT_CONTRACT, "Month-to-month").alias("Contract"),
        yes_no(F.col("c_custkey") % 3 != 0).alias("PaperlessBilling"),
        _lookup(F.col("c_nationkey") % 4, dict(enumerate(PAYMENT_METHODS))).alias("PaymentMethod"),
        F.when(F.col("_tenure") == 0, F.lit(20.0))
         .otherwise(F.round(total / F.col("_tenure"), 2)).alias("MonthlyCharges"),
        F.when(F.col("_tenure") == 0, F.lit(" "))
         .otherwise(F.round(total, 2).cast("string")).alias("TotalCharges"),
        yes_no(F.coalesce(F.col("has_future"), F.lit(0)) == 0).alias("Churn"),
    ]
    return (base.withColumn("_tenure", tenure)
                .withColumn("_phone", phone)
                .withColumn("_internet", internet)
                .select(*cols))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, y, p) over lineitem: y = returned, p = price-derived score with ties."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *SCORED_KEY,
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        round_to(F.col("l_extendedprice") / SCORE_DIVISOR, 3).alias("p"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant (watermarks need TIMESTAMP, not NTZ)."""
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def features(spark: SparkSession, sf_dir: str, keep_id: bool = True) -> DataFrame:
    """``subscribers`` through the feature chain (FX23); ``customerID`` kept as key."""
    from tessera.plans.feature_chain import feature_chain
    from tessera.plans.config import ID_COLUMN
    return feature_chain(subscribers(spark, sf_dir), keep=[ID_COLUMN] if keep_id else [])
