"""The frames of ``tessera.sources.frames`` written as ANSI SQL (DuckDB dialect).

Used only by ``oracle_sql()`` in ``__spark_entry__``: each oracle query is
``WITH <frames> SELECT ...`` over the pre-registered table views, so the
oracle recomputes everything from the raw tables independently of Spark.
"""

from __future__ import annotations

SUBSCRIBERS = """
subscribers AS (
  WITH cut AS (SELECT max(o_orderdate) - INTERVAL 300 DAY AS cut FROM orders),
  per_cust AS (
    SELECT o_custkey,
           count(*) FILTER (WHERE o_orderdate <= cut) AS n_hist,
           min(o_orderdate) FILTER (WHERE o_orderdate <= cut) AS first_order,
           sum(o_totalprice) FILTER (WHERE o_orderdate <= cut) AS hist_total,
           max(CASE WHEN o_orderdate > cut THEN 1 ELSE 0 END) AS has_future
    FROM orders, cut GROUP BY o_custkey),
  lines AS (
    SELECT o.o_custkey,
      count(*) FILTER (WHERE split_part(p_type, ' ', 1) = 'ECONOMY')  AS n_economy,
      count(*) FILTER (WHERE split_part(p_type, ' ', 1) = 'LARGE')    AS n_large,
      count(*) FILTER (WHERE split_part(p_type, ' ', 1) = 'MEDIUM')   AS n_medium,
      count(*) FILTER (WHERE split_part(p_type, ' ', 1) = 'PROMO')    AS n_promo,
      count(*) FILTER (WHERE split_part(p_type, ' ', 1) = 'SMALL')    AS n_small,
      count(*) FILTER (WHERE split_part(p_type, ' ', 1) = 'STANDARD') AS n_standard
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey, cut
    WHERE o.o_orderdate <= cut GROUP BY o.o_custkey),
  base AS (
    SELECT c.*, coalesce(pc.n_hist, 0) AS nh, pc.first_order, pc.hist_total,
           coalesce(pc.has_future, 0) AS hf, r.r_name,
           coalesce(n_economy, 0) AS a1, coalesce(n_large, 0) AS a2, coalesce(n_medium, 0) AS a3,
           coalesce(n_promo, 0) AS a4, coalesce(n_small, 0) AS a5, coalesce(n_standard, 0) AS a6,
           CAST(CASE WHEN coalesce(pc.n_hist, 0) = 0 THEN 0
                ELSE least(72, 12 * (year(cut) - year(pc.first_order))
                               + month(cut) - month(pc.first_order)) END AS BIGINT) AS ten,
           CASE WHEN c.c_custkey % 10 = 0 THEN 'No' ELSE 'Yes' END AS phone,
           CASE r.r_name WHEN 'AFRICA' THEN 'No' WHEN 'ASIA' THEN 'Fiber optic'
                WHEN 'AMERICA' THEN 'Fiber optic' WHEN 'EUROPE' THEN 'DSL'
                WHEN 'MIDDLE EAST' THEN 'DSL' END AS inet
    FROM customer c
    LEFT JOIN per_cust pc ON c.c_custkey = pc.o_custkey
    LEFT JOIN lines ln ON c.c_custkey = ln.o_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey, cut)
  SELECT
    c_name AS customerID,
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT) AS SeniorCitizen,
    CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN c_acctbal > 6000 THEN 'Yes' ELSE 'No' END AS Dependents,
    ten AS tenure,
    phone AS PhoneService,
    CASE WHEN phone = 'No' THEN 'No phone service' WHEN nh >= 10 THEN 'Yes' ELSE 'No' END
      AS MultipleLines,
    inet AS InternetService,
    CASE WHEN inet = 'No' THEN 'No internet service' WHEN a1 >= 6 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
    CASE WHEN inet = 'No' THEN 'No internet service' WHEN a2 >= 6 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
    CASE WHEN inet = 'No' THEN 'No internet service' WHEN a3 >= 6 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
    CASE WHEN inet = 'No' THEN 'No internet service' WHEN a4 >= 6 THEN 'Yes' ELSE 'No' END AS TechSupport,
    CASE WHEN inet = 'No' THEN 'No internet service' WHEN a5 >= 6 THEN 'Yes' ELSE 'No' END AS StreamingTV,
    CASE WHEN inet = 'No' THEN 'No internet service' WHEN a6 >= 6 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'Two year' WHEN 'FURNITURE' THEN 'One year'
         ELSE 'Month-to-month' END AS Contract,
    CASE WHEN c_custkey % 3 <> 0 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    CASE c_nationkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer (automatic)' WHEN 3 THEN 'Credit card (automatic)' END
      AS PaymentMethod,
    CASE WHEN ten = 0 THEN 20.0 ELSE round(hist_total / 1000.0 / ten, 2) END AS MonthlyCharges,
    CASE WHEN ten = 0 THEN ' ' ELSE CAST(round(hist_total / 1000.0, 2) AS VARCHAR) END
      AS TotalCharges,
    CASE WHEN hf = 0 THEN 'Yes' ELSE 'No' END AS Churn
  FROM base)
"""

# subscribers through the whole feature chain (FX1 → FX16), 33 features + target
FEATURES = """
features AS (
  WITH s1 AS (
    SELECT *,
      CASE WHEN isnan(TRY_CAST(TotalCharges AS DOUBLE)) THEN NULL
           ELSE TRY_CAST(TotalCharges AS DOUBLE) END AS tc_num
    FROM subscribers),
  s2 AS (
    SELECT *,
      coalesce(tc_num, 0.0) AS tc,
      CAST(CASE WHEN gender = 'Female' THEN 1 ELSE 0 END AS INTEGER) AS is_female_,
      CASE MultipleLines WHEN 'No phone service' THEN 0 WHEN 'No internet service' THEN 0
           WHEN 'No' THEN 1 WHEN 'Yes' THEN 2 END AS ml,
      CASE OnlineSecurity WHEN 'No phone service' THEN 0 WHEN 'No internet service' THEN 0
           WHEN 'No' THEN 1 WHEN 'Yes' THEN 2 END AS os,
      CASE OnlineBackup WHEN 'No phone service' THEN 0 WHEN 'No internet service' THEN 0
           WHEN 'No' THEN 1 WHEN 'Yes' THEN 2 END AS ob,
      CASE DeviceProtection WHEN 'No phone service' THEN 0 WHEN 'No internet service' THEN 0
           WHEN 'No' THEN 1 WHEN 'Yes' THEN 2 END AS dp,
      CASE TechSupport WHEN 'No phone service' THEN 0 WHEN 'No internet service' THEN 0
           WHEN 'No' THEN 1 WHEN 'Yes' THEN 2 END AS ts,
      CASE StreamingTV WHEN 'No phone service' THEN 0 WHEN 'No internet service' THEN 0
           WHEN 'No' THEN 1 WHEN 'Yes' THEN 2 END AS stv,
      CASE StreamingMovies WHEN 'No phone service' THEN 0 WHEN 'No internet service' THEN 0
           WHEN 'No' THEN 1 WHEN 'Yes' THEN 2 END AS smv,
      CASE Contract WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 END
        AS contract_encoded
    FROM s1),
  s3 AS (
    SELECT *,
      CAST((os = 2) IS TRUE AS INTEGER) + CAST((ob = 2) IS TRUE AS INTEGER)
      + CAST((dp = 2) IS TRUE AS INTEGER) + CAST((ts = 2) IS TRUE AS INTEGER)
      + CAST((stv = 2) IS TRUE AS INTEGER) + CAST((smv = 2) IS TRUE AS INTEGER) AS n_services_
    FROM s2)
  SELECT
    is_female_ AS is_female,
    SeniorCitizen,
    CAST(Partner = 'Yes' IS TRUE AS INTEGER) AS Partner,
    CAST(Dependents = 'Yes' IS TRUE AS INTEGER) AS Dependents,
    CAST(PhoneService = 'Yes' IS TRUE AS INTEGER) AS PhoneService,
    ml AS MultipleLines,
    CAST(InternetService = 'DSL' IS TRUE AS INTEGER) AS "internet_DSL",
    CAST(InternetService = 'Fiber optic' IS TRUE AS INTEGER) AS "internet_Fiber optic",
    CAST(InternetService = 'No' IS TRUE AS INTEGER) AS "internet_No",
    os AS OnlineSecurity, ob AS OnlineBackup, dp AS DeviceProtection, ts AS TechSupport,
    stv AS StreamingTV, smv AS StreamingMovies,
    contract_encoded,
    CAST(PaperlessBilling = 'Yes' IS TRUE AS INTEGER) AS PaperlessBilling,
    CAST(PaymentMethod = 'Bank transfer (automatic)' IS TRUE AS INTEGER)
      AS "payment_Bank transfer (automatic)",
    CAST(PaymentMethod = 'Credit card (automatic)' IS TRUE AS INTEGER)
      AS "payment_Credit card (automatic)",
    CAST(PaymentMethod = 'Electronic check' IS TRUE AS INTEGER) AS "payment_Electronic check",
    CAST(PaymentMethod = 'Mailed check' IS TRUE AS INTEGER) AS "payment_Mailed check",
    tenure,
    ln(1 + CAST(greatest(tenure, 0) AS DOUBLE)) AS log_tenure,
    MonthlyCharges,
    tc AS TotalCharges,
    ln(1 + greatest(tc, 0.0)) AS log_TotalCharges,
    coalesce(CASE WHEN tc = 0 THEN NULL ELSE MonthlyCharges / tc END, 0.0) AS monthly_to_total_ratio,
    coalesce(CASE WHEN tenure = 0 THEN NULL ELSE tc / tenure END, 0.0) AS total_per_month,
    n_services_ AS n_services,
    CASE WHEN tenure > -1 AND tenure <= 12 THEN 0 WHEN tenure > 12 AND tenure <= 24 THEN 1
         WHEN tenure > 24 AND tenure <= 48 THEN 2 WHEN tenure > 48 AND tenure <= 72 THEN 3 END
      AS tenure_bin,
    CAST((InternetService = 'Fiber optic' AND contract_encoded = 0) IS TRUE AS INTEGER)
      AS has_fiber_monthly,
    coalesce(CASE WHEN n_services_ = 0 THEN NULL ELSE MonthlyCharges / n_services_ END, 0.0)
      AS avg_monthly_per_service,
    CAST(tenure = 0 IS TRUE AS INTEGER) AS is_new_customer,
    CAST(Churn = 'Yes' IS TRUE AS INTEGER) AS Churn,
    customerID
  FROM s3)
"""

SCORED = """
scored AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
         CAST(l_returnflag = 'R' AS INTEGER) AS y,
         round(l_extendedprice / 110000.0, 3) AS p
  FROM lineitem)
"""


ENC = """
enc AS (
  SELECT * REPLACE (
    CASE WHEN isnan(TRY_CAST(TotalCharges AS DOUBLE)) THEN NULL
         ELSE TRY_CAST(TotalCharges AS DOUBLE) END AS TotalCharges,
    CAST(Churn = 'Yes' IS TRUE AS INTEGER) AS Churn)
  FROM subscribers)
"""

# name -> (sql, dependencies); extended by catalog modules via ``define``
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "subscribers": (SUBSCRIBERS, ()),
    "enc": (ENC, ("subscribers",)),
    "features": (FEATURES, ("subscribers",)),
    "scored": (SCORED, ()),
}


def define(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    """Register an extra named CTE usable in ``with_frames``."""
    CTES[name] = (sql, tuple(deps))


def with_frames(body: str, *names: str) -> str:
    """``WITH`` the named frames (dependencies first) followed by ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    head = "WITH RECURSIVE " + ",\n".join(CTES[n][0].strip() for n in order)  # RECURSIVE only permits it
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return head + ",\n" + stripped[5:]
    return head + "\n" + body
