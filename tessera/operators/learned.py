"""Learned column operators (LN1-LN10): fit on training rows, apply anywhere.

Each estimator's ``fit`` runs one distributed aggregate and returns a model
holding only small parameters (one value per column, or a per-group table
kept as a DataFrame).  ``transform`` is a projection with literals, or one
keyed join for per-group parameters, so applying a model never re-reads
the training data.  Using a model before fitting is impossible (LN10): only
``fit`` creates one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.quantiles import exact_quantiles


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _require(df: DataFrame, cols: Sequence[str], who: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{who}: columns absent: {missing}")


def _per_column(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list]:
    """Exact quantiles per column collected as {column: [q...]} (one row per column)."""
    rows = exact_quantiles(df, cols, probs).collect()
    out = {c: [None] * len(probs) for c in cols}
    for r in rows:
        out[r["column"]] = [r[f"q{i}"] for i in range(len(probs))]
    return out


# ---- LN1 -----------------------------------------------------------------------
class MedianImputer:
    """LN1: NULL → exact interpolated median of the training rows."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)

    def fit(self, df: DataFrame) -> "MedianImputerModel":
        _require(df, self.columns, "MedianImputer.fit")
        med = {c: v[0] for c, v in _per_column(df, self.columns, [0.5]).items()}
        return MedianImputerModel(med)


@dataclass
class MedianImputerModel:
    medians: dict

    def transform(self, df: DataFrame) -> DataFrame:
        _require(df, list(self.medians), "MedianImputerModel.transform")
        return df.withColumns({c: F.coalesce(_q(c), F.lit(m).cast(df.schema[c].dataType))
                               for c, m in self.medians.items()})


# ---- LN2 -----------------------------------------------------------------------
MAX_BROADCAST_GROUPS = 200_000  # (group value, median) rows: a few MB at most


class GroupMedianImputer:
    """LN2: NULL → median of its group; unseen group, NULL group or a group
    without values → global median."""

    def __init__(self, column: str, group: str | None):
        self.column, self.group = column, group

    def fit(self, df: DataFrame) -> "GroupMedianImputerModel":
        _require(df, [self.column] + ([self.group] if self.group else []), "GroupMedianImputer.fit")
        if not self.group:
            glob = _per_column(df, [self.column], [0.5])[self.column][0]
            return GroupMedianImputerModel(self.column, None, glob, None)
        from tessera.session import materialize
        # group medians and the global median in ONE plan: every row counts
        # once at its group (level 0; NULL groups left out) and once at the
        # top (level 1, group NULL).  The learned table is written once (a
        # model holds parameters, not a plan to recompute) and its measured
        # size decides the broadcast in ``transform``.
        gtype = df.schema[self.group].dataType
        levels = F.explode(F.array(
            F.struct(F.lit(0).alias("__lvl"), _q(self.group).alias("__g")),
            F.struct(F.lit(1).alias("__lvl"), F.lit(None).cast(gtype).alias("__g"))))
        long = (df.select(levels.alias("__k"), _q(self.column).alias("__x"))
                  .select("__k.*", "__x")
                  .where((F.col("__lvl") == 1) | F.col("__g").isNotNull()))
        learned = materialize(exact_quantiles(long, ["__x"], [0.5], by=["__lvl", "__g"])
                              .select("__lvl", "__g", F.col("q0").alias("__gm")))
        top = learned.where(F.col("__lvl") == 1).select("__gm").collect()  # one row at most
        glob = top[0]["__gm"] if top else None
        table = learned.where(F.col("__lvl") == 0).select("__g", "__gm")
        if table.count() <= MAX_BROADCAST_GROUPS:
            table = F.broadcast(table)
        return GroupMedianImputerModel(self.column, self.group, glob, table)


@dataclass
class GroupMedianImputerModel:
    column: str
    group: str | None
    global_median: float | None
    medians: DataFrame | None  # (__g, __gm): one row per group

    def transform(self, df: DataFrame) -> DataFrame:
        """Left join on the group.  A group column has few values (a join
        keyed on it would put each group in one task), so ``fit`` marks the
        medians table for broadcast when its measured row count is within
        ``MAX_BROADCAST_GROUPS``; beyond that the planner's shuffle join (AQE
        splits a hot group) applies."""
        glob = F.lit(self.global_median).cast("double")
        if self.medians is None:
            return df.withColumn(self.column, F.coalesce(_q(self.column), glob))
        j = df.join(self.medians, _q(self.group).eqNullSafe(F.col("__g")), "left")
        return j.withColumn(self.column, F.coalesce(_q(self.column), F.col("__gm"), glob)).drop("__g", "__gm")

    def params(self) -> DataFrame:
        return self.medians.withColumnRenamed("__g", self.group).withColumnRenamed("__gm", "median")


# ---- LN3 / LN4 -------------------------------------------------------------------
class StandardScaler:
    """LN3: (x − mean) / sample std; a column with std 0 (or undefined) is left unchanged."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)

    def fit(self, df: DataFrame) -> "StandardScalerModel":
        present = [c for c in self.columns if c in df.columns]
        aggs = []
        for i, c in enumerate(present):
            x = _q(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
        row = df.agg(*aggs).first() if aggs else None
        params = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(present)}
        return StandardScalerModel(params)


@dataclass
class StandardScalerModel:
    params: dict  # column -> (mean, std)

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (m, s) in self.params.items():
            if c in df.columns and s is not None and s > 0 and m is not None:
                out[c] = (_q(c).cast("double") - F.lit(m)) / F.lit(s)
        return df.withColumns(out) if out else df

    def params_frame(self, spark) -> DataFrame:
        """LN4: (feature, mean, std) audit table."""
        return spark.createDataFrame([(c, m, s) for c, (m, s) in self.params.items()],
                                     "feature string, mean double, std double")


# ---- LN5 -------------------------------------------------------------------------
class RobustScaler:
    """LN5: (x − median) / IQR with exact quartiles; IQR 0 → scale 1."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)

    def fit(self, df: DataFrame) -> "RobustScalerModel":
        _require(df, self.columns, "RobustScaler.fit")
        q = _per_column(df, self.columns, [0.25, 0.5, 0.75])
        return RobustScalerModel({c: (v[1], (v[2] - v[0]) if v[0] is not None else None)
                                  for c, v in q.items()})


@dataclass
class RobustScalerModel:
    params: dict  # column -> (median, iqr)

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (med, iqr) in self.params.items():
            if med is None:
                continue
            scale = iqr if iqr else 1.0
            out[c] = (_q(c).cast("double") - F.lit(med)) / F.lit(scale)
        return df.withColumns(out) if out else df


# ---- LN6 -------------------------------------------------------------------------
class OneHotLearned:
    """LN6: categories learned from training rows, sorted, first dropped;
    unknown or NULL → all zeros.  All columns are learned in one job; a
    category is an output column, so their number is the width of the result."""

    def __init__(self, columns: Sequence[str], drop_first: bool = True):
        self.columns, self.drop_first = list(columns), drop_first

    def fit(self, df: DataFrame) -> "OneHotModel":
        from tessera.functions.features import learn_categories_many
        return OneHotModel(learn_categories_many(df, self.columns), self.drop_first)


@dataclass
class OneHotModel:
    categories: dict
    drop_first: bool = True

    def output_columns(self) -> list[str]:
        out = []
        for c, cats in self.categories.items():
            out += [f"{c}_{v}" for v in (cats[1:] if self.drop_first else cats)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        from tessera.functions.features import equals_flag
        out = {}
        for c, cats in self.categories.items():
            for v in (cats[1:] if self.drop_first else cats):
                out[f"{c}_{v}"] = equals_flag(_q(c), v)
        return df.withColumns(out).drop(*self.categories)


# ---- LN7 -------------------------------------------------------------------------
def column_transformer(df: DataFrame, groups: Sequence[tuple[object, Sequence[str]]],
                       passthrough: Sequence[str] = (), output: str = "features") -> DataFrame:
    """LN7: different fitted steps per column group, then one assembled vector.

    ``groups`` is a list of (fitted model or None, columns); every model's
    ``transform`` is applied in turn (each touches only its columns), then
    the listed output columns are assembled into ``output``.
    """
    from pyspark.ml.feature import VectorAssembler
    cols: list[str] = []
    for model, columns in groups:
        if model is not None:
            df = model.transform(df)
        cols += (model.output_columns() if isinstance(model, OneHotModel) else list(columns))
    cols += list(passthrough)
    return VectorAssembler(inputCols=cols, outputCol=output, handleInvalid="keep").transform(df)


# ---- LN8 -------------------------------------------------------------------------
def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(_q(label).alias(label)).agg(F.count(F.lit(1)).alias("n_c"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """LN8: per class weight n / (k · n_c) — a table with one row per class."""
    cc = class_counts(df, label)
    n = cc.agg(F.sum("n_c")).scalar()
    k = cc.agg(F.count(F.lit(1))).scalar()
    return cc.withColumn("weight", n / (k * F.col("n_c")))


CASE_CLASSES = 1000  # classes up to which weights are a literal CASE


def with_class_weight(df: DataFrame, label: str, mode: str | float = "balanced",
                      out: str = "weight") -> DataFrame:
    """LN8: add a weight column: 'balanced', or a fixed weight for class 1.

    Balanced weights come from one grouped count (one row per class, written
    once).  Few classes are applied as a literal ``CASE`` on the label: a join
    keyed on a label with two values would send each class to one task.  With
    more than ``CASE_CLASSES`` classes the table is joined, hot classes by
    broadcast.  A NULL label gets a NULL weight (it counts in n and k, like any
    class).
    """
    if mode != "balanced":
        return df.withColumn(out, F.when(_q(label) == 1, F.lit(float(mode))).otherwise(F.lit(1.0)))
    from tessera.session import materialize
    counts = materialize(class_counts(df, label))
    total = counts.agg(F.count(F.lit(1)).alias("k"), F.sum("n_c").alias("n")).first()
    n, k = total["n"] or 0, total["k"]
    if k <= CASE_CLASSES:
        expr = F.lit(None).cast("double")
        for r in counts.where(_q(label).isNotNull()).collect():
            expr = F.when(_q(label) == F.lit(r[label]), F.lit(n / (k * r["n_c"]))).otherwise(expr)
        return df.withColumn(out, expr)
    heavy = F.col("n_c") >= n / CASE_CLASSES  # at most CASE_CLASSES classes
    weights = counts.select(_q(label).alias("__c"), (F.lit(float(n)) / (k * F.col("n_c"))).alias("__w"), heavy.alias("__heavy"))
    j = df.join(F.broadcast(weights.where("__heavy")).drop("__heavy").withColumnsRenamed({"__c": "__hc", "__w": "__hw"}),
                _q(label) == F.col("__hc"), "left")
    rest = F.when(F.col("__hw").isNull(), _q(label))  # rows with a heavy class need no second match
    j = j.join(weights.where("NOT __heavy").drop("__heavy"), rest == F.col("__c"), "left")
    return j.withColumn(out, F.coalesce("__hw", "__w")).drop("__hc", "__hw", "__c", "__w")


# ---- LN9 -------------------------------------------------------------------------
class QuantileBinner:
    """LN9 (qcut): q equal-count bins from exact quantile edges, duplicate
    edges dropped, right-closed with the lowest value in the first bin;
    applied only when the column has more than q distinct values (otherwise
    the value itself is the stratum)."""

    def __init__(self, column: str, q: int):
        self.column, self.q = column, q

    def fit(self, df: DataFrame) -> "QuantileBinnerModel":
        n_distinct = df.agg(F.count_distinct(_q(self.column))).first()[0]
        if n_distinct <= self.q:
            return QuantileBinnerModel(self.column, None)
        probs = [i / self.q for i in range(self.q + 1)]
        edges = _per_column(df, [self.column], probs)[self.column]
        uniq = sorted(set(e for e in edges if e is not None))
        return QuantileBinnerModel(self.column, uniq)


@dataclass
class QuantileBinnerModel:
    column: str
    edges: list | None

    def transform(self, df: DataFrame, out: str = "bin") -> DataFrame:
        x = _q(self.column)
        if self.edges is None:
            return df.withColumn(out, x.cast("double"))
        e = self.edges
        expr = F.when((x >= F.lit(e[0])) & (x <= F.lit(e[1])), F.lit(0))
        for i in range(1, len(e) - 1):
            expr = expr.when((x > F.lit(e[i])) & (x <= F.lit(e[i + 1])), F.lit(i))
        return df.withColumn(out, expr.cast("double"))
