"""FX23: the whole feature chain from one configuration mapping.

The steps run in the configured order (type cast → flags → imputation →
binary → ternary → categorical → derived → ratios → log → select) as a
chain of ``DataFrame.transform`` calls, so the result is a single lazy
Catalyst plan: one scan, one projection, nothing materialised in between.
The only job the chain may trigger is learning the one-hot categories (a
small distinct), unless they are passed in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tessera.functions import features as fx
from tessera.plans.config import FEATURE_CONFIG

Step = Callable[[DataFrame], DataFrame]


def build_steps(cfg: dict | None = None, categories: dict | None = None,
                keep: Sequence[str] = ()) -> list[tuple[str, Step]]:
    """Ordered (name, step) list for the configuration."""
    cfg = FEATURE_CONFIG if cfg is None else cfg
    steps: list[tuple[str, Step]] = []
    if cfg.get("type_cast"):
        steps.append(("type_cast", lambda d: fx.type_cast(d, cfg["type_cast"])))
    if cfg.get("binary_flags"):
        steps.append(("binary_flags", lambda d: fx.binary_flags(d, cfg["binary_flags"])))
    if cfg.get("imputation"):
        bad = [s for s in cfg["imputation"] if s.get("strategy", "constant") not in ("constant", "median")]
        if bad:
            raise ValueError(f"imputation strategies not supported: {bad}")
        steps.append(("imputation", lambda d: fx.constant_impute(d, cfg["imputation"])))
    if cfg.get("binary_encoding"):
        be = cfg["binary_encoding"]
        steps.append(("binary_encoding",
                      lambda d: fx.binary_encode(d, be["columns"], be.get("positive_value", "Yes"))))
    if cfg.get("ternary_encoding"):
        te = cfg["ternary_encoding"]
        steps.append(("ternary_encoding",
                      lambda d: fx.ordinal_encode(d, te["columns"], te["ordinal_map"])))
    if cfg.get("categorical_encoding"):
        steps.append(("categorical_encoding",
                      lambda d: fx.categorical_encode(d, cfg["categorical_encoding"], categories)))
    if cfg.get("derived_features"):
        steps.append(("derived_features", lambda d: fx.derived_features(d, cfg["derived_features"])))
    if cfg.get("ratio_features"):
        steps.append(("ratio_features", lambda d: fx.ratio_features(d, cfg["ratio_features"])))
    if cfg.get("log_transform"):
        steps.append(("log_transform",
                      lambda d: fx.log_transform(d, cfg["log_transform"]["columns"])))
    if cfg.get("feature_selection"):
        keep_cols = cfg["feature_selection"]["features_to_keep"]
        steps.append(("feature_selection", lambda d: fx.select_features(d, keep_cols, keep)))
    return steps


def feature_chain(df: DataFrame, cfg: dict | None = None, categories: dict | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Apply every configured step; ``keep`` carries extra columns (e.g. a key)."""
    for _, step in build_steps(cfg, categories, keep):
        df = df.transform(step)
    return df
