"""Frozen configuration objects (one per stage), defaults = reference values."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference for the same results.
ENTITY_KEY_COLUMNS = ("card1", "card2", "card3", "card5", "addr1")
FINGERPRINT_KEY_COLUMNS = ("DeviceInfo", "P_emaildomain", "ProductCD")
KEY_SEPARATOR = "||"
FEATURE_KEEP_COLUMNS = (
    "TransactionID", "TransactionDT", "TransactionAmt", "isFraud",
    "entity_key", "fingerprint_key",
    "ProductCD", "P_emaildomain", "R_emaildomain",
    "DeviceType", "DeviceInfo",
)
ENGINEERED_COLUMNS = (
    "cnt_1h", "sum_amt_1h", "cnt_24h", "avg_amt_24h",
    "mean_amt_7d_hist", "std_amt_7d_hist", "z_amt_vs_7d",
    "fp_cnt_24h", "fp_cnt_72h", "fp_growth_ratio_24h_over_72h",
)
NUMERIC_FEATURES = ("TransactionAmt",) + ENGINEERED_COLUMNS
CATEGORICAL_FEATURES = ("ProductCD", "P_emaildomain", "R_emaildomain", "DeviceType")
AUDIT_KEY_COLUMNS = (
    "TransactionID", "TransactionDT", "TransactionAmt", "isFraud",
    "ProductCD", "card1", "card2", "card3", "card5", "addr1", "addr2",
    "P_emaildomain", "R_emaildomain", "DeviceType", "DeviceInfo",
)
BAND_ORDER = ("critical", "high", "medium", "low")
BAND_ACTIONS = {
    "critical": "BLOCK_AND_REVIEW — Immediate manual review required",
    "high": "STEP_UP_AUTH — Request additional authentication",
    "medium": "MONITOR — Flag for delayed review; apply additional rules",
    "low": "APPROVE — Auto-approve with standard monitoring",
}
SERVING_CUTOFFS = {"critical": 0.9528, "high": 0.9121, "medium": 0.7430}
ENTITY_BUCKETS = 2 ** 20
FINGERPRINT_BUCKETS = 2 ** 18
HASHED_FEATURES = 2 ** 18
#: columns that readers add: the place of a row in its files, and the text of a row that could not be parsed
INGEST, CORRUPT = "_ingest", "_corrupt_record"

# The defaults below (windows, horizon, quantiles, capacity shares, alert limits) are
# fixed values, too: they must equal the original's for equal results.


@dataclass(frozen=True)
class FeatureConfig:
    win_1h: int = 3600
    win_24h: int = 86400
    win_72h: int = 3 * 86400
    win_7d: int = 7 * 86400
    # "lagged" = code (previous row's amount, current rows' window);
    # "strict" = documented (rows strictly before me within 7 days).
    history: str = "lagged"
    # "delta": chunked event-delta prefix sums, O(n), splits hot keys by time.
    # "frame": plain composite-order RANGE frames (reference semantics check).
    strategy: str = "delta"
    # keys with more rows than this are split into time chunks of ~this many rows
    hot_key_rows: int | None = 1 << 21
    amount_scale: int = 6


@dataclass(frozen=True)
class LabelConfig:
    horizon_seconds: int = 72 * 3600
    mode: str = "any_in_horizon"   # or "next_event" (the coded behaviour)
    label_name: str = "y_ew_72h"
    hot_key_rows: int | None = 1 << 21


@dataclass(frozen=True)
class SplitConfig:
    train_quantile: float = 0.70
    valid_quantile: float = 0.85
    time_col: str = "TransactionDT"


@dataclass(frozen=True)
class CleaningConfig:
    enforce_transaction_id_unique: bool = True
    cast_types: bool = True
    order_cols: tuple = ()   # which row of a repeated id is first; default: ingest order, if the rows carry it


@dataclass(frozen=True)
class AuditConfig:
    key_columns: tuple = AUDIT_KEY_COLUMNS
    top_n: int = 10


@dataclass(frozen=True)
class BandPolicy:
    critical_top_pct: float = 1.0
    high_top_pct: float = 3.0
    medium_top_pct: float = 8.0
    policy: str = "quantile"   # or "exact_k"


@dataclass(frozen=True)
class DriftConfig:
    features: tuple = NUMERIC_FEATURES
    p_threshold: float = 0.05
    min_rows: int = 10
    # "auto": exact up to p_exact_rows on both sides, a series beyond; or "limiting" (the limiting distribution)
    p_method: str = "auto"
    p_exact_rows: int = 10_000
    drift_share_alert: float = 0.30
    score_mean_change_alert: float = 0.05
    reference_score_mean: float | None = None


@dataclass(frozen=True)
class LogisticConfig:
    C: float = 1.0
    max_iter: int = 2000
    class_weight: str = "balanced"
    seed: int = 42
    extra: dict = field(default_factory=dict)
