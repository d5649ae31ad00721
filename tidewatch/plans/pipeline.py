"""Stage composition (ingest -> clean -> features -> label -> split -> score -> bands).

One Spark application with a lazy plan; the feature/label table is cut from
its lineage once (written to the shared checkpoint folder) because training,
evaluation, banding and monitoring all re-read it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import CORRUPT, CleaningConfig, FeatureConfig, LabelConfig, SplitConfig
from tidewatch.operators import features as feat
from tidewatch.operators import labels as lab
from tidewatch.operators import profile as prof
from tidewatch.operators import split as spl
from tidewatch.operators.schema import split_valid
from tidewatch.session import materialize, scratch_table
from tidewatch.sources.standins import events_transactions


@dataclass(frozen=True)
class PipelineConfig:
    cleaning: CleaningConfig = field(default_factory=CleaningConfig)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    label: LabelConfig = field(default_factory=LabelConfig)
    split: SplitConfig = field(default_factory=SplitConfig)


#: a transaction without these can't be placed, keyed or labelled
TRANSACTION_RULES = {"TransactionID": "required", "TransactionDT": "required"}


def clean_and_quarantine(transactions: DataFrame, cfg: CleaningConfig = CleaningConfig()) -> tuple[DataFrame, DataFrame]:
    """Cleaned transactions, and the rows kept out of them with their ``violations`` (after coercion: a
    missing or unreadable id or time, or a line that its reader could not parse). Of a repeated id the first row stays,
    by ``cfg.order_cols`` or the ingest order."""
    from dataclasses import replace

    from tidewatch.operators.schema import coerce_core_types, require_columns
    require_columns(transactions, ["TransactionID", "TransactionDT", "TransactionAmt", "isFraud"], "cleaning")
    typed = coerce_core_types(transactions) if cfg.cast_types else transactions
    good, bad = split_valid(typed, TRANSACTION_RULES)
    good = good.drop(CORRUPT)
    return prof.clean_merged_dataset(good, replace(cfg, cast_types=False)), bad


def build_dataset(transactions: DataFrame, cfg: PipelineConfig = PipelineConfig(),
                  checkpoint: bool = True) -> DataFrame:
    """Stages 03-06: clean -> features + label -> split.

    * the hot-key chunk lengths are computed once on the keyed input;
    * the label is computed inside the entity-feature pass (same key and order,
      so one shuffle serves both);
    * the cleaned rows (quarantined ones apart, copies removed) are written once,
      as the hot-key counts, the features and the cutoffs all read them; the
      cutoffs scan their time column only;
    * the split dataset is written once to the shared checkpoint folder
      (``spark.checkpoint.dir``) because every later stage re-reads it.
    """
    clean, _ = clean_and_quarantine(transactions, cfg.cleaning)
    if checkpoint:
        clean = scratch_table(clean, "clean")
    if cfg.label.hot_key_rows != cfg.features.hot_key_rows:
        y = lab.make_early_warning_label(feat.build_features(clean, cfg.features, untimed=False), cfg.label, untimed=False)
    else:
        y = feat.build_features(clean, cfg.features, label=cfg.label, untimed=False)
    cut = F.broadcast(spl.cutoffs_frame(clean.select(cfg.split.time_col), cfg.split))     # one row
    ds = spl.assign_split(y.crossJoin(cut), F.col("train_end"), F.col("valid_end"),
                          cfg.split.time_col).drop("train_end", "valid_end")
    if not checkpoint:
        return ds
    return materialize(ds, f"dataset_{uuid.uuid4().hex[:12]}")


#: the events have one row for each id, so any order does
EVENTS = PipelineConfig(cleaning=CleaningConfig(order_cols=("TransactionDT", "TransactionAmt")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per split: rows, label positives, fraud rows and mean ``cnt_1h`` / ``fp_cnt_24h``."""
    ds = build_dataset(events_transactions(spark, sf_dir), EVENTS)
    return (ds.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                    F.sum(F.col("y_ew_72h").cast("bigint")).alias("positives"),
                                    F.sum("isFraud").cast("bigint").alias("fraud_rows"),
                                    F.avg("cnt_1h").alias("avg_cnt_1h"),
                                    F.avg("fp_cnt_24h").alias("avg_fp_cnt_24h"))
            .orderBy("split"))
