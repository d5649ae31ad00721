"""Registered queries: each runs a library operator over whole driver tables.

Every entry pairs a Spark builder ``fn(spark, sf_dir) -> DataFrame`` with an
independent DuckDB statement over the same parquet tables (or ``None`` when the
operator is iterative and has no SQL form). Doubles are compared after the
engine-neutral rounding :func:`tidewatch.functions.exprs.fixed4`.

The stand-in projections (``events`` -> transactions, ``orders`` ⟕ ``customer``
-> tie-heavy transactions) only rename columns; see
:mod:`tidewatch.sources.standins`.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import CleaningConfig, FeatureConfig, LabelConfig, SplitConfig
from tidewatch.functions.exprs import fixed4, fixed4_sql as f4
from tidewatch.functions.keys import stable_hash_bucket
from tidewatch.operators import features as feat
from tidewatch.operators import labels as lab
from tidewatch.operators import split as spl
from tidewatch.sources.standins import (EVENTS_TX_SQL, ORDERS_TX_SQL, epoch_seconds, events_transactions,
                                        orders_transactions, table)

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared SQL fragments (DuckDB)
# ---------------------------------------------------------------------------
K = 1 << 20


def _lower(sec: int) -> int:
    return sec * K - K // 2


def keyed_sql(tx_sql: str) -> str:
    return f"""tx AS ({tx_sql}),
keyed AS (SELECT *, coalesce(CAST(card1 AS VARCHAR), '') || '||||||||' AS entity_key,
                 coalesce(DeviceInfo, '') || '||' || coalesce(P_emaildomain, '') || '||' AS fingerprint_key
          FROM (SELECT *, {'P_emaildomain' if 'P_emaildomain' in tx_sql else 'CAST(NULL AS VARCHAR) AS P_emaildomain'}
                FROM tx) t0)"""


def entity_features_sql(tx_sql: str) -> str:
    return f"""WITH {keyed_sql(tx_sql)},
o AS (SELECT *, TransactionDT * {K} + row_number() OVER (PARTITION BY entity_key, TransactionDT
                                                         ORDER BY TransactionID) - 1 AS ord FROM keyed),
l AS (SELECT *, lag(TransactionAmt) OVER (PARTITION BY entity_key ORDER BY ord) AS prev_amt FROM o),
f AS (SELECT TransactionID, TransactionAmt,
             count(TransactionAmt) OVER w1 AS c1, coalesce(sum(TransactionAmt) OVER w1, 0.0) AS s1,
             count(TransactionAmt) OVER w24 AS c24, coalesce(avg(TransactionAmt) OVER w24, 0.0) AS a24,
             coalesce(avg(prev_amt) OVER w7, 0.0) AS m7, coalesce(stddev_pop(prev_amt) OVER w7, 0.0) AS sd7
      FROM l
      WINDOW w1 AS (PARTITION BY entity_key ORDER BY ord RANGE BETWEEN {_lower(3600)} PRECEDING AND CURRENT ROW),
             w24 AS (PARTITION BY entity_key ORDER BY ord RANGE BETWEEN {_lower(86400)} PRECEDING AND CURRENT ROW),
             w7 AS (PARTITION BY entity_key ORDER BY ord RANGE BETWEEN {_lower(604800)} PRECEDING AND CURRENT ROW))
SELECT TransactionID, CAST(c1 AS INTEGER) AS cnt_1h, {f4('s1')} AS sum_amt_1h, CAST(c24 AS INTEGER) AS cnt_24h,
       {f4('a24')} AS avg_amt_24h, {f4('m7')} AS mean_amt_7d_hist, {f4('sd7')} AS std_amt_7d_hist,
       {f4('(TransactionAmt - m7) / nullif(sd7, 0)')} AS z_amt_vs_7d
FROM f"""


def fingerprint_features_sql(tx_sql: str) -> str:
    return f"""WITH {keyed_sql(tx_sql)},
o AS (SELECT *, TransactionDT * {K} + row_number() OVER (PARTITION BY fingerprint_key, TransactionDT
                                                         ORDER BY entity_key, TransactionID) - 1 AS ord FROM keyed),
f AS (SELECT TransactionID, count(TransactionID) OVER w24 AS c24, count(TransactionID) OVER w72 AS c72 FROM o
      WINDOW w24 AS (PARTITION BY fingerprint_key ORDER BY ord RANGE BETWEEN {_lower(86400)} PRECEDING AND CURRENT ROW),
             w72 AS (PARTITION BY fingerprint_key ORDER BY ord RANGE BETWEEN {_lower(259200)} PRECEDING AND CURRENT ROW))
SELECT TransactionID, CAST(c24 AS INTEGER) AS fp_cnt_24h, CAST(c72 AS INTEGER) AS fp_cnt_72h,
       {f4('CAST(CAST(CAST(c24 AS DOUBLE) / nullif(CAST(c72 AS DOUBLE), 0) AS FLOAT) AS DOUBLE)')}
         AS fp_growth_ratio_24h_over_72h
FROM f"""


def label_any_sql(tx_sql: str, h: int = 259200) -> str:
    return f"""WITH {keyed_sql(tx_sql)}
SELECT TransactionID, CAST(coalesce(max(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) OVER (
         PARTITION BY entity_key ORDER BY TransactionDT RANGE BETWEEN 1 FOLLOWING AND {h} FOLLOWING), 0) AS INTEGER)
       AS y_ew_72h
FROM keyed"""


def label_next_sql(tx_sql: str, h: int = 259200) -> str:
    return f"""WITH {keyed_sql(tx_sql)},
n AS (SELECT TransactionID, TransactionDT,
             lead(TransactionDT) OVER w AS nt, lead(coalesce(isFraud, 0)) OVER w AS nf
      FROM keyed WINDOW w AS (PARTITION BY entity_key ORDER BY TransactionDT, TransactionID))
SELECT TransactionID, CAST(CASE WHEN nf = 1 AND nt - TransactionDT > 0 AND nt - TransactionDT <= {h}
                                THEN 1 ELSE 0 END AS INTEGER) AS y_ew_72h
FROM n"""


# ---------------------------------------------------------------------------
# Spark side helpers
# ---------------------------------------------------------------------------
def _tx(spark, sf_dir, src):
    return events_transactions(spark, sf_dir) if src == "events" else orders_transactions(spark, sf_dir)


def _entity(spark, sf_dir, src, cfg=FeatureConfig()):
    tx = feat.add_keys(_tx(spark, sf_dir, src)).select("TransactionID", "TransactionDT", "TransactionAmt", "entity_key")
    d = feat.add_entity_time_features(tx, cfg)
    return d.select("TransactionID", "cnt_1h", *[fixed4(F.col(c)).alias(c) for c in
                                                  ("sum_amt_1h",)], "cnt_24h",
                    *[fixed4(F.col(c)).alias(c) for c in
                      ("avg_amt_24h", "mean_amt_7d_hist", "std_amt_7d_hist", "z_amt_vs_7d")])


def _fingerprint(spark, sf_dir, src, cfg=FeatureConfig()):
    tx = feat.add_keys(_tx(spark, sf_dir, src)).select("TransactionID", "TransactionDT", "entity_key", "fingerprint_key")
    d = feat.add_fingerprint_time_features(tx, cfg)
    return d.select("TransactionID", "fp_cnt_24h", "fp_cnt_72h",
                    fixed4(F.col("fp_growth_ratio_24h_over_72h").cast("double")).alias("fp_growth_ratio_24h_over_72h"))


def _label(spark, sf_dir, src, mode):
    tx = feat.add_keys(_tx(spark, sf_dir, src)).select("TransactionID", "TransactionDT", "isFraud", "entity_key")
    d = lab.make_early_warning_label(tx, LabelConfig(mode=mode))
    return d.select("TransactionID", F.col("y_ew_72h").cast("int").alias("y_ew_72h"))


# ---------------------------------------------------------------------------
# K1-K3 keys
# ---------------------------------------------------------------------------
@register("entity_fingerprint_keys", f"""WITH {keyed_sql(EVENTS_TX_SQL)}
SELECT TransactionID, entity_key, fingerprint_key FROM keyed""")
def q_keys(spark, sf_dir):
    """K1 + K2 on the events stand-in (absent key columns become empty parts)."""
    return feat.add_keys(_tx(spark, sf_dir, "events")).select("TransactionID", "entity_key", "fingerprint_key")


@register("stable_hash_buckets", f"""WITH {keyed_sql(EVENTS_TX_SQL)}
SELECT TransactionID,
       CAST(('0x' || right(md5(entity_key), 5))::BIGINT % 1048576 AS INTEGER) AS entity_bucket,
       CAST(('0x' || right(md5(fingerprint_key), 5))::BIGINT % 262144 AS INTEGER) AS fingerprint_bucket
FROM keyed""")
def q_hash(spark, sf_dir):
    """K3: md5 buckets of the keys (2^20 entity, 2^18 fingerprint)."""
    d = feat.add_keys(_tx(spark, sf_dir, "events"))
    return d.select("TransactionID", stable_hash_bucket("entity_key", 2 ** 20).alias("entity_bucket"),
                    stable_hash_bucket("fingerprint_key", 2 ** 18).alias("fingerprint_bucket"))


# ---------------------------------------------------------------------------
# W1-W12 features
# ---------------------------------------------------------------------------
@register("entity_velocity_features", entity_features_sql(EVENTS_TX_SQL))
def q_entity(spark, sf_dir):
    """W1-W8 per entity on events (chunked event-delta strategy)."""
    return _entity(spark, sf_dir, "events")


@register("entity_velocity_features_ties", entity_features_sql(ORDERS_TX_SQL))
def q_entity_ties(spark, sf_dir):
    """W1-W8 on tie-heavy orders (midnight timestamps, tie-exact frames)."""
    return _entity(spark, sf_dir, "orders")


@register("entity_velocity_features_frame", entity_features_sql(ORDERS_TX_SQL))
def q_entity_frame(spark, sf_dir):
    """W1-W8 on tie-heavy orders with the plain RANGE-frame strategy."""
    return _entity(spark, sf_dir, "orders", FeatureConfig(strategy="frame"))


@register("fingerprint_campaign_features", fingerprint_features_sql(EVENTS_TX_SQL))
def q_fp(spark, sf_dir):
    """W9-W10 per fingerprint on events."""
    return _fingerprint(spark, sf_dir, "events")


@register("fingerprint_campaign_features_ties", fingerprint_features_sql(ORDERS_TX_SQL))
def q_fp_ties(spark, sf_dir):
    """W9-W10 per fingerprint on tie-heavy orders."""
    return _fingerprint(spark, sf_dir, "orders")


# ---------------------------------------------------------------------------
# L1-L3 labels
# ---------------------------------------------------------------------------
@register("early_warning_label_any", label_any_sql(EVENTS_TX_SQL))
def q_label_any(spark, sf_dir):
    """L1: any fraud of the entity in (t, t+72h]."""
    return _label(spark, sf_dir, "events", "any_in_horizon")


@register("early_warning_label_any_ties", label_any_sql(ORDERS_TX_SQL))
def q_label_any_ties(spark, sf_dir):
    """L1 on tie-heavy orders (peers at the same second never count)."""
    return _label(spark, sf_dir, "orders", "any_in_horizon")


@register("early_warning_label_next", label_next_sql(EVENTS_TX_SQL))
def q_label_next(spark, sf_dir):
    """L2: the immediately next row of the entity is a fraud within 72h."""
    return _label(spark, sf_dir, "events", "next_event")


@register("early_warning_label_next_ties", label_next_sql(ORDERS_TX_SQL))
def q_label_next_ties(spark, sf_dir):
    """L2 on tie-heavy orders (a tied next row has dt = 0 -> 0)."""
    return _label(spark, sf_dir, "orders", "next_event")


@register("label_metrics", f"""WITH l AS ({label_any_sql(EVENTS_TX_SQL)})
SELECT CAST(259200 AS BIGINT) AS horizon_seconds, 'y_ew_72h' AS label_name,
       {f4('avg(CAST(y_ew_72h AS DOUBLE)) * 100.0')} AS positive_rate_pct,
       CAST(sum(y_ew_72h) AS BIGINT) AS positive_count, count(*) AS total_rows FROM l""")
def q_label_metrics(spark, sf_dir):
    """L3: horizon, name, positive % / count / total."""
    d = lab.make_early_warning_label(feat.add_keys(_tx(spark, sf_dir, "events")))
    m = lab.label_metrics(d)
    return m.select("horizon_seconds", "label_name", fixed4(F.col("positive_rate_pct")).alias("positive_rate_pct"),
                    "positive_count", "total_rows")


# ---------------------------------------------------------------------------
# SP1-SP2, A12, A13 split
# ---------------------------------------------------------------------------
_CUT_SQL = f"""WITH tx AS ({EVENTS_TX_SQL}),
r AS (SELECT TransactionDT t, row_number() OVER (ORDER BY TransactionDT) - 1 AS i, count(*) OVER () AS n FROM tx
      WHERE TransactionDT IS NOT NULL)
SELECT max(CASE WHEN i = CAST(ceil(0.7 * (n - 1)) AS BIGINT) THEN t END) AS train_end,
       max(CASE WHEN i = CAST(ceil(0.85 * (n - 1)) AS BIGINT) THEN t END) AS valid_end FROM r"""


@register("time_split_cutoffs", _CUT_SQL)
def q_cutoffs(spark, sf_dir):
    """SP1 / A12: "higher" quantiles .70 / .85 of event time (distributed prefix counts)."""
    return spl.cutoffs_frame(_tx(spark, sf_dir, "events"), SplitConfig())


@register("time_split_report", f"""WITH c AS ({_CUT_SQL}), tx AS ({EVENTS_TX_SQL}),
s AS (SELECT CASE WHEN TransactionDT <= train_end THEN 'train' WHEN TransactionDT <= valid_end THEN 'valid'
                  ELSE 'test' END AS split, coalesce(isFraud, 0) AS y FROM tx, c)
SELECT split, count(*) AS count, CAST(sum(y) AS BIGINT) AS positive,
       {f4('avg(CAST(y AS DOUBLE)) * 100.0')} AS positive_rate_pct FROM s GROUP BY split""")
def q_split_report(spark, sf_dir):
    """SP2 + A13: split assignment and per-split count / positives / rate."""
    d = spl.time_split(_tx(spark, sf_dir, "events"))
    r = spl.split_report(d, "split", "isFraud")
    return r.select("split", "count", "positive", fixed4(F.col("positive_rate_pct")).alias("positive_rate_pct"))


# ---------------------------------------------------------------------------
# J1-J2, D1-D2, A1-A10 data stage
# ---------------------------------------------------------------------------
from tidewatch.operators import profile as prof  # noqa: E402

_J1_SQL = """SELECT d.doc_id, md5(d.text) AS text_md5, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def _docs_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return prof.merge_on_transaction_id(docs, table(spark, sf_dir, "labels"), key="doc_id")


@register("left_join_partial_right", _J1_SQL)
def q_join(spark, sf_dir):
    """Left equi-join with partial right coverage (documents ⟕ labels)."""
    return _docs_labels(spark, sf_dir).select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars", "quality", "toxic")


@register("join_coverage", f"""SELECT {f4('avg(CAST(coalesce(quality, toxic) IS NOT NULL AS DOUBLE)) * 100.0')}
       AS rows_with_any_identity_pct FROM ({_J1_SQL}) j""")
def q_coverage(spark, sf_dir):
    """% of rows with any right-side column present."""
    c = prof.identity_coverage(_docs_labels(spark, sf_dir), cols=("quality", "toxic"))
    return c.select(fixed4(F.col("rows_with_any_identity_pct")).alias("rows_with_any_identity_pct"))


@register("missing_pct", f"""WITH j AS ({_J1_SQL})
SELECT column_name AS "column", {f4('missing_pct')} AS missing_pct FROM (
  SELECT 'doc_id' AS column_name, avg(CAST(doc_id IS NULL AS DOUBLE)) * 100.0 AS missing_pct FROM j UNION ALL
  SELECT 'lang', avg(CAST(lang IS NULL AS DOUBLE)) * 100.0 FROM j UNION ALL
  SELECT 'source', avg(CAST(source IS NULL AS DOUBLE)) * 100.0 FROM j UNION ALL
  SELECT 'n_chars', avg(CAST(n_chars IS NULL AS DOUBLE)) * 100.0 FROM j UNION ALL
  SELECT 'quality', avg(CAST(quality IS NULL AS DOUBLE)) * 100.0 FROM j UNION ALL
  SELECT 'toxic', avg(CAST(toxic IS NULL AS DOUBLE)) * 100.0 FROM j) t""")
def q_missing(spark, sf_dir):
    """A1: missing % of every column of the joined table in one aggregate."""
    m = prof.missing_pct(_docs_labels(spark, sf_dir).select("doc_id", "lang", "source", "n_chars",
                                                            "quality", "toxic"))
    return m.select("column", fixed4(F.col("missing_pct")).alias("missing_pct"))


@register("top_missing_columns", f"""WITH j AS ({_J1_SQL}), m AS (
  SELECT 'doc_id' AS c, avg(CAST(doc_id IS NULL AS DOUBLE)) * 100.0 AS v FROM j UNION ALL
  SELECT 'lang', avg(CAST(lang IS NULL AS DOUBLE)) * 100.0 FROM j UNION ALL
  SELECT 'source', avg(CAST(source IS NULL AS DOUBLE)) * 100.0 FROM j UNION ALL
  SELECT 'n_chars', avg(CAST(n_chars IS NULL AS DOUBLE)) * 100.0 FROM j UNION ALL
  SELECT 'quality', avg(CAST(quality IS NULL AS DOUBLE)) * 100.0 FROM j UNION ALL
  SELECT 'toxic', avg(CAST(toxic IS NULL AS DOUBLE)) * 100.0 FROM j)
SELECT c AS "column", {f4('v')} AS missing_pct FROM m ORDER BY v DESC, c LIMIT 3""")
def q_top_missing(spark, sf_dir):
    """A2: top-n missing columns (a top-n report; n = 3 here)."""
    t = prof.top_missing_columns(_docs_labels(spark, sf_dir).select("doc_id", "lang", "source", "n_chars",
                                                                    "quality", "toxic"), n=3)
    return t.select("column", fixed4(F.col("missing_pct")).alias("missing_pct"))


@register("time_coverage", f"""WITH tx AS ({EVENTS_TX_SQL})
SELECT min(TransactionDT) AS transaction_dt_min, max(TransactionDT) AS transaction_dt_max,
       {f4('avg(CAST(TransactionDT IS NULL AS DOUBLE)) * 100.0')} AS transaction_dt_missing_pct FROM tx""")
def q_time_cov(spark, sf_dir):
    """A4: min / max / missing % of the event time."""
    t = prof.time_coverage(_tx(spark, sf_dir, "events"))
    return t.select("transaction_dt_min", "transaction_dt_max",
                    fixed4(F.col("transaction_dt_missing_pct")).alias("transaction_dt_missing_pct"))


@register("label_value_counts", f"""WITH tx AS ({EVENTS_TX_SQL})
SELECT isFraud AS value, count(*) AS count FROM tx GROUP BY isFraud""")
def q_label_counts(spark, sf_dir):
    """A5: label value counts including null."""
    return prof.label_distribution(_tx(spark, sf_dir, "events"))[1]


@register("label_rate", f"""WITH tx AS ({EVENTS_TX_SQL})
SELECT {f4('avg(CAST(isFraud IS NULL AS DOUBLE)) * 100.0')} AS isFraud_missing_pct,
       {f4('avg(CAST(isFraud AS DOUBLE)) * 100.0')} AS isFraud_rate_pct FROM tx""")
def q_label_rate(spark, sf_dir):
    """A5: missing % and positive rate % (missing ignored)."""
    s = prof.label_distribution(_tx(spark, sf_dir, "events"))[0]
    return s.select(*[fixed4(F.col(c)).alias(c) for c in s.columns])


_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("numeric_sanity", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {f4(f'avg(CAST({c} IS NULL AS DOUBLE)) * 100.0')} AS missing_pct,
       {f4(f'min({c})')} AS min, {f4(f'max({c})')} AS max, {f4(f'quantile_cont({c}, 0.5)')} AS p50,
       {f4(f'quantile_cont({c}, 0.95)')} AS p95, {f4(f'quantile_cont({c}, 0.99)')} AS p99 FROM lineitem"""
    for c in _NUM))
def q_numeric(spark, sf_dir):
    """Min / max / exact linear p50 / p95 / p99 per numeric column (distributed prefix counts)."""
    n = prof.numeric_sanity(table(spark, sf_dir, "lineitem"), _NUM)
    return n.select("column", *[fixed4(F.col(c)).alias(c) for c in ("missing_pct", "min", "max", "p50", "p95", "p99")])


@register("top_categories", """WITH l AS (
  SELECT 'event_type' AS "column", coalesce(CAST(event_type AS VARCHAR), '<NA>') AS value FROM events UNION ALL
  SELECT 'props', coalesce(CAST(props AS VARCHAR), '<NA>') FROM events),
c AS (SELECT "column", value, count(*) AS count FROM l GROUP BY ALL)
SELECT "column", value, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS rank FROM c) t
WHERE rank <= 10""")
def q_topcat(spark, sf_dir):
    """Top-10 values per categorical column with an explicit tie rule."""
    t = prof.top_categories(table(spark, sf_dir, "events"), ("event_type", "props"), top_n=10)
    return t.select("column", "value", "count", F.col("rank").cast("int").alias("rank"))


@register("duplicate_key_count", """SELECT count(*) - count(DISTINCT l_orderkey)
       - max(CAST(l_orderkey IS NULL AS INTEGER)) AS duplicate_rows FROM lineitem""")
def q_dupcount(spark, sf_dir):
    """Rows beyond the first per key."""
    return prof.duplicate_count(table(spark, sf_dir, "lineitem"), "l_orderkey")


@register("dedup_keep_first", """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS rn
  FROM lineitem) t
WHERE rn = 1""")
def q_dedup(spark, sf_dir):
    """Keep the first whole row per key by an explicit order (aggregate form, skew-proof)."""
    return prof.drop_duplicates_keep_first(table(spark, sf_dir, "lineitem"), "l_orderkey", ("l_linenumber", "l_partkey", "l_quantity"))


_DIRTY_SQL = f"""SELECT CASE WHEN TransactionID % 17 = 0 THEN NULL ELSE CAST(TransactionID AS VARCHAR) END AS TransactionID,
       CASE WHEN TransactionID % 19 = 0 THEN 'not a time' WHEN TransactionID % 23 = 0 THEN NULL ELSE CAST(TransactionDT AS VARCHAR) END AS TransactionDT,
       CASE WHEN TransactionID % 29 = 0 THEN 'n/a' ELSE CAST(TransactionAmt AS VARCHAR) END AS TransactionAmt, isFraud FROM ({EVENTS_TX_SQL}) t"""


def _dirty(spark, sf_dir):
    """Events as a CSV reader gives them: text columns, with missing ids and times, unreadable values and repeated rows."""
    e = _tx(spark, sf_dir, "events").select("TransactionID", "TransactionDT", "TransactionAmt", "isFraud")
    i = F.col("TransactionID")
    d = e.select(F.when(i % 17 != 0, i.cast("string")).alias("TransactionID"),
                 F.when(i % 19 == 0, F.lit("not a time")).when(i % 23 != 0, F.col("TransactionDT").cast("string")).alias("TransactionDT"),
                 F.when(i % 29 == 0, F.lit("n/a")).otherwise(F.col("TransactionAmt").cast("string")).alias("TransactionAmt"), "isFraud")
    return d.unionByName(d)


@register("cleaning_metrics", f"""WITH d AS ({_DIRTY_SQL}), both_ AS (SELECT * FROM d UNION ALL SELECT * FROM d),
u AS (SELECT * FROM d WHERE TransactionID IS NOT NULL
      UNION ALL (SELECT * FROM d WHERE TransactionID IS NULL ORDER BY TransactionDT NULLS FIRST, TransactionAmt NULLS FIRST, isFraud NULLS FIRST LIMIT 1)),
c AS (SELECT TransactionID, TRY_CAST(TransactionDT AS BIGINT) AS dt, TRY_CAST(TransactionAmt AS DOUBLE) AS amt, isFraud FROM u)
SELECT (SELECT count(*) FROM both_) AS rows_before, 4 AS cols_before, count(*) AS rows_after, 4 AS cols_after,
       {f4('100.0 * avg(CAST(TransactionID IS NULL AS DOUBLE))')} AS missing_TransactionID_pct, {f4('100.0 * avg(CAST(dt IS NULL AS DOUBLE))')} AS missing_TransactionDT_pct,
       {f4('100.0 * avg(CAST(amt IS NULL AS DOUBLE))')} AS missing_TransactionAmt_pct, {f4('100.0 * avg(CAST(isFraud IS NULL AS DOUBLE))')} AS missing_isFraud_pct,
       {f4('avg(CAST(isFraud AS DOUBLE)) * 100.0')} AS label_rate_pct, min(dt) AS transaction_dt_min, max(dt) AS transaction_dt_max FROM c""")
def q_clean(spark, sf_dir):
    """A10: keep-first de-duplication + coercion with the cleaning metrics, on rows with repeats, missing and unreadable values."""
    tx = _dirty(spark, sf_dir)
    m = prof.cleaning_metrics(tx, prof.clean_merged_dataset(tx, CleaningConfig(order_cols=("TransactionDT", "TransactionAmt", "isFraud"))))
    return m.select("rows_before", F.col("cols_before").cast("int").alias("cols_before"), "rows_after",
                    F.col("cols_after").cast("int").alias("cols_after"),
                    *[fixed4(F.col(c)).alias(c) for c in m.columns if c.startswith("missing_")],
                    fixed4(F.col("label_rate_pct")).alias("label_rate_pct"),
                    "transaction_dt_min", "transaction_dt_max")


# ---------------------------------------------------------------------------
# E1-E7 metrics, B1-B4/B6/B7 bands (score = logistic of the event value)
# ---------------------------------------------------------------------------
from tidewatch.config import BandPolicy, DriftConfig  # noqa: E402
from tidewatch.operators import bands as bnd  # noqa: E402
from tidewatch.operators import calibrate as cal  # noqa: E402
from tidewatch.operators import drift as drf  # noqa: E402
from tidewatch.operators import metrics as met  # noqa: E402
from tidewatch.operators import prep  # noqa: E402

_SCORED_SQL = """SELECT event_id AS id, CAST(event_type = 'error' AS INTEGER) AS y,
       (value - 50.0) / 40.0 AS logit, 1.0 / (1.0 + exp(-((value - 50.0) / 40.0))) AS p FROM events"""


def _scored(spark, sf_dir, with_ts: bool = False):
    """Score table: id, label y (event is an error), logit and probability of a fixed scorer."""
    e = table(spark, sf_dir, "events")
    z = (F.col("value") - F.lit(50.0)) / F.lit(40.0)
    return e.select(F.col("event_id").alias("id"), (F.col("event_type") == "error").cast("int").alias("y"),
                    z.alias("logit"), (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("p"),
                    *(["ts"] if with_ts else []))


_CURVE_SQL = f"""WITH s AS ({_SCORED_SQL}),
g AS (SELECT p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
      FROM s WHERE p IS NOT NULL GROUP BY p),
c AS (SELECT *, sum(pos) OVER (ORDER BY p ROWS UNBOUNDED PRECEDING) AS pos_cum,
                sum(neg) OVER (ORDER BY p ROWS UNBOUNDED PRECEDING) AS neg_cum,
                sum(pos) OVER () AS tot_pos, sum(neg) OVER () AS tot_neg FROM g),
k AS (SELECT *, tot_pos - (pos_cum - pos) AS tp, tot_neg - (neg_cum - neg) AS fp FROM c)"""


@register("binary_metrics", f"""{_CURVE_SQL}
SELECT {f4('sum(pos * (neg_cum - neg + neg / 2.0)) / (max(tot_pos) * max(tot_neg))')} AS auc_roc,
       {f4('sum(CASE WHEN pos > 0 THEN pos / tot_pos * tp / (tp + fp) END)')} AS avg_precision,
       (SELECT {f4('avg(power(p - y, 2))')} FROM s) AS brier FROM k""")
def q_binary(spark, sf_dir):
    """E1 + E5: tie-exact AUC (ties = 1/2), step-sum average precision, Brier."""
    m = met.binary_metrics(_scored(spark, sf_dir))
    return m.select(*[fixed4(F.col(c)).alias(c) for c in ("auc_roc", "avg_precision", "brier")])


@register("pr_curve", f"""{_CURVE_SQL}
SELECT {f4('p')} AS threshold, {f4('tp / (tp + fp)')} AS precision, {f4('tp / tot_pos')} AS recall,
       {f4('tot_pos / (tot_pos + tot_neg)')} AS base_rate FROM k""")
def q_pr(spark, sf_dir):
    """Precision / recall per distinct threshold."""
    c = met.pr_curve(_scored(spark, sf_dir))
    return c.select(*[fixed4(F.col(x)).alias(x) for x in ("threshold", "precision", "recall", "base_rate")])


@register("best_f1_threshold", f"""{_CURVE_SQL},
cand AS (SELECT *, 2 * (tp / (tp + fp)) * (tp / tot_pos) / ((tp / (tp + fp)) + (tp / tot_pos) + 1e-12) AS f1 FROM k
         WHERE p >= (SELECT min(p) FROM k WHERE pos > 0))
SELECT {f4('p')} AS best_threshold, {f4('f1')} AS best_f1, {f4('tp / (tp + fp)')} AS precision_at_best,
       {f4('tp / tot_pos')} AS recall_at_best FROM cand ORDER BY f1 DESC, p LIMIT 1""")
def q_f1(spark, sf_dir):
    """The F1-optimal threshold (true optimum; compat mode gives the previous one)."""
    b = met.best_f1_threshold(_scored(spark, sf_dir))
    return b.select(*[fixed4(F.col(c)).alias(c) for c in b.columns])


@register("lift_at_k", f"""WITH s AS ({_SCORED_SQL}),
r AS (SELECT y, row_number() OVER (ORDER BY p DESC, id) AS rn FROM s),
t AS (SELECT count(*) AS n, sum(y) AS P FROM s),
k AS (SELECT pct, greatest(1, CAST(floor(n * pct / 100.0) AS BIGINT)) AS k, n, P
      FROM (VALUES (1.0), (3.0), (8.0)) v(pct), t)
SELECT pct AS top_pct, k.k AS k, {f4('sum(r.y) / k.k')} AS precision, {f4('sum(r.y) / greatest(max(P), 1)')} AS recall,
       {f4('(sum(r.y) / k.k) / greatest(max(P) / max(n), 1e-12)')} AS lift
FROM k JOIN r ON r.rn <= k.k GROUP BY pct, k.k""")
def q_lift(spark, sf_dir):
    """Precision / recall / lift of the top 1 / 3 / 8 % (score desc, id asc)."""
    lf = met.lift_at_k(_scored(spark, sf_dir), (1, 3, 8))
    return lf.select("top_pct", "k", *[fixed4(F.col(c)).alias(c) for c in ("precision", "recall", "lift")])


@register("log_loss", f"""WITH s AS ({_SCORED_SQL})
SELECT {f4('avg(-(y * ln(least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) + (1 - y) * ln(1 - least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))))')} AS log_loss FROM s""")
def q_logloss(spark, sf_dir):
    """Clipped binary log-loss."""
    return met.log_loss(_scored(spark, sf_dir)).select(fixed4(F.col("log_loss")).alias("log_loss"))


@register("reliability_curve", f"""WITH s AS ({_SCORED_SQL}),
e AS (SELECT quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM s),
b AS (SELECT y, p, CAST(len(list_filter(edges, lambda x: x < p)) AS INTEGER) AS bin FROM s, e)
SELECT bin, {f4('avg(CAST(y AS DOUBLE))')} AS prob_true, {f4('avg(p)')} AS prob_pred, count(*) AS count
FROM b GROUP BY bin""")
def q_reliability(spark, sf_dir):
    """10 quantile bins, mean label vs mean score."""
    r = met.reliability_curve(_scored(spark, sf_dir), 10)
    return r.select(F.col("bin").cast("int").alias("bin"), fixed4(F.col("prob_true")).alias("prob_true"),
                    fixed4(F.col("prob_pred")).alias("prob_pred"), "count")


_CUTS_SQL = f"""SELECT quantile_cont(p, 0.99) AS critical, quantile_cont(p, 0.97) AS high,
       quantile_cont(p, 0.92) AS medium FROM ({_SCORED_SQL}) s"""
_BANDED_SQL = f"""SELECT s.*, CASE WHEN p IS NULL OR isnan(p) THEN 'low' WHEN p >= critical THEN 'critical'
                   WHEN p >= high THEN 'high' WHEN p >= medium THEN 'medium' ELSE 'low' END AS risk_band
FROM ({_SCORED_SQL}) s, ({_CUTS_SQL}) c"""


def _banded(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumnRenamed("p", "score")
    return bnd.assign_risk_band(s, bnd.band_cutoffs(s, BandPolicy()))


@register("band_cutoffs", f"""SELECT {f4('critical')} AS critical, {f4('high')} AS high, {f4('medium')} AS medium
FROM ({_CUTS_SQL}) c""")
def q_cutoffs_b(spark, sf_dir):
    """B1: capacity cutoffs = exact linear quantiles at 99 / 97 / 92 %."""
    s = _scored(spark, sf_dir).withColumnRenamed("p", "score")
    c = bnd.band_cutoffs(s, BandPolicy())
    return c.select(*[fixed4(F.col(x)).alias(x) for x in ("critical", "high", "medium")])


@register("risk_bands", f"SELECT id, risk_band FROM ({_BANDED_SQL}) b")
def q_bands(spark, sf_dir):
    """B2: band per row (NaN / null -> low)."""
    return _banded(spark, sf_dir).select("id", "risk_band")


@register("band_summary", f"""WITH b AS ({_BANDED_SQL}),
o AS (SELECT * FROM (VALUES ('critical', 0), ('high', 1), ('medium', 2), ('low', 3)) v(risk_band, band_rank)),
per AS (SELECT risk_band, count(*) AS cnt, sum(y) AS positives FROM b GROUP BY risk_band),
d AS (SELECT o.risk_band, o.band_rank, per.cnt, per.positives FROM o LEFT JOIN per USING (risk_band)),
c AS (SELECT *, sum(coalesce(cnt, 0)) OVER (ORDER BY band_rank) AS cum_rows,
                sum(coalesce(positives, 0)) OVER (ORDER BY band_rank) AS cum_pos,
                sum(coalesce(cnt, 0)) OVER () AS total_rows, sum(coalesce(positives, 0)) OVER () AS total_pos FROM d)
SELECT risk_band, CAST(band_rank AS INTEGER) AS band_rank, cnt AS count, CAST(positives AS BIGINT) AS positives,
       {f4('positives / cnt')} AS precision, CAST(cum_rows AS BIGINT) AS cum_rows,
       CAST(cum_pos AS BIGINT) AS cum_captured_pos, {f4('100.0 * cum_rows / total_rows')} AS cum_rows_pct,
       {f4('cum_pos / total_pos')} AS cum_recall, {f4('cum_pos / cum_rows')} AS cum_precision FROM c""")
def q_band_summary(spark, sf_dir):
    """B4 (A14 + A15): per-band precision and the cumulative review funnel."""
    s = bnd.band_summary(_banded(spark, sf_dir), label_col="y")
    return s.select("risk_band", F.col("band_rank").cast("int").alias("band_rank"), "count", "positives",
                    fixed4(F.col("precision")).alias("precision"), "cum_rows", "cum_captured_pos",
                    *[fixed4(F.col(c)).alias(c) for c in ("cum_rows_pct", "cum_recall", "cum_precision")])


@register("exact_capacity_bands", f"""WITH s AS ({_SCORED_SQL}),
r AS (SELECT id, row_number() OVER (ORDER BY p DESC, id) AS rk, count(*) OVER () AS n FROM s)
SELECT id, CASE WHEN rk <= CAST(floor(n * 0.01) AS BIGINT) THEN 'critical'
                WHEN rk <= CAST(floor(n * 0.03) AS BIGINT) THEN 'high'
                WHEN rk <= CAST(floor(n * 0.08) AS BIGINT) THEN 'medium' ELSE 'low' END AS risk_band FROM r""")
def q_exact_bands(spark, sf_dir):
    """Exactly int(n * pct) rows in the cumulative top bands (rank by score desc, id)."""
    s = _scored(spark, sf_dir).withColumnRenamed("p", "score")
    return bnd.exact_capacity_bands(s, BandPolicy(policy="exact_k"), "score", "id").select("id", "risk_band")


@register("serving_bands", f"""WITH s AS ({_SCORED_SQL}), t AS (SELECT *, 1.0 / (1.0 + exp(-logit / 1.5)) AS cp FROM s)
SELECT id, round(p, 6) AS raw_fraud_probability, round(cp, 6) AS calibrated_fraud_probability,
       CASE WHEN cp >= 0.9528 THEN 'critical' WHEN cp >= 0.9121 THEN 'high' WHEN cp >= 0.7430 THEN 'medium'
            ELSE 'low' END AS risk_band,
       CASE WHEN cp >= 0.9528 THEN 'BLOCK_AND_REVIEW — Immediate manual review required'
            WHEN cp >= 0.9121 THEN 'STEP_UP_AUTH — Request additional authentication'
            WHEN cp >= 0.7430 THEN 'MONITOR — Flag for delayed review; apply additional rules'
            ELSE 'APPROVE — Auto-approve with standard monitoring' END AS recommended_action FROM t""")
def q_serving(spark, sf_dir):
    """B6 + B7 + M11: temperature-scaled score, frozen cutoffs, band and action per row."""
    s = cal.apply_temperature(_scored(spark, sf_dir), 1.5, "logit", "score").withColumnRenamed("p", "raw_score")
    b = bnd.serving_bands(s, "raw_score", "score")
    return b.select("id", "raw_fraud_probability", "calibrated_fraud_probability", "risk_band", "recommended_action")


# ---------------------------------------------------------------------------
# DR1-DR8 drift: lineitem shipped before 1998 (reference) vs from 1998 (current)
# ---------------------------------------------------------------------------
_DRIFT_FEATS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_REF_SQL = "SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'"
_CUR_SQL = "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'"


def _ref_cur(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    return li.filter(F.col("l_shipdate") < cut), li.filter(F.col("l_shipdate") >= cut)


def _long_sql(src: str, side: int) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {side} AS side FROM ({src}) x"
                              for c in _DRIFT_FEATS)


_ECDF_SQL = f"""l AS ({_long_sql(_REF_SQL, 0)} UNION ALL {_long_sql(_CUR_SQL, 1)}),
g AS (SELECT feature, value, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS r,
             sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c FROM l WHERE value IS NOT NULL GROUP BY feature, value),
e AS (SELECT *, sum(r) OVER w AS r_cum, sum(c) OVER w AS c_cum, sum(r) OVER (PARTITION BY feature) AS r_total,
             sum(c) OVER (PARTITION BY feature) AS c_total, lead(value) OVER (PARTITION BY feature ORDER BY value) AS nxt
      FROM g WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING))"""


@register("ks_drift", f"""WITH {_ECDF_SQL},
k AS (SELECT feature, max(abs(r_cum / r_total - c_cum / c_total)) AS d, max(r_total) AS n, max(c_total) AS m,
             sum(value * r) / max(r_total) AS ref_mean, sum(value * c) / max(c_total) AS cur_mean FROM e GROUP BY feature),
lam AS (SELECT *, (sqrt(n * m / (n + m)) + 0.12 + 0.11 / sqrt(n * m / (n + m))) * d AS lam FROM k),
p AS (SELECT feature, CASE WHEN lam < 1e-3 THEN 1.0 ELSE
        least(greatest(2.0 * (SELECT sum(power(-1.0, i - 1) * exp(-2.0 * i * i * lam * lam)) FROM range(1, 101) t(i)), 0.0), 1.0)
        END AS pv FROM lam)
SELECT k.feature, round(d, 4) AS ks_statistic, round(pv, 4) AS p_value, pv < 0.05 AS drift_detected,
       round(ref_mean, 4) AS ref_mean, round(cur_mean, 4) AS current_mean,
       round(abs(cur_mean - ref_mean) / (abs(ref_mean) + 1e-9) * 100.0, 2) AS mean_change_pct,
       n AS n_ref, m AS n_cur FROM k JOIN p USING (feature)""")
def q_ks(spark, sf_dir):
    """DR1 + DR2: two-sample KS (D, asymptotic p), drift flag, mean shift, all features in one plan."""
    ref, cur = _ref_cur(spark, sf_dir)
    return drf.ks_drift(ref, cur, DriftConfig(features=_DRIFT_FEATS, p_method="limiting"))


@register("wasserstein_drift", f"""WITH {_ECDF_SQL},
sd AS (SELECT feature, stddev_pop(value) AS sd FROM ({_long_sql(_REF_SQL, 0)}) x GROUP BY feature),
w AS (SELECT feature, sum(coalesce(abs(r_cum / r_total - c_cum / c_total) * (nxt - value), 0.0)) AS w FROM e GROUP BY feature)
SELECT feature, {f4('w')} AS wasserstein, {f4('w / nullif(sd, 0)')} AS wasserstein_norm FROM w JOIN sd USING (feature)""")
def q_wasserstein(spark, sf_dir):
    """DR4: 1-Wasserstein distance per feature, raw and reference-std normalised."""
    ref, cur = _ref_cur(spark, sf_dir)
    w = drf.wasserstein(ref, cur, _DRIFT_FEATS)
    return w.select("feature", fixed4(F.col("wasserstein")).alias("wasserstein"),
                    fixed4(F.col("wasserstein_norm")).alias("wasserstein_norm"))


_SPLIT_REF, _SPLIT_CUR = "SELECT * FROM lineitem WHERE l_quantity <= 30", "SELECT * FROM lineitem WHERE l_quantity > 30"
_SPLIT_ECDF_SQL = _ECDF_SQL.replace(_REF_SQL, _SPLIT_REF).replace(_CUR_SQL, _SPLIT_CUR)


@register("drift_summary", f"""WITH {_SPLIT_ECDF_SQL},
k AS (SELECT feature, max(abs(r_cum / r_total - c_cum / c_total)) AS d, max(r_total) AS n, max(c_total) AS m FROM e GROUP BY feature),
lam AS (SELECT *, (sqrt(n * m / (n + m)) + 0.12 + 0.11 / sqrt(n * m / (n + m))) * d AS lam FROM k),
p AS (SELECT feature, CASE WHEN lam < 1e-3 THEN 1.0 ELSE
        least(greatest(2.0 * (SELECT sum(power(-1.0, i - 1) * exp(-2.0 * i * i * lam * lam)) FROM range(1, 101) t(i)), 0.0), 1.0)
        END AS pv FROM lam)
SELECT CAST(4 AS INTEGER) AS n_features_monitored, CAST(count(*) FILTER (pv < 0.05) AS BIGINT) AS n_features_drifted,
       round(count(*) FILTER (pv < 0.05) / 4.0, 3) AS drift_share, string_agg(feature, ',' ORDER BY feature) FILTER (pv < 0.05) AS drifted,
       {DriftConfig().drift_share_alert} AS alert_drift_threshold, count(*) FILTER (pv < 0.05) / 4.0 > {DriftConfig().drift_share_alert} AS global_alert FROM p""")
def q_drift_summary(spark, sf_dir):
    """DR6: share of drifted features and the global alert; small against large quantities, so that some drift and some don't."""
    li = table(spark, sf_dir, "lineitem")
    ref, cur = li.filter("l_quantity <= 30"), li.filter("l_quantity > 30")
    cfg = DriftConfig(features=_DRIFT_FEATS, p_method="limiting")
    s = drf.drift_summary(drf.ks_drift(ref, cur, cfg), ref, cfg)
    return s.select("n_features_monitored", "n_features_drifted", "drift_share", F.array_join("drifted_features", ",").alias("drifted"),
                    "alert_drift_threshold", "global_alert")


@register("psi_js_drift", f"""WITH r AS ({_long_sql(_REF_SQL, 0)}), c AS ({_long_sql(_CUR_SQL, 1)}),
e AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM r
      WHERE value IS NOT NULL GROUP BY feature),
b AS (SELECT x.feature, side, len(list_filter(edges, lambda t: t < value)) AS bin
      FROM (SELECT * FROM r UNION ALL SELECT * FROM c) x JOIN e USING (feature) WHERE value IS NOT NULL),
h AS (SELECT feature, bin, sum(CASE WHEN side = 0 THEN 1.0 ELSE 0.0 END) AS rr,
             sum(CASE WHEN side = 1 THEN 1.0 ELSE 0.0 END) AS cc FROM b GROUP BY feature, bin),
p AS (SELECT feature, rr / sum(rr) OVER (PARTITION BY feature) + 1e-6 AS pr,
             cc / sum(cc) OVER (PARTITION BY feature) + 1e-6 AS pc FROM h)
SELECT feature, {f4('sum((pc - pr) * ln(pc / pr))')} AS psi,
       {f4('0.5 * sum(pr * ln(pr / ((pr + pc) / 2))) + 0.5 * sum(pc * ln(pc / ((pr + pc) / 2)))')} AS js_divergence
FROM p GROUP BY feature""")
def q_psi(spark, sf_dir):
    """DR7: PSI and Jensen-Shannon divergence on reference-decile bins."""
    ref, cur = _ref_cur(spark, sf_dir)
    p = drf.psi_js(ref, cur, _DRIFT_FEATS)
    return p.select("feature", fixed4(F.col("psi")).alias("psi"), fixed4(F.col("js_divergence")).alias("js_divergence"))


@register("data_quality", f"""WITH l AS ({_long_sql(_REF_SQL, 0)} UNION ALL {_long_sql(_CUR_SQL, 1)})
SELECT feature, CASE WHEN side = 0 THEN 'reference' ELSE 'current' END AS side, count(*) AS count,
       CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
       {f4('min(value)')} AS min, {f4('max(value)')} AS max, {f4('avg(value)')} AS mean, {f4('stddev_samp(value)')} AS std,
       {f4('quantile_cont(value, 0.25)')} AS p25, {f4('quantile_cont(value, 0.5)')} AS p50,
       {f4('quantile_cont(value, 0.75)')} AS p75 FROM l GROUP BY feature, side""")
def q_quality(spark, sf_dir):
    """DR8: per feature and side: count, missing, min/max/mean/std and quartiles."""
    ref, cur = _ref_cur(spark, sf_dir)
    q = drf.data_quality(ref, cur, _DRIFT_FEATS)
    return q.select("feature", "side", "count", "missing",
                    *[fixed4(F.col(c)).alias(c) for c in ("min", "max", "mean", "std", "p25", "p50", "p75")])


@register("score_and_label_drift", f"""WITH s AS ({_SCORED_SQL}), t AS (SELECT s.*, e.ts FROM s JOIN events e ON e.event_id = s.id),
r AS (SELECT avg(p) AS rs, avg(CAST(y AS DOUBLE)) AS ry FROM t WHERE ts < TIMESTAMP '2024-01-21'),
c AS (SELECT avg(p) AS cs, avg(CAST(y AS DOUBLE)) AS cy FROM t WHERE ts >= TIMESTAMP '2024-01-21')
SELECT {f4('rs')} AS reference_mean_score, {f4('cs')} AS current_mean_score, {f4('abs(cs - rs)')} AS score_shift,
       abs(cs - rs) > 0.05 AS score_alert, {f4('ry')} AS reference_positive_rate, {f4('cy')} AS current_positive_rate,
       {f4('abs(cy - ry)')} AS label_shift FROM r, c""")
def q_score_label_drift(spark, sf_dir):
    """DR3 + DR5: mean-score shift (reference mean from the data) and positive-rate shift."""
    s = _scored(spark, sf_dir, with_ts=True).withColumnRenamed("p", "score")
    cut = F.lit("2024-01-21 00:00:00").cast("timestamp_ntz")
    ref, cur = s.filter(F.col("ts") < cut), s.filter(F.col("ts") >= cut)
    sc = drf.score_shift(cur, ref, DriftConfig(), rounded=False)
    lb = drf.label_drift(ref, cur, "y", rounded=False).withColumnRenamed("absolute_shift", "_label_shift")
    return sc.crossJoin(lb).select(
        fixed4(F.col("reference_mean_score")).alias("reference_mean_score"),
        fixed4(F.col("current_mean_score")).alias("current_mean_score"),
        fixed4(F.col("absolute_shift")).alias("score_shift"), F.col("alert").alias("score_alert"),
        fixed4(F.col("reference_positive_rate")).alias("reference_positive_rate"),
        fixed4(F.col("current_positive_rate")).alias("current_positive_rate"),
        fixed4(F.col("_label_shift")).alias("label_shift"))


# ---------------------------------------------------------------------------
# M1, M2, M4, M5, M9 preprocessing; M12 calibration report
# ---------------------------------------------------------------------------
@register("standardizer_fit", "SELECT " + ", ".join(
    f"{f4(f'avg({c})')} AS {c}__mean, {f4(f'coalesce(nullif(stddev_pop({c}), 0), 1.0)')} AS {c}__std"
    for c in _DRIFT_FEATS) + " FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'")
def q_std_fit(spark, sf_dir):
    """M1: train-only mean / population std (std 0 -> 1)."""
    ref, _ = _ref_cur(spark, sf_dir)
    st = prep.fit_standardizer(ref, _DRIFT_FEATS)
    return st.select(*[fixed4(F.col(c)).alias(c) for c in st.columns])


@register("standardize_transform", "WITH s AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1.0) AS s_{c}" for c in _DRIFT_FEATS)
    + " FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01') SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(f"{f4(f'CAST(CAST(coalesce(({c} - m_{c}) / s_{c}, 0.0) AS FLOAT) AS DOUBLE)')} AS {c}"
                for c in _DRIFT_FEATS) + " FROM lineitem, s WHERE l_shipdate >= TIMESTAMP '1998-01-01'")
def q_std_apply(spark, sf_dir):
    """M2: scale current rows with train statistics; missing -> 0 after scaling; float32."""
    ref, cur = _ref_cur(spark, sf_dir)
    t = prep.transform_numeric(cur.select("l_orderkey", "l_linenumber", "l_partkey", *_DRIFT_FEATS),
                               prep.fit_standardizer(ref, _DRIFT_FEATS), _DRIFT_FEATS)
    return t.select("l_orderkey", "l_linenumber", "l_partkey",
                    *[fixed4(F.col(c).cast("double")).alias(c) for c in _DRIFT_FEATS])


@register("median_scaler_fit", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {f4(f'quantile_cont({c}, 0.5)')} AS median,
       {f4(f'coalesce(nullif(stddev_pop(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM lineitem))), 0), 1.0)')}
       AS scale FROM lineitem""" for c in _DRIFT_FEATS))
def q_median(spark, sf_dir):
    """M4: exact median for imputation and population std of the imputed column."""
    m = prep.fit_median_scaler(table(spark, sf_dir, "lineitem"), _DRIFT_FEATS)
    return m.select("feature", fixed4(F.col("median")).alias("median"), fixed4(F.col("scale")).alias("scale"))


@register("category_modes", """WITH l AS (SELECT 'l_returnflag' AS feature, l_returnflag AS value FROM lineitem UNION ALL
  SELECT 'l_linestatus', l_linestatus FROM lineitem UNION ALL SELECT 'o_orderpriority', NULL WHERE false),
c AS (SELECT feature, value, count(*) AS n FROM l WHERE value IS NOT NULL GROUP BY ALL)
SELECT feature, min(value) AS mode FROM c WHERE n = (SELECT max(n) FROM c c2 WHERE c2.feature = c.feature)
GROUP BY feature""")
def q_modes(spark, sf_dir):
    """M5: most frequent value per categorical column (ties -> smallest)."""
    return prep.fit_modes(table(spark, sf_dir, "lineitem"), ("l_returnflag", "l_linestatus"))


@register("class_weights", f"""WITH tx AS ({EVENTS_TX_SQL}),
a AS (SELECT count(*) AS n, sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN isFraud = 1 THEN 0 ELSE 1 END) AS neg FROM tx)
SELECT n, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, {f4('neg / greatest(pos, 1)')} AS pos_weight,
       {f4('n / (2.0 * pos)')} AS w_pos, {f4('n / (2.0 * neg)')} AS w_neg FROM a""")
def q_weights(spark, sf_dir):
    """M9: neg/pos weight and balanced class weights."""
    w = prep.class_weights(_tx(spark, sf_dir, "events"), "isFraud")
    return w.select("n", "pos", "neg", *[fixed4(F.col(c)).alias(c) for c in ("pos_weight", "w_pos", "w_neg")])


@register("calibration_report", f"""WITH s AS ({_SCORED_SQL}),
t AS (SELECT y, 1.0 / (1.0 + exp(-logit)) AS p0, 1.0 / (1.0 + exp(-logit / 1.5)) AS p1 FROM s)
SELECT 1.5 AS temperature, {f4('avg(power(p0 - y, 2))')} AS brier_before, {f4('avg(power(p1 - y, 2))')} AS brier_after,
       {f4('avg(-(y * ln(least(greatest(p0, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) + (1 - y) * ln(1 - least(greatest(p0, 2.220446049250313e-16), 1 - 2.220446049250313e-16))))')} AS logloss_before,
       {f4('avg(-(y * ln(least(greatest(p1, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) + (1 - y) * ln(1 - least(greatest(p1, 2.220446049250313e-16), 1 - 2.220446049250313e-16))))')} AS logloss_after
FROM t""")
def q_calrep(spark, sf_dir):
    """M11 + M12: Brier and log-loss before / after a temperature (T = 1.5)."""
    r = cal.calibration_report(_scored(spark, sf_dir), 1.5, "logit", "y")
    return r.select(*[fixed4(F.col(c)).alias(c) for c in r.columns])


def _temperature_sql(passes: int = 4, grid: int = 33, lo: float = 0.05, hi: float = 20.0) -> str:
    """The grid zoom of M10 as a chain of tables."""
    out = f"WITH s AS ({_SCORED_SQL}), r0 AS (SELECT ln({lo}) AS a, ln({hi}) AS b)"
    for k in range(1, passes + 1):
        out += f""",
g{k} AS (SELECT exp(a + (b - a) * i / {grid - 1}.0) AS T, (b - a) / {grid - 1}.0 AS step FROM r{k - 1}, range(0, {grid}) t(i)),
n{k} AS (SELECT T, step, avg(greatest(logit / T, 0.0) - logit / T * y + ln(1 + exp(-abs(logit / T)))) AS nll FROM g{k}, s GROUP BY T, step),
b{k} AS (SELECT T, step FROM n{k} ORDER BY nll, T LIMIT 1),
r{k} AS (SELECT ln(T) - 2 * step AS a, ln(T) + 2 * step AS b FROM b{k})"""
    return out + f" SELECT {f4('T')} AS temperature FROM b{passes}"


@register("temperature_fit", _temperature_sql())
def q_tfit(spark, sf_dir):
    """Fit T on the events score by a grid that zooms in."""
    s = _scored(spark, sf_dir)
    t = cal.fit_temperature(s, "logit", "y")
    return cal.calibration_report(s, t, "logit", "y").select(fixed4(F.col("temperature")).alias("temperature"))


# ---------------------------------------------------------------------------
# ST1-ST4 Structured Streaming (file stream over the driver table, availableNow)
# ---------------------------------------------------------------------------
from tidewatch.streaming import online as st  # noqa: E402


@register("online_scoring_stream", f"""WITH s AS ({_SCORED_SQL}), t AS (SELECT *, 1.0 / (1.0 + exp(-logit / 1.5)) AS cp FROM s)
SELECT id, {f4('cp')} AS score,
       CASE WHEN cp >= 0.9528 THEN 'critical' WHEN cp >= 0.9121 THEN 'high' WHEN cp >= 0.7430 THEN 'medium'
            ELSE 'low' END AS risk_band FROM t""")
def q_stream_score(spark, sf_dir):
    """ST1: stream of events -> temperature-scaled score -> frozen cutoffs -> band."""
    ev = st.stream_table(spark, sf_dir, "events")

    def scorer(d):
        z = (F.col("value") - F.lit(50.0)) / F.lit(40.0)
        return cal.apply_temperature(d.withColumn("logit", z), 1.5, "logit", "score")

    s = st.score_stream(ev, scorer)
    out = st.run_to_table(s.select(F.col("event_id").alias("id"), "score", "risk_band"), "st1")
    return out.select("id", fixed4(F.col("score")).alias("score"), "risk_band")


def _velocity(stream, name, delay):
    v = st.velocity_stream(stream, "user_id", "ts", "event_id", "value", delay=delay)
    return st.run_to_latest(v, name, ["key", "id"]).select(
        F.col("id").alias("TransactionID"), "cnt_1h", fixed4(F.col("sum_amt_1h")).alias("sum_amt_1h"), "cnt_24h",
        *[fixed4(F.col(c)).alias(c) for c in ("avg_amt_24h", "mean_amt_7d_hist", "std_amt_7d_hist", "z_amt_vs_7d")])


@register("online_velocity_stream", entity_features_sql(EVENTS_TX_SQL))
def q_stream_velocity(spark, sf_dir):
    """ST2: stateful per-key velocity features over the event stream; late rows would differ from the batch SQL."""
    return _velocity(st.stream_table(spark, sf_dir, "events"), "st2", "1 day")


_ARRIVAL_DELAY = 216000      # 2.5 days; rows arrive up to four days after their time, in eight files
_ARRIVED_SQL = f"""SELECT *, max(TransactionDT) OVER (ORDER BY part RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {_ARRIVAL_DELAY} AS mark FROM (
  SELECT *, CAST(least(7, floor((TransactionDT - min(TransactionDT) OVER () + TransactionID % 5 * 86400) / 345600.0)) AS INTEGER) AS part FROM ({EVENTS_TX_SQL}) e0) e1"""
_ON_TIME_SQL = f"SELECT TransactionID, TransactionDT, TransactionAmt, isFraud, card1, DeviceInfo, P_emaildomain FROM ({_ARRIVED_SQL}) e2 WHERE mark IS NULL OR TransactionDT >= mark"
_LATE_SQL = f"SELECT TransactionID FROM ({_ARRIVED_SQL}) e2 WHERE TransactionDT < mark"


def _arriving(spark, sf_dir):
    """The events as a stream of eight files, one a micro-batch, in the order in which they were written; within and across files rows are out of order."""
    import os
    import uuid

    from tidewatch.session import checkpoint_dir
    base = os.path.join(checkpoint_dir(spark), "tables", f"arriving-{uuid.uuid4().hex}")
    e = table(spark, sf_dir, "events")
    t = epoch_seconds("ts")
    start = e.agg(F.min(t)).first()[0]
    part = F.least(F.lit(7), F.floor((t - F.lit(start) + F.col("event_id") % 5 * 86400) / 345600.0).cast("int"))
    for k in range(8):
        e.filter(part == k).orderBy(F.xxhash64("event_id")).coalesce(1).write.mode("append").parquet(base)
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(base)


_VELOCITY_COLUMNS = ("cnt_1h", "sum_amt_1h", "cnt_24h", "avg_amt_24h", "mean_amt_7d_hist", "std_amt_7d_hist", "z_amt_vs_7d")
_CAMPAIGN_COLUMNS = ("fp_cnt_24h", "fp_cnt_72h", "fp_growth_ratio_24h_over_72h")


def _with_late_sql(features: str, columns) -> str:
    return f"""SELECT TransactionID, {', '.join(columns)}, false AS late FROM ({features}) f
UNION ALL SELECT TransactionID, {', '.join('NULL' for _ in columns)}, true FROM ({_LATE_SQL}) l"""


@register("online_velocity_stream_disorder", _with_late_sql(entity_features_sql(_ON_TIME_SQL), _VELOCITY_COLUMNS))
def q_stream_velocity_disorder(spark, sf_dir):
    """ST2, W1-W8 over eight micro-batches out of order: rows behind the watermark come out late, old state is evicted, rows that are out already are corrected."""
    v = st.velocity_stream(_arriving(spark, sf_dir), "user_id", "ts", "event_id", "value", delay=f"{_ARRIVAL_DELAY} seconds")
    d = st.run_to_latest(v, "st2-disorder", ["key", "id"])
    return d.select(F.col("id").alias("TransactionID"), *[F.col(c) if c.startswith("cnt") else fixed4(F.col(c)).alias(c) for c in _VELOCITY_COLUMNS], "late")


@register("online_campaign_stream_disorder", _with_late_sql(fingerprint_features_sql(_ON_TIME_SQL), _CAMPAIGN_COLUMNS))
def q_stream_campaign_disorder(spark, sf_dir):
    """ST2, W9-W10 per fingerprint over the same eight micro-batches."""
    e = _arriving(spark, sf_dir).withColumnsRenamed({"user_id": "card1", "event_type": "DeviceInfo", "props": "P_emaildomain"})
    v = st.campaign_stream(feat.add_keys(e), "fingerprint_key", "ts", "event_id", "entity_key", delay=f"{_ARRIVAL_DELAY} seconds")
    d = st.run_to_latest(v, "st2-campaign", ["key", "id"])
    return d.select(F.col("id").alias("TransactionID"), "fp_cnt_24h", "fp_cnt_72h",
                    fixed4(F.col("fp_growth_ratio_24h_over_72h").cast("double")).alias("fp_growth_ratio_24h_over_72h"), "late")


@register("dedup_stream", "SELECT event_id, user_id, event_type, value FROM events")
def q_stream_dedup(spark, sf_dir):
    """ST3: whole rows of a stream in which every event comes twice, kept once within an hour's watermark."""
    import os
    import uuid

    from tidewatch.session import checkpoint_dir
    base = os.path.join(checkpoint_dir(spark), "tables", f"twice-{uuid.uuid4().hex}")
    e = table(spark, sf_dir, "events")
    e.unionByName(e).repartition(4).write.parquet(base)
    stream = spark.readStream.schema(e.schema).parquet(base).withColumn("_ts", F.timestamp_seconds(epoch_seconds("ts")))
    return st.run_to_table(st.dedup_stream(stream, "event_id", "_ts", "1 hour").select("event_id", "user_id", "event_type", "value"), "st3")


@register("band_traffic_stream", f"""WITH s AS ({_SCORED_SQL}),
t AS (SELECT e.ts, s.y, 1.0 / (1.0 + exp(-s.logit / 1.5)) AS cp FROM s JOIN events e ON e.event_id = s.id),
b AS (SELECT ts, y, CASE WHEN cp >= 0.9528 THEN 'critical' WHEN cp >= 0.9121 THEN 'high' WHEN cp >= 0.7430 THEN 'medium'
             ELSE 'low' END AS risk_band FROM t),
w AS (SELECT unnest(range(0, 6)) AS k),
x AS (SELECT risk_band, y, CAST(floor(epoch(ts) / 600) AS BIGINT) * 600 - k * 600 AS start FROM b, w)
SELECT start AS window_start, risk_band, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives FROM x GROUP BY ALL""")
def q_stream_traffic(spark, sf_dir):
    """ST4: hourly windows every ten minutes, traffic and positives per band on the scored stream, open windows included."""
    ev = st.stream_table(spark, sf_dir, "events")

    def scorer(d):
        z = (F.col("value") - F.lit(50.0)) / F.lit(40.0)
        return cal.apply_temperature(d.withColumn("logit", z), 1.5, "logit", "score")

    s = st.score_stream(ev, scorer).withColumn("_ts", F.timestamp_seconds(epoch_seconds("ts"))) \
        .withColumn("y", (F.col("event_type") == "error").cast("int"))
    t = st.band_traffic(s, "_ts", "y", "1 hour", "10 minutes", "1 hour")
    out = st.run_to_latest(t, "st4", ["window", "risk_band"])
    return out.select(F.unix_seconds(F.col("window.start")).alias("window_start"), "risk_band", "rows", "positives")


# ---------------------------------------------------------------------------
# J4, M6-M8, E8, E9 models on the labelled, split events dataset
# ---------------------------------------------------------------------------
from tidewatch.config import NUMERIC_FEATURES, LogisticConfig  # noqa: E402
from tidewatch.operators import models as mdl  # noqa: E402


def _dataset(spark, sf_dir):
    from tidewatch.plans.pipeline import EVENTS, build_dataset
    return build_dataset(events_transactions(spark, sf_dir), EVENTS)


def _numeric(ds):
    return [c for c in NUMERIC_FEATURES if c in ds.columns]


@register("embedding_lookup_join", f"""WITH {keyed_sql(EVENTS_TX_SQL)},
n AS (SELECT max(vec_id) + 1 AS n FROM embeddings),
h AS (SELECT TransactionID, md5(entity_key) AS h FROM keyed),
b AS (SELECT TransactionID, ((((CAST('0x' || h[1:8] AS BIGINT) % n) * 4294967296 + CAST('0x' || h[9:16] AS BIGINT)) % n
      * 4294967296 + CAST('0x' || h[17:24] AS BIGINT)) % n * 4294967296 + CAST('0x' || h[25:32] AS BIGINT)) % n AS bucket FROM h, n)
SELECT TransactionID, {f4('list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE)))')} AS emb_sum,
       CAST(len(embedding) AS INTEGER) AS emb_dim
FROM b LEFT JOIN embeddings e ON e.vec_id = b.bucket""")
def q_emb(spark, sf_dir):
    """Entity key hashed over all rows of the table -> embedding vector via an equi-join."""
    tx = feat.add_keys(_tx(spark, sf_dir, "events"))
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("bucket"), F.col("embedding").alias("vec"))
    n = int(emb.agg(F.max("bucket")).first()[0]) + 1
    j = mdl.embedding_lookup(tx, "entity_key", emb, n, "emb")
    return j.select("TransactionID",
                    fixed4(F.aggregate(F.col("emb"), F.lit(0.0), lambda a, x: a + x.cast("double"))).alias("emb_sum"),
                    F.size("emb").cast("int").alias("emb_dim")).withColumn(
        "emb_dim", F.when(F.col("emb_dim") < 0, F.lit(None)).otherwise(F.col("emb_dim")))


@register("baseline_model_comparison", None)
def q_lr(spark, sf_dir):
    """M4 + M5 + K4 + M9 + M6 + E8: balanced L2 logistic regression on the train split,
    beside boosted trees: base rate, AUC, AP, Brier, best F1 and lift on valid and test."""
    ds = _dataset(spark, sf_dir)
    tr = ds.filter(F.col("split") == "train")
    m = mdl.fit_baseline(tr, "y_ew_72h", _numeric(ds), ["P_emaildomain"], ["entity_key", "fingerprint_key"],
                         LogisticConfig())
    gbt, _, _, prepare = mdl.fit_nonlinear(tr, ds.filter(F.col("split") == "valid"), "y_ew_72h", _numeric(ds), grid=({"maxDepth": 3},))
    from pyspark.ml.functions import vector_to_array
    ident = [F.col("TransactionID").alias("id"), F.col("y_ew_72h").cast("int").alias("y")]
    part = {s: ds.filter(F.col("split") == s) for s in ("valid", "test")}
    from tidewatch.session import scratch_table     # the scores are read by several metrics: written once
    return met.model_comparison({
        "logistic": {s: scratch_table(m.transform(d).select(*ident, F.col("score").alias("p")), "scores") for s, d in part.items()},
        "boosted_trees": {s: scratch_table(gbt.transform(prepare(d)).select(*ident, vector_to_array("probability")[1].alias("p")), "scores") for s, d in part.items()},
    }, top_pcts=(1, 3, 8))


@register("linear_attributions", None)
def q_shap(spark, sf_dir):
    """Mean |beta_j (x_j - E_train x_j)| over the whole test split, numeric slice."""
    ds = _dataset(spark, sf_dir)
    num = _numeric(ds)
    tr, te = ds.filter(F.col("split") == "train"), ds.filter(F.col("split") == "test")
    m = mdl.fit_baseline(tr, "y_ew_72h", num, cfg=LogisticConfig())
    return met.linear_attributions(prep.apply_median_scaler(te, m.scaler, num), prep.apply_median_scaler(tr, m.scaler, num),
                                   m.coefficients())


@register("nonlinear_model_selection", None)
def q_gbt(spark, sf_dir):
    """M8 re-aim + M9: class-weighted boosted trees, grid point chosen by validation AP."""
    ds = _dataset(spark, sf_dir)
    num = _numeric(ds)
    model, params, ap, prepare = mdl.fit_nonlinear(ds.filter(F.col("split") == "train"),
                                                   ds.filter(F.col("split") == "valid"), "y_ew_72h", num)
    from pyspark.ml.functions import vector_to_array
    te = model.transform(prepare(ds.filter(F.col("split") == "test"))).select(
        F.col("y_ew_72h").cast("int").alias("y"), vector_to_array("probability")[1].alias("p"))
    return met.model_comparison({f"gbt_depth{params['maxDepth']}": {"test": te}})


@register("embedding_network_scores", None)
def q_mlp(spark, sf_dir):
    """M1 + M2 + J4 + M8: standardised numerics and the entity embedding feed a network trained and scored
    by Spark ML; test rows are banded (B1/B2)."""
    ds = _dataset(spark, sf_dir)
    num = _numeric(ds)
    tr = ds.filter(F.col("split") == "train")
    st_ = prep.fit_standardizer(tr, num)
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("bucket"), F.col("embedding").alias("vec"))
    n = int(emb.agg(F.max("bucket")).first()[0]) + 1
    x = mdl.embedding_lookup(prep.transform_numeric(ds, st_, num), "entity_key", emb, n, "emb")
    _, _, net = mdl.fit_embedding_mlp(x.filter(F.col("split") == "train"), "y_ew_72h", num, "emb", 64)
    from pyspark.ml.functions import vector_to_array
    te = net.transform(mdl.embedding_features(x.filter(F.col("split") == "test"), num, "emb", 64))
    te = te.withColumn("score", vector_to_array("probability")[1])
    banded = bnd.assign_risk_band(te, bnd.band_cutoffs(te, BandPolicy()))
    return banded.select("TransactionID", fixed4(F.col("score")).alias("score"), "risk_band")



# ---------------------------------------------------------------------------
# scalable path on real data: every key above a small row target is time-chunked
# ---------------------------------------------------------------------------
@register("entity_velocity_features_hotkeys", entity_features_sql(EVENTS_TX_SQL))
def q_entity_hot(spark, sf_dir):
    """W1-W8 with hot-key chunking forced (keys over 32 rows split into time chunks)."""
    return _entity(spark, sf_dir, "events", FeatureConfig(hot_key_rows=32))


@register("entity_velocity_features_ties_hotkeys", entity_features_sql(ORDERS_TX_SQL))
def q_entity_ties_hot(spark, sf_dir):
    """W1-W8 on tie-heavy orders with every nation series time-chunked."""
    return _entity(spark, sf_dir, "orders", FeatureConfig(hot_key_rows=32))


@register("fingerprint_campaign_features_hotkeys", fingerprint_features_sql(EVENTS_TX_SQL))
def q_fp_hot(spark, sf_dir):
    """W9-W10 with hot fingerprints time-chunked."""
    return _fingerprint(spark, sf_dir, "events", FeatureConfig(hot_key_rows=32))


@register("early_warning_label_any_hotkeys", label_any_sql(EVENTS_TX_SQL))
def q_label_hot(spark, sf_dir):
    """L1 with hot entities time-chunked (next fraud found across chunk edges)."""
    tx = feat.add_keys(_tx(spark, sf_dir, "events")).select("TransactionID", "TransactionDT", "isFraud", "entity_key")
    d = lab.make_early_warning_label(tx, LabelConfig(hot_key_rows=32))
    return d.select("TransactionID", F.col("y_ew_72h").cast("int").alias("y_ew_72h"))


@register("early_warning_label_next_hotkeys", label_next_sql(ORDERS_TX_SQL))
def q_label_next_hot(spark, sf_dir):
    """L2 on tie-heavy orders with chunked series (next row found across chunk edges)."""
    tx = feat.add_keys(_tx(spark, sf_dir, "orders")).select("TransactionID", "TransactionDT", "isFraud", "entity_key")
    d = lab.make_early_warning_label(tx, LabelConfig(mode="next_event", hot_key_rows=32))
    return d.select("TransactionID", F.col("y_ew_72h").cast("int").alias("y_ew_72h"))


# ---------------------------------------------------------------------------
# a hot second: one key and second with most rows; and rows without a time
# ---------------------------------------------------------------------------
_CROWD_SQL = f"""SELECT TransactionID, CASE WHEN TransactionID % 10 < 6 THEN 1705000000 WHEN TransactionID % 10 = 6 THEN 1705000000 + TransactionID % 3 * 3600
       WHEN TransactionID % 97 = 9 THEN NULL ELSE TransactionDT END AS TransactionDT, TransactionAmt, isFraud,
       CASE WHEN TransactionID % 10 < 7 THEN 1 ELSE card1 END AS card1, CASE WHEN TransactionID % 10 < 7 THEN 'd' ELSE DeviceInfo END AS DeviceInfo,
       CASE WHEN TransactionID % 10 < 7 THEN 'e' ELSE P_emaildomain END AS P_emaildomain FROM ({EVENTS_TX_SQL}) c0"""
_TIMED_CROWD_SQL = f"SELECT * FROM ({_CROWD_SQL}) c1 WHERE TransactionDT IS NOT NULL /* P_emaildomain */"
_SLICED = 100       # rows in a chunk: the second with most rows is cut into many


def _crowd(spark, sf_dir):
    """The events, six in ten moved to one second of one key, others around it, some without a time."""
    i = F.col("TransactionID")
    moved = F.when(i % 10 < 6, F.lit(1705000000)).when(i % 10 == 6, F.lit(1705000000) + i % 3 * 3600).when(i % 97 == 9, F.lit(None)).otherwise(F.col("TransactionDT"))
    d = events_transactions(spark, sf_dir).withColumn("TransactionDT", moved.cast("bigint"))
    for c, v in (("card1", 1), ("DeviceInfo", "d"), ("P_emaildomain", "e")):
        d = d.withColumn(c, F.when(i % 10 < 7, F.lit(v)).otherwise(F.col(c)))
    return feat.add_keys(d)


def _untimed_sql(timed: str, columns) -> str:
    return f"""SELECT TransactionID, {', '.join(columns)} FROM ({timed}) t UNION ALL
SELECT TransactionID, {', '.join('NULL' for _ in columns)} FROM ({_CROWD_SQL}) n WHERE TransactionDT IS NULL"""


@register("entity_velocity_features_hot_second", _untimed_sql(entity_features_sql(_TIMED_CROWD_SQL), _VELOCITY_COLUMNS))
def q_entity_crowd(spark, sf_dir):
    """W1-W8 where one second of one key has most rows: ranks by a prefix sum, slices of a hundred rows. Rows without a time have null features."""
    d = feat.add_entity_time_features(_crowd(spark, sf_dir), FeatureConfig(hot_key_rows=_SLICED))
    return d.select("TransactionID", *[F.col(c) if c.startswith("cnt") else fixed4(F.col(c)).alias(c) for c in _VELOCITY_COLUMNS])


@register("fingerprint_campaign_features_hot_second", _untimed_sql(fingerprint_features_sql(_TIMED_CROWD_SQL), _CAMPAIGN_COLUMNS))
def q_fp_crowd(spark, sf_dir):
    """W9-W10 where one second of one fingerprint has most rows."""
    d = feat.add_fingerprint_time_features(_crowd(spark, sf_dir), FeatureConfig(hot_key_rows=_SLICED))
    return d.select("TransactionID", "fp_cnt_24h", "fp_cnt_72h", fixed4(F.col("fp_growth_ratio_24h_over_72h").cast("double")).alias("fp_growth_ratio_24h_over_72h"))


@register("early_warning_label_any_hot_second", _untimed_sql(label_any_sql(_TIMED_CROWD_SQL), ["y_ew_72h"]))
def q_label_any_crowd(spark, sf_dir):
    """L1 where one second of one key has most rows (slices of a second aren't later than each other)."""
    d = lab.make_early_warning_label(_crowd(spark, sf_dir), LabelConfig(hot_key_rows=_SLICED))
    return d.select("TransactionID", F.col("y_ew_72h").cast("int").alias("y_ew_72h"))


@register("early_warning_label_next_hot_second", _untimed_sql(label_next_sql(_TIMED_CROWD_SQL), ["y_ew_72h"]))
def q_label_next_crowd(spark, sf_dir):
    """L2 where one second of one key has most rows (next rows across the edges of its slices)."""
    d = lab.make_early_warning_label(_crowd(spark, sf_dir), LabelConfig(mode="next_event", hot_key_rows=_SLICED))
    return d.select("TransactionID", F.col("y_ew_72h").cast("int").alias("y_ew_72h"))


@register("features_and_label_hot_second", f"""WITH e AS ({_untimed_sql(entity_features_sql(_TIMED_CROWD_SQL), _VELOCITY_COLUMNS)}),
f AS ({_untimed_sql(fingerprint_features_sql(_TIMED_CROWD_SQL), _CAMPAIGN_COLUMNS)}), l AS ({_untimed_sql(label_any_sql(_TIMED_CROWD_SQL), ["y_ew_72h"])})
SELECT * FROM e JOIN f USING (TransactionID) JOIN l USING (TransactionID)""")
def q_build_crowd(spark, sf_dir):
    """W13 with the label in one pass, hot seconds found once for both keys."""
    d = feat.build_features(_crowd(spark, sf_dir), FeatureConfig(hot_key_rows=_SLICED), label=LabelConfig(hot_key_rows=_SLICED))
    whole = ("cnt_1h", "cnt_24h", "fp_cnt_24h", "fp_cnt_72h")
    return d.select("TransactionID", *[F.col(c) if c in whole else fixed4(F.col(c).cast("double")).alias(c) for c in (*_VELOCITY_COLUMNS, *_CAMPAIGN_COLUMNS)],
                    F.col("y_ew_72h").cast("int").alias("y_ew_72h"))


@register("feature_missing_report", f"""WITH e AS ({entity_features_sql(EVENTS_TX_SQL)}),
f AS ({fingerprint_features_sql(EVENTS_TX_SQL)}), j AS (SELECT * FROM e JOIN f USING (TransactionID))
SELECT count(*) AS rows, {f4('avg(CAST(z_amt_vs_7d IS NULL AS DOUBLE)) * 100.0')} AS z_missing_pct,
       {f4('avg(CAST(fp_growth_ratio_24h_over_72h IS NULL AS DOUBLE)) * 100.0')} AS growth_missing_pct,
       {f4('avg(CAST(cnt_1h IS NULL AS DOUBLE)) * 100.0')} AS cnt_1h_missing_pct FROM j""")
def q_feat_report(spark, sf_dir):
    """Full feature build (keys, keep-list, entity + campaign features) and its report."""
    f = feat.build_features(_tx(spark, sf_dir, "events"))
    r = feat.feature_report(f)
    wide = r.groupBy("rows").agg(*[F.max(F.when(F.col("column") == c, F.col("missing_pct"))).alias(a) for c, a in
                                   [("z_amt_vs_7d", "z_missing_pct"),
                                    ("fp_growth_ratio_24h_over_72h", "growth_missing_pct"),
                                    ("cnt_1h", "cnt_1h_missing_pct")]])
    return wide.select("rows", *[fixed4(F.col(c)).alias(c) for c in ("z_missing_pct", "growth_missing_pct",
                                                                      "cnt_1h_missing_pct")])


@register("review_top_k", f"""SELECT id, {f4('p')} AS score FROM ({_SCORED_SQL}) s ORDER BY p DESC, id LIMIT 100""")
def q_topk(spark, sf_dir):
    """O3: the 100 highest-scoring events (ties by id) -- a top-k report."""
    s = _scored(spark, sf_dir).withColumnRenamed("p", "score")
    return bnd.top_k(s, 100, "score", "id").select("id", fixed4(F.col("score")).alias("score"))


# ---------------------------------------------------------------------------
# the scale path of the prefix sums: at least 64 range partitions, more than 64 groups, missing scores
# ---------------------------------------------------------------------------
_MISSING_SQL = f"""SELECT id, y, CASE WHEN id % 11 = 0 THEN CAST('NaN' AS DOUBLE) WHEN id % 13 = 0 THEN NULL ELSE p END AS p FROM ({_SCORED_SQL}) s0"""
_SEEN_SQL = f"SELECT * FROM ({_MISSING_SQL}) s1 WHERE p IS NOT NULL AND NOT isnan(p)"


def _missing(spark, sf_dir):
    """The scored events with NaN and null scores among them."""
    p = F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.col("p"))
    return _scored(spark, sf_dir).withColumn("p", p)


@register("quantiles_many_groups", f"""SELECT user_id, {f4('quantile_cont(value, 0.5)')} AS p50, {f4('quantile_cont(value, 0.95)')} AS p95
FROM events WHERE value IS NOT NULL GROUP BY user_id""")
def q_many_groups(spark, sf_dir):
    """A11 + X1: exact quantiles of every user (more than 64 groups) over 64 range partitions."""
    from tidewatch.operators.quantiles import exact_quantiles
    q = exact_quantiles(table(spark, sf_dir, "events"), "value", [0.5, 0.95], "linear", ["user_id"], n_buckets=64)
    return q.groupBy("user_id").agg(*[fixed4(F.max(F.when(F.col("q") == x, F.col("value")))).alias(n) for x, n in ((0.5, "p50"), (0.95, "p95"))])


@register("binary_metrics_missing_scores", f"""{_CURVE_SQL.replace(_SCORED_SQL, _SEEN_SQL)}
SELECT {f4('sum(pos * (neg_cum - neg + neg / 2.0)) / (max(tot_pos) * max(tot_neg))')} AS auc_roc,
       {f4('sum(CASE WHEN pos > 0 THEN pos / tot_pos * tp / (tp + fp) END)')} AS avg_precision,
       (SELECT {f4('avg(power(p - y, 2))')} FROM s) AS brier FROM k""")
def q_binary_missing(spark, sf_dir):
    """E1 + E5 + X1: AUC, AP and Brier over the rows with a score, 64 range partitions."""
    m = met.binary_metrics(_missing(spark, sf_dir), n_buckets=64)
    return m.select(*[fixed4(F.col(c)).alias(c) for c in ("auc_roc", "avg_precision", "brier")])


@register("lift_at_k_buckets", REGISTRY["lift_at_k"][1])
def q_lift_buckets(spark, sf_dir):
    """E4 + X1: lift over 64 range partitions."""
    lf = met.lift_at_k(_scored(spark, sf_dir), (1, 3, 8), n_buckets=64)
    return lf.select("top_pct", "k", *[fixed4(F.col(c)).alias(c) for c in ("precision", "recall", "lift")])


@register("ks_drift_buckets", REGISTRY["ks_drift"][1])
def q_ks_buckets(spark, sf_dir):
    """DR1 + X1: KS over 64 range partitions."""
    ref, cur = _ref_cur(spark, sf_dir)
    return drf.ks_drift(ref, cur, DriftConfig(features=_DRIFT_FEATS, p_method="limiting"), n_buckets=64)


@register("wasserstein_drift_buckets", REGISTRY["wasserstein_drift"][1])
def q_wasserstein_buckets(spark, sf_dir):
    """DR4 + X1: Wasserstein over 64 range partitions (next values across their edges)."""
    ref, cur = _ref_cur(spark, sf_dir)
    w = drf.wasserstein(ref, cur, _DRIFT_FEATS, n_buckets=64)
    return w.select("feature", fixed4(F.col("wasserstein")).alias("wasserstein"),
                    fixed4(F.col("wasserstein_norm")).alias("wasserstein_norm"))


@register("band_cutoffs_missing_scores", f"""SELECT {f4('quantile_cont(p, 0.99)')} AS critical, {f4('quantile_cont(p, 0.97)')} AS high,
       {f4('quantile_cont(p, 0.92)')} AS medium FROM ({_SEEN_SQL}) s""")
def q_cutoffs_missing(spark, sf_dir):
    """B1 on a score column with NaN and null, 64 range partitions."""
    c = bnd.band_cutoffs(_missing(spark, sf_dir).withColumnRenamed("p", "score"), BandPolicy(), n_buckets=64)
    return c.select(*[fixed4(F.col(x)).alias(x) for x in ("critical", "high", "medium")])


@register("exact_capacity_bands_missing_scores", f"""WITH r AS (SELECT id, row_number() OVER (ORDER BY p DESC, id) AS rk, count(*) OVER () AS n FROM ({_SEEN_SQL}) s)
SELECT a.id, CASE WHEN rk <= CAST(floor(n * 0.01) AS BIGINT) THEN 'critical'
                WHEN rk <= CAST(floor(n * 0.03) AS BIGINT) THEN 'high'
                WHEN rk <= CAST(floor(n * 0.08) AS BIGINT) THEN 'medium' ELSE 'low' END AS risk_band
FROM ({_MISSING_SQL}) a LEFT JOIN r USING (id)""")
def q_exact_missing(spark, sf_dir):
    """B3 on a score column with NaN and null: the rows with a score are counted and ranked, the others are low."""
    s = _missing(spark, sf_dir).withColumnRenamed("p", "score")
    return bnd.exact_capacity_bands(s, BandPolicy(policy="exact_k"), "score", "id", n_buckets=64).select("id", "risk_band")


@register("exact_capacity_bands_ties", """WITH s AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_discount AS p FROM lineitem),
r AS (SELECT id, row_number() OVER (ORDER BY p DESC, id) AS rk, count(*) OVER () AS n FROM s)
SELECT id, CASE WHEN rk <= CAST(floor(n * 0.01) AS BIGINT) THEN 'critical'
                WHEN rk <= CAST(floor(n * 0.03) AS BIGINT) THEN 'high'
                WHEN rk <= CAST(floor(n * 0.08) AS BIGINT) THEN 'medium' ELSE 'low' END AS risk_band FROM r""")
def q_exact_ties(spark, sf_dir):
    """B3 on a score of eleven values: every boundary lies inside a large tie group."""
    s = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_discount").alias("score"))
    return bnd.exact_capacity_bands(s, BandPolicy(policy="exact_k"), "score", "id", n_buckets=64).select("id", "risk_band")


@register("reliability_curve_missing_scores", f"""WITH s AS ({_SEEN_SQL}),
e AS (SELECT quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM s),
b AS (SELECT y, p, CAST(len(list_filter(edges, lambda x: x < p)) AS INTEGER) AS bin FROM s, e)
SELECT bin, {f4('avg(CAST(y AS DOUBLE))')} AS prob_true, {f4('avg(p)')} AS prob_pred, count(*) AS count
FROM b GROUP BY bin""")
def q_reliability_missing(spark, sf_dir):
    """E7 on a score column with NaN and null."""
    r = met.reliability_curve(_missing(spark, sf_dir), 10)
    return r.select(F.col("bin").cast("int").alias("bin"), fixed4(F.col("prob_true")).alias("prob_true"),
                    fixed4(F.col("prob_pred")).alias("prob_pred"), "count")


# ---------------------------------------------------------------------------
# V2 with the pipeline, W14, O2, A3, A8, M4 / M5 transforms, F1 / F2, S1 / S3
# ---------------------------------------------------------------------------
@register("clean_with_quarantine", f"""WITH d AS ({_DIRTY_SQL}), c AS (SELECT TransactionID, TRY_CAST(TransactionDT AS BIGINT) AS dt, TRY_CAST(TransactionAmt AS DOUBLE) AS amt, isFraud FROM d)
SELECT 'clean' AS part, TransactionID, dt AS TransactionDT, {f4('amt')} AS TransactionAmt, CAST(isFraud AS INTEGER) AS isFraud, '' AS violations, 1 AS copies
FROM c WHERE TransactionID IS NOT NULL AND dt IS NOT NULL
UNION ALL
SELECT 'quarantine', TransactionID, dt, {f4('amt')}, CAST(isFraud AS INTEGER), concat_ws(',', CASE WHEN TransactionID IS NULL THEN 'TransactionID:required' END,
       CASE WHEN dt IS NULL THEN 'TransactionDT:required' END), 1 FROM (SELECT * FROM c UNION ALL SELECT * FROM c) x WHERE TransactionID IS NULL OR dt IS NULL""")
def q_quarantine(spark, sf_dir):
    """V2 + P4 + D2 as the pipeline runs them: coerced rows with a broken contract go to quarantine, the rest is de-duplicated."""
    from tidewatch.plans.pipeline import clean_and_quarantine
    good, bad = clean_and_quarantine(_dirty(spark, sf_dir), CleaningConfig(order_cols=("TransactionDT", "TransactionAmt", "isFraud")))
    cols = ["TransactionID", "TransactionDT", fixed4(F.col("TransactionAmt")).alias("TransactionAmt"), "isFraud"]
    return good.select(F.lit("clean").alias("part"), *cols, F.lit("").alias("violations"), F.lit(1).alias("copies")).unionByName(
        bad.select(F.lit("quarantine").alias("part"), *cols, F.array_join("violations", ",").alias("violations"), F.lit(1).alias("copies")))


@register("entity_velocity_strict_history", entity_features_sql(EVENTS_TX_SQL).replace(
    "avg(prev_amt) OVER w7", "avg(TransactionAmt) OVER p7").replace("stddev_pop(prev_amt) OVER w7", "stddev_pop(TransactionAmt) OVER p7").replace(
    f"RANGE BETWEEN {_lower(604800)} PRECEDING AND CURRENT ROW))",
    f"RANGE BETWEEN {_lower(604800)} PRECEDING AND CURRENT ROW),\n             p7 AS (PARTITION BY entity_key ORDER BY ord RANGE BETWEEN {_lower(604800)} PRECEDING AND 1 PRECEDING))"))
def q_strict(spark, sf_dir):
    """History strictly before the row, without the lag."""
    return _entity(spark, sf_dir, "events", FeatureConfig(history="strict"))


@register("review_queue", f"""SELECT id, risk_band, row_number() OVER (ORDER BY array_position(['critical', 'high', 'medium', 'low'], risk_band), p DESC, id) AS place
FROM ({_BANDED_SQL}) b""")
def q_queue(spark, sf_dir):
    """O2: the review order: band rank, score, id, with each row's place (from the distributed prefix sum)."""
    from tidewatch.config import BAND_ORDER
    from tidewatch.operators.quantiles import prefix_sums
    q = bnd.review_queue(_banded(spark, sf_dir))
    rank = F.array_position(F.array(*[F.lit(b) for b in BAND_ORDER]), F.col("risk_band"))
    ranked = prefix_sums(q.select("id", "risk_band", rank.alias("r"), (-F.col("score")).alias("s"), F.lit(1).alias("one")), ["r", "s", "id"], ["one"], n_buckets=64)
    return ranked.select("id", "risk_band", F.col("one_cum").alias("place"))


@register("csv_round_trip", "SELECT event_id, user_id, event_type, value FROM events")
def q_csv(spark, sf_dir):
    """S1 + S3: events written as CSV and as partitioned Parquet, read back with their schema."""
    import os
    import uuid

    from tidewatch.session import checkpoint_dir
    from tidewatch.sources import io
    base = os.path.join(checkpoint_dir(spark), "tables", f"round-{uuid.uuid4().hex}")
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    e.write.option("header", True).csv(os.path.join(base, "csv"))
    io.write_parquet(io.read_csv(spark, os.path.join(base, "csv"), e.schema), os.path.join(base, "parquet"), ["event_type"])
    return io.read_parquet(spark, os.path.join(base, "parquet")).select(*e.columns)


@register("psi_js_drift_shifted", REGISTRY["psi_js_drift"][1].replace(_REF_SQL, _SPLIT_REF).replace(_CUR_SQL, _SPLIT_CUR))
def q_psi_shifted(spark, sf_dir):
    """DR7 between small and large quantities: two features that drift far, two that don't."""
    li = table(spark, sf_dir, "lineitem")
    p = drf.psi_js(li.filter("l_quantity <= 30"), li.filter("l_quantity > 30"), _DRIFT_FEATS)
    return p.select("feature", fixed4(F.col("psi")).alias("psi"), fixed4(F.col("js_divergence")).alias("js_divergence"))


_NET_IN = ("l_quantity / 50.0", "l_discount * 10.0", "l_tax * 10.0")
_NET_W = [[[0.5, -0.25, 1.0, -1.0], [0.75, 0.5, -0.5, 0.25], [-1.0, 1.0, 0.5, 0.5]], [[1.0], [-0.5], [0.25], [0.75]]]
_NET_B = [[0.125, -0.125, 0.0, 0.25], [-0.5]]


def _net_sql() -> str:
    unit = lambda j: "greatest(" + " + ".join(f"({x}) * {_NET_W[0][i][j]}" for i, x in enumerate(_NET_IN)) + f" + {_NET_B[0][j]}, 0.0)"
    logit = " + ".join(f"{unit(j)} * {_NET_W[1][j][0]}" for j in range(4)) + f" + {_NET_B[1][0]}"
    return f"SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(({logit}) * 100 + 0.503) AS BIGINT) AS logit_pct FROM lineitem"


@register("relu_network_scores", _net_sql())
def q_relu(spark, sf_dir):
    """M7: the forward pass of a network with given ReLU weights, per Arrow batch."""
    import numpy as np
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *[F.expr(x).alias(f"x{i}") for i, x in enumerate(_NET_IN)])
    out = mdl.mlp_logits(li, ["x0", "x1", "x2"], [(np.array(w), np.array(b)) for w, b in zip(_NET_W, _NET_B)])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.floor(F.col("logit") * 100 + 0.503).alias("logit_pct"))


# ---------------------------------------------------------------------------
# E2 thinned, E8 / E9 with given models, A6 / A11 by sketches, DR1 exact, B5, S1 + D2 in file order
# ---------------------------------------------------------------------------
_POINTS = 50


@register("pr_curve_thinned", f"""{_CURVE_SQL}, q AS (SELECT p, tp, fp, tp / (tp + fp) AS pr, tp / tot_pos AS rc, tot_pos / (tot_pos + tot_neg) AS base,
  CAST((tp * {_POINTS - 1} + tot_pos - 1) // tot_pos AS INTEGER) AS step FROM k),
cell AS (SELECT step, arg_max(struct_pack(p := p, pr := pr, rc := rc, base := base), (tp, -fp)) AS a, min(pr) AS lo, max(pr) AS hi FROM q GROUP BY step),
w AS (SELECT *, a.rc - coalesce(lag(a.rc) OVER (ORDER BY step), 0) AS width FROM cell)
SELECT step, {f4('a.p')} AS threshold, {f4('a.pr')} AS precision, {f4('a.rc')} AS recall, {f4('a.base')} AS base_rate, {f4('width * a.pr')} AS area, {f4('width * (hi - lo)')} AS area_slack FROM w""")
def q_pr_thin(spark, sf_dir):
    """E2 for reports: at most 50 points of the precision-recall curve."""
    c = met.pr_curve_thinned(_scored(spark, sf_dir), _POINTS)
    return c.select("step", *[fixed4(F.col(x)).alias(x) for x in c.columns[1:]])


@register("pr_curve_thinned_area", f"""{_CURVE_SQL}
SELECT {f4('sum(CASE WHEN pos > 0 THEN pos / tot_pos * tp / (tp + fp) END)')} AS area_whole, true AS few_points, true AS within_slack FROM k""")
def q_pr_area(spark, sf_dir):
    """The thinned curve's area is that of the whole curve within its stated slack."""
    s = _scored(spark, sf_dir)
    thin = met.pr_curve_thinned(s, _POINTS).agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("a"), F.sum("area_slack").alias("slack"))
    whole = met.binary_metrics(s).select("avg_precision")
    return whole.crossJoin(thin).select(fixed4(F.col("avg_precision")).alias("area_whole"), (F.col("n") <= _POINTS).alias("few_points"),
                                        (F.abs(F.col("avg_precision") - F.col("a")) <= F.col("slack") + 1e-12).alias("within_slack"))


_SKETCHED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("approx_quantile_ranks", " UNION ALL ".join(f"""SELECT '{c}' AS "column", q, count({c}) AS n, true AS within FROM lineitem, (VALUES (0.5), (0.95), (0.99)) v(q) GROUP BY q""" for c in _SKETCHED))
def q_approx(spark, sf_dir):
    """A6 / A11 with sketches: the true rank of every answer, counted, is within n / accuracy (1,000) of q * n."""
    from tidewatch.operators.quantiles import approx_quantiles
    long = table(spark, sf_dir, "lineitem").select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in _SKETCHED])))
    got = approx_quantiles(long, "value", [0.5, 0.95, 0.99], ["column"], accuracy=1000).withColumnRenamed("value", "answer")
    # a value holds the ranks from those below it to those up to it
    ranks = long.join(F.broadcast(got), "column").groupBy("column", "q", "answer").agg(
        F.count("value").alias("n"), F.sum((F.col("value") < F.col("answer")).cast("long")).alias("below"), F.sum((F.col("value") <= F.col("answer")).cast("long")).alias("upto"))
    want, slack = F.col("q") * F.col("n"), F.col("n") / 1000 + 1
    return ranks.select("column", "q", "n", ((F.col("below") - slack <= want) & (want <= F.col("upto") + slack)).alias("within"))


@register("numeric_sanity_approx", " UNION ALL ".join(f"""SELECT '{c}' AS "column", {f4(f'avg(CAST({c} IS NULL AS DOUBLE)) * 100.0')} AS missing_pct, {f4(f'min({c})')} AS min, {f4(f'max({c})')} AS max, true AS ordered FROM lineitem""" for c in _SKETCHED))
def q_sanity_approx(spark, sf_dir):
    """A6 in one aggregate: missing share and range exact, quantiles from sketches."""
    m = prof.numeric_sanity(table(spark, sf_dir, "lineitem"), _SKETCHED, exact=False)
    ordered = (F.col("min") <= F.col("p50")) & (F.col("p50") <= F.col("p95")) & (F.col("p95") <= F.col("p99")) & (F.col("p99") <= F.col("max"))
    return m.select("column", *[fixed4(F.col(c)).alias(c) for c in ("missing_pct", "min", "max")], ordered.alias("ordered"))


_KS_FEATURES = ("s_acctbal", "s_nationkey")
_KS_EXACT_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, s_suppkey % 3 = 0 AS cur FROM supplier" for c in _KS_FEATURES)


@register("ks_drift_exact", f"""WITH RECURSIVE v AS ({_KS_EXACT_SQL}),
g AS (SELECT feature, value, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c FROM v GROUP BY feature, value),
e AS (SELECT feature, sum(r) OVER w AS rc, sum(c) OVER w AS cc, sum(r) OVER t AS rt, sum(c) OVER t AS ct FROM g WINDOW w AS (PARTITION BY feature ORDER BY value), t AS (PARTITION BY feature)),
d AS (SELECT feature, max(abs(rc / rt - cc / ct)) AS d, CAST(max(rt) AS BIGINT) AS n_ref, CAST(max(ct) AS BIGINT) AS n_cur FROM e GROUP BY feature),
s AS (SELECT *, greatest(n_ref, n_cur) AS n, least(n_ref, n_cur) AS m, d - 0.5 / (n_ref * n_cur) AS edge FROM d WHERE n_ref >= 10 AND n_cur >= 10),
p(feature, i, n, m, edge, u) AS (
  SELECT feature, 0, n, m, edge, list_transform(range(0, m + 1), lambda j: CASE WHEN j / m < edge THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FROM s
  UNION ALL
  SELECT feature, i + 1, n, m, edge, list_transform(range(1, m + 2), lambda k: CASE WHEN abs((i + 1) / n - (k - 1) / m) < edge THEN list_sum(list_transform(range(1, k + 1),
    lambda b: CASE WHEN abs((i + 1) / n - (b - 1) / m) < edge THEN u[b] * (i + 1) / (i + 1 + m) ELSE 0.0::DOUBLE END)) ELSE 0.0::DOUBLE END) FROM p WHERE i < n)
SELECT feature, {f4('d')} AS ks_statistic, {f4('1 - u[m + 1]')} AS p_value, n_ref, n_cur FROM s JOIN (SELECT feature, u FROM p WHERE i = n) x USING (feature)""")
def q_ks_exact(spark, sf_dir):
    """DR1 with the exact null distribution, on two small samples (the second feature is heavily tied)."""
    d = table(spark, sf_dir, "supplier").select("s_suppkey", *[F.col(c).cast("double").alias(c) for c in _KS_FEATURES])
    k = drf.ks_drift(d.filter("s_suppkey % 3 <> 0"), d.filter("s_suppkey % 3 = 0"), DriftConfig(features=_KS_FEATURES))
    return k.select("feature", fixed4(F.col("ks_statistic")).alias("ks_statistic"), fixed4(F.col("p_value")).alias("p_value"), "n_ref", "n_cur")


_GIVEN = {"steep": (50.0, 40.0), "flat": (20.0, -90.0)}       # logit = (value - a) / b
_GIVEN_SQL = " UNION ALL ".join(f"SELECT '{m}' AS model, split, TransactionID AS id, y, 1.0 / (1.0 + exp(-((TransactionAmt - {a}) / ({b})))) AS p FROM parts WHERE split <> 'train'" for m, (a, b) in _GIVEN.items())


def _stacked(cells) -> str:
    return "unnest([" + ", ".join(f"struct_pack(metric := '{m}', value := CAST({v} AS DOUBLE))" for m, v in cells) + "])"


_SPLIT_SQL = f"""c AS ({_CUT_SQL}), parts AS (SELECT *, coalesce(isFraud, 0) AS y, CASE WHEN TransactionDT <= train_end THEN 'train' WHEN TransactionDT <= valid_end THEN 'valid' ELSE 'test' END AS split
  FROM ({EVENTS_TX_SQL}) x, c)"""


@register("model_comparison_given", f"""WITH {_SPLIT_SQL}, s AS ({_GIVEN_SQL}),
g AS (SELECT model, split, p, sum(y) AS pos, count(*) - sum(y) AS neg FROM s WHERE p IS NOT NULL GROUP BY ALL),
k AS (SELECT *, sum(pos) OVER t AS tot_pos, sum(neg) OVER t AS tot_neg, sum(neg) OVER w AS neg_cum, sum(pos) OVER w AS pos_cum FROM g WINDOW t AS (PARTITION BY model, split), w AS (PARTITION BY model, split ORDER BY p)),
e AS (SELECT *, tot_pos - pos_cum + pos AS tp, tot_neg - neg_cum + neg AS fp FROM k),
f AS (SELECT *, 2 * (tp / (tp + fp)) * (tp / tot_pos) / (tp / (tp + fp) + tp / tot_pos + 1e-12) AS f1 FROM e),
a AS (SELECT model, split, sum(pos * (neg_cum - neg + neg / 2.0)) / (max(tot_pos) * max(tot_neg)) AS auc, sum(CASE WHEN pos > 0 THEN pos / tot_pos * tp / (tp + fp) END) AS ap, max(f1) AS bf,
      arg_max(p, (f1, -p)) FILTER (pos_cum > 0) AS bt FROM f GROUP BY model, split),
b AS (SELECT model, split, count(*) AS n, avg(y) AS base, avg(power(p - y, 2)) AS brier, sum(y) AS pos FROM s GROUP BY model, split),
r AS (SELECT model, split, y, row_number() OVER (PARTITION BY model, split ORDER BY p DESC NULLS LAST, id) AS rn FROM s),
h AS (SELECT model, split, pct, sum(r.y) AS hit, max(greatest(1, floor(n * pct / 100))) AS k, max(pos) AS pos, max(base) AS base FROM r JOIN b USING (model, split), (VALUES (1.0), (3.0), (8.0)) v(pct)
      WHERE rn <= greatest(1, floor(n * pct / 100)) GROUP BY ALL),
o AS (SELECT model, split, {_stacked([("n_rows", "n"), ("base_rate", "base"), ("auc_roc", "auc"), ("avg_precision", "ap"), ("brier", "brier"), ("best_threshold", "bt"), ("best_f1", "bf")])} AS x FROM a JOIN b USING (model, split)
  UNION ALL SELECT model, split, unnest([struct_pack(metric := 'precision_at_' || pct || 'pct', value := CAST(hit / k AS DOUBLE)), struct_pack(metric := 'recall_at_' || pct || 'pct', value := CAST(hit / greatest(pos, 1) AS DOUBLE)),
    struct_pack(metric := 'lift_at_' || pct || 'pct', value := CAST(hit / k / greatest(base, 1e-12) AS DOUBLE))]) FROM h)
SELECT model, split, x.metric AS metric, {f4('x.value')} AS value FROM o""")
def q_compare_given(spark, sf_dir):
    """Two given models on the valid and test parts: every metric of every cell, in one plan."""
    tx = spl.time_split(_tx(spark, sf_dir, "events"))
    cells = {m: {part: tx.filter(F.col("split") == part).select(F.col("TransactionID").alias("id"), F.col("isFraud").alias("y"),
                                                               (F.lit(1.0) / (F.lit(1.0) + F.exp(-((F.col("TransactionAmt") - a) / b)))).alias("p")) for part in ("valid", "test")}
             for m, (a, b) in _GIVEN.items()}
    c = met.model_comparison(cells, top_pcts=(1, 3, 8))
    return c.select("model", "split", "metric", fixed4(F.col("value")).alias("value"))


_COEFS = {"cnt_1h": 0.5, "cnt_24h": -0.125, "sum_amt_1h": 0.01, "mean_amt_7d_hist": 0.02}


@register("linear_attributions_given", f"""WITH f AS ({entity_features_sql(EVENTS_TX_SQL)}), {_SPLIT_SQL},
d AS (SELECT f.*, split FROM f JOIN parts USING (TransactionID)),
m AS (SELECT {', '.join(f"avg({c}) AS {c}" for c in _COEFS)} FROM d WHERE split = 'train')
SELECT x.feature AS feature, {f4('x.value')} AS mean_abs_attribution FROM (SELECT unnest([{', '.join(f"struct_pack(feature := '{c}', value := avg(abs({b} * (d.{c} - m.{c}))))" for c, b in _COEFS.items())}]) AS x
  FROM d, m WHERE split = 'test') t""")
def q_attr_given(spark, sf_dir):
    """E9 with given coefficients: mean absolute linear attribution over the whole test part."""
    ds = spl.time_split(feat.add_entity_time_features(feat.add_keys(_tx(spark, sf_dir, "events"))))
    ds = ds.select("split", *[fixed4(F.col(c).cast("double")).alias(c) for c in _COEFS])
    a = met.linear_attributions(ds.filter("split = 'test'"), ds.filter("split = 'train'"), _COEFS)
    return a.select("feature", fixed4(F.col("mean_abs_attribution")).alias("mean_abs_attribution"))


@register("batch_score_job", f"""WITH b AS ({_BANDED_SQL}), n AS (SELECT count(*) AS rows_all, count(*) FILTER (risk_band = 'critical') AS n_critical, count(*) FILTER (risk_band = 'high') AS n_high,
  count(*) FILTER (risk_band = 'medium') AS n_medium, count(*) FILTER (risk_band = 'low') AS n_low FROM b)
SELECT id, {f4('p')} AS score, risk_band, n.*, {', '.join(f4('c.' + x) + ' AS cut_' + x for x in ('critical', 'high', 'medium'))} FROM b, n, ({_CUTS_SQL}) c""")
def q_batch_job(spark, sf_dir):
    """The whole job (column check, score, cutoffs of the batch, bands, partitioned table, counts observed in the write), read back."""
    import os
    import uuid

    from tidewatch.session import checkpoint_dir
    path = os.path.join(checkpoint_dir(spark), "tables", f"batch-{uuid.uuid4().hex}")
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "value")
    report = bnd.run_batch(ev, lambda d: d.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-((F.col("value") - 50.0) / 40.0)))), path, ["id", "value"], id_col="id")
    n, cut = report.counts, report.cutoffs
    return spark.read.parquet(path).select("id", fixed4(F.col("score")).alias("score"), "risk_band", F.lit(n["rows"]).alias("rows_all"),
                                           *[F.lit(n[b]).alias(f"n_{b}") for b in ("critical", "high", "medium", "low")],
                                           *[fixed4(F.lit(cut[c])).alias(f"cut_{c}") for c in ("critical", "high", "medium")])


_LINES_SQL = """SELECT event_id, user_id, event_type, value + 1000 * copy AS value, copy, CASE WHEN copy = 0 THEN event_id % 4 ELSE event_id * 7 % 4 END AS part, event_id * 3 + copy AS pos,
  event_id % 50 = 0 AND copy = 0 AS bad FROM events, (VALUES (0), (1)) c(copy)"""


@register("csv_first_in_file", f"""WITH l AS ({_LINES_SQL})
SELECT 'kept' AS part, event_id, user_id, event_type, {f4('value')} AS value, '' AS violations FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY part, pos) AS r FROM l WHERE NOT bad) t WHERE r = 1
UNION ALL SELECT 'quarantine', event_id, NULL, event_type, {f4('value')}, 'row:corrupt' FROM l WHERE bad""")
def q_first_in_file(spark, sf_dir):
    """S1 + V2 + D2: text files with every event twice and some bad lines; of the readable ones the first in file order stays, the bad lines go to quarantine."""
    import os
    import uuid

    from tidewatch.operators.schema import split_valid
    from tidewatch.session import checkpoint_dir
    from tidewatch.sources import io
    base = os.path.join(checkpoint_dir(spark), "tables", f"lines-{uuid.uuid4().hex}")
    e = table(spark, sf_dir, "events").withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    i, copy = F.col("event_id"), F.col("copy")
    user = F.when((i % 50 == 0) & (copy == 0), F.lit("no number")).otherwise(F.col("user_id").cast("string"))
    e = e.select(F.when(copy == 0, i % 4).otherwise(i * 7 % 4).alias("part"), (i * 3 + copy).alias("pos"), F.concat_ws(",", i, user, "event_type", F.col("value") + 1000 * copy).alias("line"))
    # files follow the order of (part, pos); their number follows the data's size, so that no task sorts a whole part
    e.repartitionByRange("part", "pos").sortWithinPartitions("part", "pos").select("line").write.text(base)
    rows = io.read_csv(spark, base, spark.createDataFrame([], "event_id long, user_id long, event_type string, value double").schema, ingest_order=True, keep_corrupt=True, header=False)
    good, bad = split_valid(rows, {})
    first = prof.drop_duplicates_keep_first(good, "event_id")
    columns = ["event_id", "user_id", "event_type", fixed4(F.col("value")).alias("value")]
    return first.select(F.lit("kept").alias("part"), *columns, F.lit("").alias("violations")).unionByName(
        bad.select(F.lit("quarantine").alias("part"), *columns, F.array_join("violations", ",").alias("violations")))


# ---------------------------------------------------------------------------
# K4 signed hashing, M6 at its optimum, M7 from an artefact, M8 learned factors
# ---------------------------------------------------------------------------
def _murmur_sql(rows: str) -> str:
    """``id``, ``h`` (signed Murmur3 of ``s``) for the rows (``id``, ``s``) of a statement."""
    m, word = 4294967296, lambda h, at, n: f"CAST('0x' || {' || '.join(f'substr({h}, {at} + {2 * j}, 2)' for j in reversed(range(n)))} AS BIGINT)"
    mix = lambda x: f"list_transform(list_transform({x}, lambda b: CAST(CAST(b AS HUGEINT) * 3432918353 % {m} AS BIGINT)), lambda a: CAST(CAST((a << 15) % {m} | (a >> 17) AS HUGEINT) * 461845907 % {m} AS BIGINT))"
    rest = " ".join(f"WHEN {r} THEN {word('hx', 'length(hx) - ' + str(2 * r) + ' + 1', r)}" for r in (1, 2, 3))
    last = "x0"
    steps = []
    for shift, factor in ((16, 2246822507), (13, 3266489909)):
        steps.append(f"(SELECT id, CAST(CAST(xor({last}, {last} >> {shift}) AS HUGEINT) * {factor} % {m} AS BIGINT) AS y FROM ")
        last = "y"
    inner = f"""(SELECT id, xor(xor(list_reduce(list_prepend(CAST(0 AS BIGINT), ks), lambda h, k: (((xor(h, k) << 13) % {m} | (xor(h, k) >> 19)) * 5 + 3864292196) % {m}), tail[1]), n) AS x0 FROM (
  SELECT id, length(hx) // 2 AS n, {mix(f"[{word('hx', '8 * i + 1', 4)} for i in range(length(hx) // 8)]")} AS ks, {mix(f"[CASE length(hx) // 2 % 4 {rest} ELSE 0 END]")} AS tail FROM (SELECT id, hex(encode(s)) AS hx FROM ({rows}) r0) r1) r2) r3"""
    return f"SELECT id, CASE WHEN xor(y, y >> 16) >= 2147483648 THEN xor(y, y >> 16) - {m} ELSE xor(y, y >> 16) END AS h FROM {steps[1]}{steps[0]}{inner}) r4) r5"


@register("signed_key_hashes", f"""WITH {keyed_sql(EVENTS_TX_SQL)},
e AS ({_murmur_sql("SELECT TransactionID AS id, 'entity_key=' || entity_key AS s FROM keyed")}),
f AS ({_murmur_sql("SELECT TransactionID AS id, 'fingerprint_key=' || fingerprint_key AS s FROM keyed")}),
b AS (SELECT id, e.h AS eh, f.h AS fh FROM e JOIN f USING (id))
SELECT id AS TransactionID, CAST(abs(eh) % 8 AS INTEGER) AS entity_index, CASE WHEN eh >= 0 THEN 1.0 ELSE -1.0 END AS entity_sign, CAST(abs(fh) % 8 AS INTEGER) AS fingerprint_index,
       CASE WHEN fh >= 0 THEN 1.0 ELSE -1.0 END AS fingerprint_sign, CASE WHEN abs(eh) % 8 = abs(fh) % 8 THEN 1 ELSE 2 END AS n_entries,
       CASE WHEN abs(eh) % 8 = abs(fh) % 8 THEN (CASE WHEN eh >= 0 THEN 1.0 ELSE -1.0 END) + (CASE WHEN fh >= 0 THEN 1.0 ELSE -1.0 END) ELSE 0.0 END AS collided, eh AS entity_hash FROM b""")
def q_signed(spark, sf_dir):
    """K4: signed Murmur3 hashes of both keys; eight buckets, so that many collide and add up."""
    from tidewatch.functions.keys import murmur3_32, signed_hashes, summed_hashes
    d = feat.add_keys(_tx(spark, sf_dir, "events"))
    d = d.select("TransactionID", signed_hashes(["entity_key", "fingerprint_key"], 8).alias("h"), murmur3_32(F.concat(F.lit("entity_key="), "entity_key")).alias("entity_hash"))
    d = d.withColumn("sums", summed_hashes(F.col("h")))
    e, f = F.col("h")[0], F.col("h")[1]
    return d.select("TransactionID", e["index"].alias("entity_index"), e["sign"].alias("entity_sign"), f["index"].alias("fingerprint_index"), f["sign"].alias("fingerprint_sign"),
                    F.size("sums").alias("n_entries"), F.when(F.size("sums") == 1, F.col("sums")[0]["value"]).otherwise(F.lit(0.0)).alias("collided"), "entity_hash")


_NET_NUM = {"TransactionAmt": (50.0, 40.0), "isFraud": (0.25, 0.5), "card1": (64.0, 32.0)}
_NET_SHAPE = (len(_NET_NUM) + 32 + 16, 256, 128, 1)


def _net_layers():
    """Weights by rule: multiples of 1/512, so that both engines hold the same numbers."""
    import numpy as np
    out = []
    for n, (a, b) in enumerate(zip(_NET_SHAPE, _NET_SHAPE[1:], strict=False)):
        i, j = np.arange(a)[:, None], np.arange(b)[None, :]
        out.append((((i * 31 + j * 17 + n * 7 + i * j) % 23 - 11) / 512.0, ((np.arange(b) * 13 + n) % 7 - 3) / 32.0))
    return out


def _net_layer_sql(n: int) -> str:
    a, b = _NET_SHAPE[n], _NET_SHAPE[n + 1]
    return (f"w{n} AS (SELECT j, list(((i * 31 + j * 17 + {n * 7} + i * j) % 23 - 11) / 512.0::DOUBLE ORDER BY i) AS w, ((j * 13 + {n}) % 7 - 3) / 32.0::DOUBLE AS b "
            f"FROM range({a}) x(i), range({b}) y(j) GROUP BY j)")


def _bucket_sql(key: str) -> str:
    h = f"md5({key})"
    word = lambda at: f"CAST('0x' || substr({h}, {at}, 8) AS BIGINT)"
    return f"(((({word(1)} % n) * 4294967296 + {word(9)}) % n * 4294967296 + {word(17)}) % n * 4294967296 + {word(25)}) % n"


@register("embedding_network_artefact", f"""WITH {keyed_sql(EVENTS_TX_SQL)}, {', '.join(_net_layer_sql(n) for n in range(3))},
n AS (SELECT max(vec_id) + 1 AS n FROM embeddings), k AS (SELECT *, {_bucket_sql('entity_key')} AS eb, {_bucket_sql('fingerprint_key')} AS fb FROM keyed, n),
x AS (SELECT TransactionID, list_concat([{', '.join(f"coalesce((CAST({c} AS DOUBLE) - {m}) / {d}, 0.0)" for c, (m, d) in _NET_NUM.items())}], list_concat(
  coalesce(CAST(e.embedding[1:32] AS DOUBLE[]), [0.0 for z in range(32)]), coalesce(CAST(f.embedding[33:48] AS DOUBLE[]), [0.0 for z in range(16)]))) AS x
  FROM k LEFT JOIN embeddings e ON e.vec_id = eb LEFT JOIN embeddings f ON f.vec_id = fb),
a AS (SELECT TransactionID, list(greatest(0.0, list_dot_product(x, w) + b) ORDER BY j) AS x FROM x, w0 GROUP BY TransactionID),
c AS (SELECT TransactionID, list(greatest(0.0, list_dot_product(x, w) + b) ORDER BY j) AS x FROM a, w1 GROUP BY TransactionID)
SELECT TransactionID, CAST(floor((list_dot_product(x, w) + b) * 1e6 / 1.5 + 0.5) AS BIGINT) AS logit_micro FROM c, w2""")
def q_artefact(spark, sf_dir):
    """M7: an artefact (both lookups of 32 and 16, 256-128-1 layers, standardised numerics) written, read by Spark, and scored with a temperature; logits to 6 digits."""
    import os
    import uuid

    from tidewatch.operators.network import load_network, network_from_tables
    from tidewatch.session import checkpoint_dir
    emb = table(spark, sf_dir, "embeddings")
    n = int(emb.agg(F.max("vec_id")).first()[0]) + 1
    part = lambda at, size: emb.select(F.col("vec_id").alias("bucket"), F.slice("embedding", at, size).alias("vec"))
    keys = {"entity_key": n, "fingerprint_key": n}
    net = network_from_tables(list(_NET_NUM), _NET_NUM, keys, {"entity_key": part(1, 32), "fingerprint_key": part(33, 16)}, {"entity_key": 32, "fingerprint_key": 16}, _net_layers())
    path = os.path.join(checkpoint_dir(spark), "tables", f"network-{uuid.uuid4().hex}")
    net.save(path)
    out = load_network(spark, path).logits(feat.add_keys(_tx(spark, sf_dir, "events")), temperature=1.5)
    return out.select("TransactionID", F.floor(F.col("logit") * 1e6 + 0.5).alias("logit_micro"))


def _check_counts(ds):
    """Rows of each part and their positives."""
    return ds.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y_ew_72h").cast("long")).alias("positives"))


_CHECK_COUNTS_SQL = f"""{_SPLIT_SQL}, y AS ({label_any_sql(EVENTS_TX_SQL)}),
n AS (SELECT split, count(*) AS n, CAST(sum(y_ew_72h) AS BIGINT) AS positives FROM parts JOIN y USING (TransactionID) GROUP BY split)"""


@register("logistic_optimum", f"""WITH {_CHECK_COUNTS_SQL}
SELECT feature, n, positives, true AS flat FROM n, (VALUES {', '.join(f"('{c}')" for c in ('(intercept)', *_COEFS))}) v(feature) WHERE split = 'train'""")
def q_optimum(spark, sf_dir):
    """M4 + M6 + M9: the fitted baseline is the optimum: the derivative of its objective by the intercept and by each coefficient, added up in SQL from its scores, is zero."""
    ds = _dataset(spark, sf_dir).select("TransactionID", "split", "y_ew_72h", *_COEFS)
    tr = ds.filter("split = 'train'")
    m = mdl.fit_baseline(tr, "y_ew_72h", list(_COEFS), cfg=LogisticConfig())
    w = prep.class_weights(tr, "y_ew_72h")
    s = prep.with_balanced_weight(m.transform(tr), w, "y_ew_72h", "w")
    off = F.col("w") * (F.col("score") - F.col("y_ew_72h"))
    beta = m.coefficients()
    slopes = [F.struct(F.lit("(intercept)").alias("feature"), (F.sum(off) / F.sum("w")).alias("g"))]
    slopes += [F.struct(F.lit(c).alias("feature"), ((F.sum(off * F.col(c)) + F.lit(beta[c])) / F.sum("w")).alias("g")) for c in _COEFS]
    g = s.agg(F.array(*slopes).alias("g")).select(F.inline("g"))
    return g.crossJoin(_check_counts(tr)).select("feature", "n", "positives", (F.abs("g") < 1e-4).alias("flat"))


_LEARNED = ("rows", "auc_roc", "avg_precision", "brier", "lift_3")


@register("learned_factors_comparison", f"""WITH {_CHECK_COUNTS_SQL}
SELECT model, split, metric, n, positives, true AS holds FROM n, (VALUES ('logistic'), ('factors')) a(model), (VALUES {', '.join(f"('{m}')" for m in _LEARNED)}) b(metric) WHERE split <> 'train'
UNION ALL SELECT 'factors', split, 'gradient', n, positives, true FROM n WHERE split = 'train'""")
def q_factors(spark, sf_dir):
    """M8 beside M6 in E8: learned factors of both keys. Each metric of the comparison is computed again from the emitted scores by plain
    window functions and must agree; the trained model's gradient must be near zero."""
    from pyspark.sql import Window

    from tidewatch.operators.factors import FactorConfig, fit_factors
    from tidewatch.session import scratch_table
    ds = _dataset(spark, sf_dir)
    tr, va = ds.filter("split = 'train'"), ds.filter("split = 'valid'")
    num = _numeric(ds)
    logistic = mdl.fit_baseline(tr, "y_ew_72h", num, cfg=LogisticConfig())
    cfg = FactorConfig(penalty=0.05, max_iter=80, patience=100, factors=4)
    factors = fit_factors(tr, va, "y_ew_72h", num, cfg=cfg)
    rest = ds.filter("split <> 'train'")
    ident = ["split", F.col("TransactionID").alias("id"), F.col("y_ew_72h").cast("int").alias("y"), F.col("score").alias("p")]
    scores = scratch_table(logistic.transform(rest).select(F.lit("logistic").alias("model"), *ident).unionByName(
        factors.transform(rest).select(F.lit("factors").alias("model"), *ident)), "learned-scores")
    cells = {m: {part: scores.filter((F.col("model") == m) & (F.col("split") == part)) for part in ("valid", "test")} for m in ("logistic", "factors")}
    lib = met.model_comparison(cells, top_pcts=(3,)).replace({"n_rows": "rows", "lift_at_3.0pct": "lift_3"}, subset=["metric"]).filter(F.col("metric").isin(list(_LEARNED)))
    cell = Window.partitionBy("model", "split")
    ranked = scores.select("*", F.row_number().over(cell.orderBy(F.desc("p"), "id")).alias("rk"), F.count(F.lit(1)).over(cell).alias("n"), F.sum("y").over(cell).alias("pos"),
                           F.avg(F.rank().over(cell.orderBy("p"))).over(Window.partitionBy("model", "split", "p")).alias("low"), F.count(F.lit(1)).over(Window.partitionBy("model", "split", "p")).alias("ties"),
                           F.sum("y").over(cell.orderBy(F.desc("p"))).alias("tp"), F.count(F.lit(1)).over(cell.orderBy(F.desc("p"))).alias("k"))
    neg = F.col("n") - F.col("pos")
    again = ranked.groupBy("model", "split", "n", "pos").agg(
        F.sum(F.when(F.col("y") == 1, F.col("low") + (F.col("ties") - 1) / 2)).alias("ranks"), F.sum(F.when(F.col("y") == 1, F.col("tp") / F.col("k"))).alias("steps"),
        F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"), F.sum(F.when(F.col("rk") <= F.floor(F.col("n") * 0.03), F.col("y"))).alias("top"))
    values = {"rows": F.col("n"), "auc_roc": (F.col("ranks") - F.col("pos") * (F.col("pos") + 1) / 2) / (F.col("pos") * neg), "avg_precision": F.col("steps") / F.col("pos"),
              "brier": F.col("brier"), "lift_3": F.col("top") / F.floor(F.col("n") * 0.03) / (F.col("pos") / F.col("n"))}
    again = again.select("model", "split", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("again")) for m, v in values.items()])))
    n = _check_counts(ds)
    checks = lib.join(again, ["model", "split", "metric"], "left").join(n, "split").select("model", "split", "metric", "n", "positives", F.coalesce(F.abs(F.col("value") - F.col("again")) < 1e-6, F.lit(False)).alias("holds"))
    gradient = n.filter("split = 'train'").select(F.lit("factors").alias("model"), "split", F.lit("gradient").alias("metric"), "n", "positives", F.lit(factors.gradient_size < 1e-3).alias("holds"))
    return checks.unionByName(gradient)


_AGREE_SQL = "SELECT split, n, positives, n AS agree FROM n WHERE split <> 'train'"


def _agreement(scored, one, other):
    """Rows and positives of each part, and the rows on which the columns ``one`` and ``other`` are equal to 9 digits."""
    return scored.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y_ew_72h").cast("long")).alias("positives"),
                                       F.count(F.when(F.abs(F.col(one) - F.col(other)) < 1e-9, 1)).alias("agree"))


@register("boosted_trees_as_columns", f"WITH {_CHECK_COUNTS_SQL} {_AGREE_SQL}")
def q_tree_columns(spark, sf_dir):
    """M8 + B5: the trees of the boosted model as one column expression give its probability on every valid and test row."""
    from pyspark.ml.functions import vector_to_array
    ds = _dataset(spark, sf_dir)
    num = _numeric(ds)
    model, _, _, prepare = mdl.fit_nonlinear(ds.filter("split = 'train'"), ds.filter("split = 'valid'"), "y_ew_72h", num, grid=({"maxDepth": 3},))
    d = model.transform(prepare(ds.filter("split <> 'train'"))).withColumn("p", vector_to_array("probability")[1])
    return _agreement(mdl.tree_scores(d, model.stages[-1], num), "p", "score")


@register("embedding_network_forward", f"WITH {_CHECK_COUNTS_SQL} {_AGREE_SQL}")
def q_network_forward(spark, sf_dir):
    """M7 + M8: the forward pass over the trained network's layers gives Spark ML's probability on every valid and test row."""
    from pyspark.ml.functions import vector_to_array
    ds = _dataset(spark, sf_dir)
    num = _numeric(ds)
    tr = ds.filter("split = 'train'")
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("bucket"), F.col("embedding").alias("vec"))
    n = int(emb.agg(F.max("bucket")).first()[0]) + 1
    x = mdl.embedding_lookup(prep.transform_numeric(ds, prep.fit_standardizer(tr, num), num), "entity_key", emb, n, "emb")
    _, weights, net = mdl.fit_embedding_mlp(x.filter("split = 'train'"), "y_ew_72h", num, "emb", 64)
    d = net.transform(mdl.embedding_features(x.filter("split <> 'train'"), num, "emb", 64)).withColumn("p", vector_to_array("probability")[1])
    d = mdl.mlp_logits(d, [*num, "emb"], weights, {"emb": 64}, activation="sigmoid", output="softmax2")
    return _agreement(d.withColumn("again", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit")))), "p", "again")


@register("linear_attributions_trained", f"""WITH {_CHECK_COUNTS_SQL}
SELECT feature, n, true AS holds FROM n, (VALUES {', '.join(f"('{c}')" for c in _COEFS)}, ('(sum)')) v(feature) WHERE split = 'test'""")
def q_attr_trained(spark, sf_dir):
    """E9 with the trained baseline: each feature's attribution equals the plain mean over rows in long form, and a row's attributions add up to its
    logit less the mean training logit, so that their absolute sums agree, too."""
    ds = _dataset(spark, sf_dir).select("TransactionID", "split", "y_ew_72h", *_COEFS)
    tr, te = ds.filter("split = 'train'"), ds.filter("split = 'test'")
    num = list(_COEFS)
    m = mdl.fit_baseline(tr, "y_ew_72h", num, cfg=LogisticConfig())
    beta = m.coefficients()
    lib = met.linear_attributions(prep.apply_median_scaler(te, m.scaler, num), prep.apply_median_scaler(tr, m.scaler, num), beta)
    scaled = prep.apply_median_scaler(ds.filter("split <> 'valid'"), m.scaler, num)
    long = scaled.select("split", "TransactionID", F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("x"), F.lit(beta[c]).alias("b")) for c in num])))
    mean = F.broadcast(long.filter("split = 'train'").groupBy("feature").agg(F.avg("x").alias("mean")))      # a row for each feature
    each = long.filter("split = 'test'").join(mean, "feature").withColumn("phi", F.col("b") * (F.col("x") - F.col("mean")))
    again = each.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs("phi")).alias("again"))
    checks = again.join(lib, "feature").select("feature", "n", (F.abs(F.col("again") - F.col("mean_abs_attribution")) < 1e-9).alias("holds"))
    logits = m.transform(ds.filter("split <> 'valid'")).select("split", "TransactionID", "logit")
    base = F.broadcast(logits.filter("split = 'train'").agg(F.avg("logit").alias("base")))
    sums = each.groupBy("TransactionID").agg(F.sum("phi").alias("phi")).join(logits.filter("split = 'test'").crossJoin(base), "TransactionID")
    total = sums.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("phi") - (F.col("logit") - F.col("base")))).alias("gap"))
    return checks.unionByName(total.select(F.lit("(sum)").alias("feature"), "n", (F.col("gap") < 1e-9).alias("holds")))


# ---------------------------------------------------------------------------
# ST1 with quarantine, ST3 and ST4 in several micro-batches
# ---------------------------------------------------------------------------
_RULED_SQL = """SELECT event_id AS id, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN -1.0 ELSE value END AS value, CASE WHEN event_id % 29 = 0 THEN NULL ELSE user_id END AS user_id FROM events"""


@register("online_scoring_quarantine", f"""WITH r AS ({_RULED_SQL}), v AS (SELECT *, concat_ws(',', CASE WHEN value IS NULL OR NOT value > 0 THEN 'value:gt0' END, CASE WHEN user_id IS NULL THEN 'user_id:required' END) AS violations,
  1.0 / (1.0 + exp(-((value - 50.0) / 40.0))) AS p FROM r)
SELECT id, {f4('p')} AS score, CASE WHEN violations <> '' THEN 'low' WHEN p >= 0.9528 THEN 'critical' WHEN p >= 0.9121 THEN 'high' WHEN p >= 0.7430 THEN 'medium' ELSE 'low' END AS risk_band,
  violations, CASE WHEN violations = '' THEN 'scored' ELSE 'rejected' END AS part FROM v""")
def q_stream_quarantine(spark, sf_dir):
    """ST1 + V2 in eight micro-batches: scored and rejected rows in one write a batch; the sink runs every third batch twice, as after a lost driver: no row is lost or doubled."""
    import os
    import uuid

    from tidewatch.session import checkpoint_dir
    i = F.col("event_id")
    ev = _arriving(spark, sf_dir).select(i.alias("id"), F.when(i % 13 == 0, F.lit(None)).when(i % 17 == 0, F.lit(-1.0)).otherwise(F.col("value")).alias("value"),
                                         F.when(i % 29 != 0, F.col("user_id")).alias("user_id"))
    s = st.score_stream(ev, lambda d: d.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-((F.col("value") - 50.0) / 40.0)))), rules={"value": "gt0", "user_id": "required"})
    base = os.path.join(checkpoint_dir(spark), "streams", f"quarantine-{uuid.uuid4().hex}")
    once = st.scored_sink(os.path.join(base, "rows"))

    def twice(batch, number):
        for _ in range(2 if number % 3 == 0 else 1):
            once(batch, number)

    scored, rejected = st.run_scoring(s, base, twice)
    columns = ["id", fixed4(F.col("score")).alias("score"), "risk_band", F.array_join("violations", ",").alias("violations")]
    return scored.select(*columns, F.lit("scored").alias("part")).unionByName(rejected.select(*columns, F.lit("rejected").alias("part")))


@register("dedup_stream_batches", "SELECT event_id, user_id, event_type, value FROM events")
def q_stream_dedup_batches(spark, sf_dir):
    """ST3 in eight micro-batches: every event comes in two files, one after the other, so that only state kept across batches can drop the repeats."""
    import os
    import uuid

    from tidewatch.session import checkpoint_dir
    base = os.path.join(checkpoint_dir(spark), "tables", f"again-{uuid.uuid4().hex}")
    e = table(spark, sf_dir, "events")
    first, last = e.agg(F.min(epoch_seconds("ts")), F.max(epoch_seconds("ts"))).first()
    part = F.floor((epoch_seconds("ts") - first) * 7 / (last - first + 1)).cast("int")
    for k in range(8):
        e.filter(part.isin(k - 1, k)).coalesce(1).write.mode("append").parquet(base)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(base).withColumn("_ts", F.timestamp_seconds(epoch_seconds("ts")))
    return st.run_to_table(st.dedup_stream(stream, "event_id", "_ts", "20 days").select("event_id", "user_id", "event_type", "value"), "st3-batches")


@register("band_traffic_stream_batches", REGISTRY["band_traffic_stream"][1])
def q_stream_traffic_batches(spark, sf_dir):
    """ST4 over eight micro-batches out of order: windows grow from batch to batch, the last state of each is the batch result."""
    s = st.score_stream(_arriving(spark, sf_dir), lambda d: cal.apply_temperature(d.withColumn("logit", (F.col("value") - 50.0) / 40.0), 1.5, "logit", "score"))
    s = s.withColumn("_ts", F.timestamp_seconds(epoch_seconds("ts"))).withColumn("y", (F.col("event_type") == "error").cast("int"))
    out = st.run_to_latest(st.band_traffic(s, "_ts", "y", "1 hour", "10 minutes", "6 days"), "st4-batches", ["window", "risk_band"])
    return out.select(F.unix_seconds(F.col("window.start")).alias("window_start"), "risk_band", "rows", "positives")


# ---------------------------------------------------------------------------
# A3, A8, A9 audit; S4-S7 reports and artefacts; P3, M3 contracts; F1, F2 parts; O4 head
# ---------------------------------------------------------------------------
_AUDIT_NUM = ("TransactionAmt", "card1")


def _cells(section: str, item: str, cells, source: str, text: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"""SELECT '{section}' AS section, {item} AS item, x.metric AS metric, {f4('x.value')} AS value, text FROM (SELECT *, {text} AS text, {_stacked(cells)} AS x FROM {source}) q"""


_AUDIT_SQL = f"""WITH tx AS ({EVENTS_TX_SQL}), """ + f"""num AS ({' UNION ALL '.join(f"SELECT '{c}' AS c, avg(CAST({c} IS NULL AS DOUBLE)) * 100.0 AS m, min({c}) AS lo, max({c}) AS hi, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS a, quantile_cont(CAST({c} AS DOUBLE), 0.95) AS b, quantile_cont(CAST({c} AS DOUBLE), 0.99) AS d FROM tx" for c in _AUDIT_NUM)}),
miss AS ({' UNION ALL '.join(f"SELECT '{c}' AS c, avg(CAST({c} IS NULL AS DOUBLE)) * 100.0 AS m FROM tx" for c in ("TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "card1", "P_emaildomain", "DeviceInfo"))}),
cat AS (SELECT *, row_number() OVER (ORDER BY n DESC, v) AS r FROM (SELECT coalesce(P_emaildomain, '<NA>') AS v, count(*) AS n FROM tx GROUP BY 1)),
typ AS (SELECT * FROM (VALUES ('TransactionID', 'bigint'), ('TransactionDT', 'bigint'), ('TransactionAmt', 'double'), ('isFraud', 'int'), ('card1', 'bigint'), ('DeviceInfo', 'string'), ('P_emaildomain', 'string')) v(c, t))
{_cells('shape', "''", [("rows", "count(*)"), ("columns", "7"), ("present_keys", "7"), ("missing_keys", "8")], 'tx').replace('SELECT *, CAST', 'SELECT CAST')}
UNION ALL {_cells('dtypes', 'c', [("present", "1")], 'typ', 't')}
UNION ALL {_cells('time', "''", [("transaction_dt_min", "min(TransactionDT)"), ("transaction_dt_max", "max(TransactionDT)"), ("transaction_dt_missing_pct", "avg(CAST(TransactionDT IS NULL AS DOUBLE)) * 100.0")], 'tx').replace('SELECT *, CAST', 'SELECT CAST')}
UNION ALL {_cells('label', "''", [("isFraud_missing_pct", "avg(CAST(isFraud IS NULL AS DOUBLE)) * 100.0"), ("isFraud_rate_pct", "avg(isFraud) * 100.0")], 'tx').replace('SELECT *, CAST', 'SELECT CAST')}
UNION ALL {_cells('label_counts', 'CAST(v AS VARCHAR)', [("count", "n")], '(SELECT isFraud AS v, count(*) AS n FROM tx GROUP BY 1) l')}
UNION ALL {_cells('missingness', 'c', [("missing_pct", "m")], 'miss')}
UNION ALL {_cells('coverage', "''", [("rows_with_any_identity_pct", "avg(CAST(DeviceInfo IS NOT NULL AS DOUBLE)) * 100.0")], 'tx').replace('SELECT *, CAST', 'SELECT CAST')}
UNION ALL {_cells('numeric', 'c', [("missing_pct", "m"), ("min", "lo"), ("max", "hi"), ("p50", "a"), ("p95", "b"), ("p99", "d")], 'num')}
UNION ALL {_cells('categories', "'P_emaildomain'", [("count", "n"), ("rank", "r")], '(SELECT * FROM cat WHERE r <= 10) t', 'v')}"""


@register("audit_report", _AUDIT_SQL)
def q_audit(spark, sf_dir):
    """A3 + A8 + A9 (and A1, A4-A7, J2 inside): the audit report as one table."""
    a = prof.audit_table(_tx(spark, sf_dir, "events"))
    return a.select("section", "item", "metric", fixed4(F.col("value")).alias("value"), "text")


@register("json_report_round_trip", f"""SELECT user_id, count(*) AS n, {f4('avg(value)')} AS mean, CAST(NULL AS DOUBLE) AS endless, CASE WHEN user_id % 2 = 0 THEN {f4('max(value)')} END AS top FROM events GROUP BY user_id""")
def q_json(spark, sf_dir):
    """S4 + S5 + S6: a report of every user as JSON at a place of the layout, NaN and infinity as null, read back."""
    import os
    import uuid

    from tidewatch.session import checkpoint_dir
    from tidewatch.sources import io
    paths = io.DataPaths(reports=os.path.join(checkpoint_dir(spark), "tables", f"reports-{uuid.uuid4().hex}"))
    r = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.lit(float("inf")).alias("endless"),
                                                             F.when(F.col("user_id") % 2 == 0, F.max("value")).otherwise(F.lit(float("nan"))).alias("top"))
    io.write_json_report(r, paths.path("reports", "users"))
    back = spark.read.schema(r.schema).json(paths.path("reports", "users"))
    return back.select("user_id", "n", fixed4(F.col("mean")).alias("mean"), "endless", fixed4(F.col("top")).alias("top"))


@register("temperature_artefact", REGISTRY["calibration_report"][1])
def q_temperature_artefact(spark, sf_dir):
    """S7 + M11 + M12: a temperature written as JSON, loaded and applied; an absent or invalid artefact is none."""
    import os
    import uuid

    from tidewatch.session import checkpoint_dir
    from tidewatch.sources import io
    base = os.path.join(checkpoint_dir(spark), "tables", f"temperature-{uuid.uuid4().hex}")
    for name, t in (("good", 1.5), ("bad", -2.0)):
        spark.createDataFrame([(t,)], "temperature double").coalesce(1).write.json(os.path.join(base, name))
    t = io.load_temperature(os.path.join(base, "good"))
    if io.load_temperature(os.path.join(base, "absent")) is not None or io.load_temperature(os.path.join(base, "bad")) is not None:
        raise ValueError("an absent or invalid artefact gave a temperature")
    r = cal.calibration_report(_scored(spark, sf_dir), t, "logit", "y")
    return r.select(*[fixed4(F.col(c)).alias(c) for c in r.columns])


@register("feature_contract", f"""WITH e AS ({entity_features_sql(EVENTS_TX_SQL)}), f AS ({fingerprint_features_sql(EVENTS_TX_SQL)}), j AS (SELECT * FROM e JOIN f USING (TransactionID)), t AS ({EVENTS_TX_SQL})
SELECT 'numeric' AS kind, 'TransactionAmt' AS "column", count(TransactionAmt) AS present FROM t
UNION ALL {' UNION ALL '.join(f"SELECT 'numeric', '{c}', count({c}) FROM j" for c in (*_VELOCITY_COLUMNS, *_CAMPAIGN_COLUMNS))}
UNION ALL SELECT 'key', 'entity_key', count(*) FROM t UNION ALL SELECT 'key', 'fingerprint_key', count(*) FROM t
UNION ALL SELECT 'other', 'TransactionID', count(TransactionID) FROM t UNION ALL SELECT 'other', 'TransactionDT', count(TransactionDT) FROM t
UNION ALL SELECT 'other', 'P_emaildomain', count(P_emaildomain) FROM t UNION ALL SELECT 'other', 'DeviceInfo', count(DeviceInfo) FROM t""")
def q_contract(spark, sf_dir):
    """P3 + M3: the columns that a model may use and those of its contract, with the rows that have a value."""
    from tidewatch.operators.schema import feature_columns
    d = feat.build_features(_tx(spark, sf_dir, "events"))
    m = prep.feature_schema(d)
    kind = lambda c: "numeric" if c in m["numeric_cols"] else "key" if c in m["key_cols"] else "other"
    columns = feature_columns(d)
    counts = d.agg(*[F.count(c).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(kind(c)).alias("kind"), F.lit(c).alias("column"), F.col(c).alias("present")) for c in columns])))


@register("valid_and_test_rows", f"""WITH {_SPLIT_SQL} SELECT TransactionID, split FROM parts WHERE split <> 'train'""")
def q_parts(spark, sf_dir):
    """F1 + F2: the rows of the valid and the test part, neither of them empty."""
    from tidewatch.operators.schema import require_nonempty, split_filter
    d = spl.time_split(_tx(spark, sf_dir, "events"))
    for part in ("valid", "test"):
        require_nonempty(split_filter(d, part), part)
    return split_filter(d, "valid", "test").select("TransactionID", "split")


@register("head_by_time", f"""SELECT TransactionID, TransactionDT FROM ({EVENTS_TX_SQL}) t ORDER BY TransactionDT, TransactionID LIMIT 100""")
def q_head(spark, sf_dir):
    """The first hundred rows by time and id -- a head sample."""
    return bnd.head_sample(_tx(spark, sf_dir, "events").select("TransactionID", "TransactionDT"), 100, ["TransactionDT", "TransactionID"])


@register("missing_pct_whole_table", f"""WITH j AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
{' UNION ALL '.join(f"""SELECT '{c}' AS "column", {f4(f'avg(CAST({c} IS NULL AS DOUBLE)) * 100.0')} AS missing_pct FROM j""" for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"))}""")
def q_missing_whole(spark, sf_dir):
    """A1: missing % of every column of the joined table, texts included."""
    m = prof.missing_pct(_docs_labels(spark, sf_dir))
    return m.select("column", fixed4(F.col("missing_pct")).alias("missing_pct"))


@register("csv_round_trip_texts", "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def q_csv_texts(spark, sf_dir):
    """S1 + S3 on whole documents: quotes, line breaks, empty texts and nulls survive CSV and Parquet."""
    import os
    import uuid

    from tidewatch.session import checkpoint_dir
    from tidewatch.sources import io
    base = os.path.join(checkpoint_dir(spark), "tables", f"texts-{uuid.uuid4().hex}")
    d = table(spark, sf_dir, "documents")
    quoting = {"quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    d.write.option("header", True).options(**quoting, lineSep="\n").csv(os.path.join(base, "csv"))
    rows = io.read_csv(spark, os.path.join(base, "csv"), d.schema, multiLine=True, **quoting)
    io.write_parquet(rows, os.path.join(base, "parquet"))
    return io.read_parquet(spark, os.path.join(base, "parquet")).select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")
