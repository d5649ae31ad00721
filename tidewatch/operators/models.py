"""Models: baseline logistic regression, non-linear model, embedding scoring.

Training uses Spark ML estimators (distributed L-BFGS / tree boosting); the
feature preparation reuses the exact, train-only operators of :mod:`prep`.
Scoring a fitted embedding network is the one place with Python in a task:
embedding vectors are fetched with an equi-join on the hashed bucket (J4),
and the dense layers run in an Arrow-batched pandas UDF (numpy matmul on
whole batches, weights shipped once as a broadcast variable).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import HASHED_FEATURES, LogisticConfig
from tidewatch.functions.keys import signed_hashes, stable_hash_bucket, summed_hashes
from tidewatch.operators import prep
from tidewatch.session import scratch_table


def sparse_vectors(df: DataFrame, size: int, indices: Column, values: Column, out: str) -> DataFrame:
    """Written copy of ``df`` with the sparse ML vector ``out`` of ascending ``indices`` and their ``values``. (A vector column
    made of arrays is declared when the table is read back; no Python takes part.)"""
    from pyspark.ml.linalg import VectorUDT
    vec = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(int(size)).alias("size"), indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))
    return scratch_table(df.withColumn(out, vec), "vectors", lambda schema: T.StructType([T.StructField(f.name, VectorUDT()) if f.name == out else f for f in schema]))


@dataclass
class BaselineModel:
    numeric: list
    categorical: list
    keys: list
    scaler: DataFrame
    modes: DataFrame
    encoder: object           # fitted pyspark.ml PipelineModel: numerics and one-hot columns in one vector ``dense``
    intercept: float
    weights: np.ndarray       # of the dense part
    hashed: DataFrame | None  # (index, weight) of the hashed keys, those that aren't zero

    def prepared(self, df: DataFrame) -> DataFrame:
        """``df`` imputed and scaled, with the array ``_dense`` of its numeric and one-hot inputs."""
        from pyspark.ml.functions import vector_to_array
        d = prep.apply_median_scaler(df, self.scaler, self.numeric) if self.numeric else df
        d = prep.impute_modes(d, self.modes, self.categorical) if self.categorical else d
        d = self.encoder.transform(d).withColumn("_dense", vector_to_array("dense"))
        return d.drop("dense", *[c for c in d.columns if c.endswith("__idx") or c.endswith("__oh")])

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``logit`` and ``score`` (P(y=1)); weights of hashed keys come by joins on their index."""
        d = self.prepared(df)
        w = F.array(*[F.lit(float(x)) for x in self.weights])
        logit = F.lit(self.intercept) + F.aggregate(F.zip_with("_dense", w, lambda x, b: x * b), F.lit(0.0), lambda acc, x: acc + x)
        for i, k in enumerate(self.keys):
            h = signed_hashes([k], HASHED_FEATURES)[0]
            t = self.hashed.select(F.col("index").alias(f"_i{i}"), F.col("weight").alias(f"_w{i}"))
            d = d.withColumn(f"_h{i}", h).withColumn(f"_i{i}", F.col(f"_h{i}.index")).join(F.broadcast(t), f"_i{i}", "left")   # at most HASHED_FEATURES rows
            logit = logit + F.coalesce(F.col(f"_h{i}.sign") * F.col(f"_w{i}"), F.lit(0.0))
        d = d.withColumn("logit", logit).withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit"))))
        return d.drop("_dense", *[f"_{c}{i}" for c in "hiw" for i in range(len(self.keys))])

    def coefficients(self) -> dict:
        """Numeric-slice coefficients (for linear attributions, E9)."""
        return {c: float(self.weights[i]) for i, c in enumerate(self.numeric)}


def fit_baseline(train: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                 keys: Sequence[str] = (), cfg: LogisticConfig = LogisticConfig()) -> BaselineModel:
    """M4 + M5 + K4 + M9 + M6: median/scale numerics, mode/one-hot categoricals,
    signed hashed keys, balanced class weights, L2 logistic regression.

    The penalty matches ``C * sum(w_i * loss_i) + ||beta||^2 / 2`` by
    ``regParam = 1 / (C * sum(w))`` on Spark's weight-normalised objective.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    numeric, categorical, keys = list(numeric), list(categorical), list(keys)
    scaler = prep.fit_median_scaler(train, numeric) if numeric else None
    modes = prep.fit_modes(train, categorical) if categorical else None
    d = prep.apply_median_scaler(train, scaler, numeric) if numeric else train
    d = prep.impute_modes(d, modes, categorical) if categorical else d
    weights = prep.class_weights(d, y)
    d = prep.with_balanced_weight(d, weights, y, "_w")
    sw = d.agg(F.sum("_w")).first()[0]
    stages = prep.one_hot_pipeline(categorical) if categorical else []
    stages.append(VectorAssembler(inputCols=numeric + [f"{c}__oh" for c in categorical], outputCol="dense", handleInvalid="keep"))
    encoder = Pipeline(stages=stages).fit(d)
    d = encoder.transform(d)
    width = int(d.schema["dense"].metadata["ml_attr"]["num_attrs"])
    d = d.withColumn(y, F.col(y).cast("double"))
    if keys:
        d = d.select(y, "_w", vector_to_array("dense").alias("_dense"), summed_hashes(signed_hashes(keys, HASHED_FEATURES)).alias("_keys"))
        places = F.concat(F.sequence(F.lit(0), F.lit(width - 1)), F.transform("_keys", lambda e: e["index"] + width))
        d = sparse_vectors(d, width + HASHED_FEATURES, places, F.concat("_dense", F.transform("_keys", lambda e: e["value"])), "features")
    else:
        d = d.select(y, "_w", F.col("dense").alias("features"))
    lr = LogisticRegression(featuresCol="features", labelCol=y, weightCol="_w", regParam=1.0 / (cfg.C * sw), elasticNetParam=0.0, standardization=False,
                            maxIter=cfg.max_iter, tol=1e-6).fit(d)
    beta = lr.coefficients.toArray()
    hashed = None
    if keys:
        at = np.flatnonzero(beta[width:])
        hashed = scratch_table(train.sparkSession.createDataFrame([(int(i), float(beta[width + i])) for i in at], "index int, weight double"), "hashed-weights")
    return BaselineModel(numeric, categorical, keys, scaler, modes, encoder, float(lr.intercept), beta[:width].copy(), hashed)


def fit_nonlinear(train: DataFrame, valid: DataFrame, y: str, numeric: Sequence[str],
                  grid: Sequence[Mapping] = ({"maxDepth": 3}, {"maxDepth": 5}), seed: int = 42, rounds: int = 20):
    """M8 re-aim: class-weighted gradient-boosted trees on median-imputed numerics; the
    grid point with the best validation average precision wins.

    Returns ``(model, best_params, best_ap, prepare)`` where ``prepare(df)``
    applies the train-fitted imputation before ``model.transform``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from tidewatch.operators.metrics import binary_metrics
    from pyspark.ml.functions import vector_to_array
    numeric = list(numeric)
    scaler = prep.fit_median_scaler(train, numeric)

    def prepare(df):
        return prep.apply_median_scaler(df, scaler, numeric)

    weights = prep.class_weights(train, y)
    tr = prep.with_balanced_weight(prepare(train), weights, y, "_w").withColumn(y, F.col(y).cast("double"))
    valid = prepare(valid)
    best = (None, None, -1.0, prepare)
    for params in grid:
        pipe = Pipeline(stages=[VectorAssembler(inputCols=numeric, outputCol="features", handleInvalid="keep"),
                                GBTClassifier(featuresCol="features", labelCol=y, weightCol="_w", seed=seed,
                                              maxIter=rounds, **params)])
        m = pipe.fit(tr)
        sc = m.transform(valid).withColumn("p", vector_to_array("probability")[1])
        sc = scratch_table(sc.select(F.col(y).cast("int").alias("_y"), "p"), "valid-scores")     # read twice, scored once
        ap = binary_metrics(sc, "_y", "p").first().avg_precision or 0.0
        if ap > best[2]:
            best = (m, dict(params), ap, prepare)
    return best


def tree_scores(df: DataFrame, model, inputs: Sequence[str], out: str = "score") -> DataFrame:
    """``df`` with ``out``, the probability that fitted boosted trees give, as one column expression over the ``inputs`` in the order of
    the model's vector: nested cases, no vector column and no stage of the ML library. A missing input takes the branch above the
    threshold, as NaN does. The expression grows with the trees, which the fit bounds."""
    def cases(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(node.prediction()))
        split = node.split()
        left = F.col(inputs[split.featureIndex()]).cast("double") <= F.lit(float(split.threshold()))
        return F.when(left, cases(node.leftChild())).otherwise(cases(node.rightChild()))

    margin = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        margin = margin + F.lit(float(weight)) * cases(tree._call_java("rootNode"))
    return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-2.0 * margin)))


def embedding_lookup(df: DataFrame, key: str, table: DataFrame, buckets: int, out: str,
                     bucket_col: str = "bucket", vec_col: str = "vec") -> DataFrame:
    """Hashed key bucket -> embedding vector via an equi-join (missing bucket -> null).

    The embedding table grows with ``buckets`` (2^20 x 32 floats is ~130 MB), so
    the join is left to AQE (broadcast only if it is small at runtime); a hot
    key makes one bucket hot on the big side, which AQE's skew split handles.
    """
    b = f"_{out}_bucket"
    d = df.withColumn(b, stable_hash_bucket(key, buckets))
    t = table.select(F.col(bucket_col).cast("int").alias(b), F.col(vec_col).alias(out))
    return d.join(t, b, "left").drop(b)


def mlp_weights_from_spark(model, layers: Sequence[int]) -> list:
    """Unpack a fitted ``MultilayerPerceptronClassificationModel``: per layer a row-major
    (n_in x n_out) matrix followed by its biases."""
    w = np.asarray(model.weights.toArray(), dtype=np.float64)
    out, off = [], 0
    for a, b in zip(layers[:-1], layers[1:]):
        W = w[off: off + a * b].reshape((a, b))
        off += a * b
        out.append((W, w[off: off + b]))
        off += b
    return out


def mlp_logits(df: DataFrame, input_cols: Sequence[str], weights: Sequence[tuple[np.ndarray, np.ndarray]],
               widths: Mapping[str, int] | None = None, out: str = "logit", activation: str = "relu",
               output: str = "single", precision: str = "float") -> DataFrame:
    """M7 dense part: ``concat(inputs) -> [act(xW + b)]* -> xW + b`` per Arrow batch.

    ``precision``: ``float`` or ``double`` (always for ``sigmoid``).
    ``activation``: ``relu`` (the reference network) or ``sigmoid`` (Spark ML's
    MLP). ``output``: ``single`` (one logit) or ``softmax2`` (two class scores,
    logit = z1 - z0).

    ``input_cols`` are numeric columns or ``array<float>`` columns (embeddings,
    width given in ``widths``), concatenated in order; a missing value or
    vector becomes zeros of its width, so every row has the same layout.
    """
    widths = dict(widths or {})
    spark = df.sparkSession
    double = activation == "sigmoid" or precision == "double"       # Spark ML's MLP: float64 to reproduce it exactly
    layers = [tuple(np.asarray(v, dtype=np.float64 if double else np.float32) for v in layer) for layer in weights]
    et = "double" if double else "float"
    parts, n_in = [], 0
    for c in input_cols:
        if isinstance(df.schema[c].dataType, T.ArrayType):
            w = widths[c]
            parts.append(F.coalesce(F.col(c).cast(f"array<{et}>"), F.array_repeat(F.lit(0.0).cast(et), w)))
            n_in += w
        else:
            parts.append(F.array(F.coalesce(F.col(c).cast(et), F.lit(0.0).cast(et))))
            n_in += 1
    if layers[0][0].shape[0] != n_in:
        raise ValueError(f"first layer expects {layers[0][0].shape[0]} inputs, got {n_in}")
    bc = spark.sparkContext.broadcast(layers)
    dt = layers[0][0].dtype

    @F.pandas_udf(T.DoubleType())
    def _forward(x: pd.Series) -> pd.Series:
        h = np.vstack(x.values).astype(dt, copy=False) if len(x) else np.zeros((0, n_in), dt)
        ls = bc.value
        for j, (W, b) in enumerate(ls):
            h = h @ W + b
            if j < len(ls) - 1:
                h = np.maximum(h, 0.0) if activation == "relu" else 1.0 / (1.0 + np.exp(-h))
        z = h[:, 1] - h[:, 0] if output == "softmax2" else h[:, 0]
        return pd.Series(z.astype(np.float64))

    flat = F.concat(*parts) if len(parts) > 1 else parts[0]
    return df.withColumn(out, _forward(flat))


def embedding_features(df: DataFrame, numeric: Sequence[str], emb_col: str, emb_dim: int, out: str = "features") -> DataFrame:
    """[numerics || looked-up embedding] as one vector; missing parts are zeros."""
    from pyspark.ml.functions import array_to_vector
    vec = F.concat(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric]),
                   F.coalesce(F.col(emb_col).cast("array<double>"), F.array_repeat(F.lit(0.0), emb_dim)))
    return df.withColumn(out, array_to_vector(vec))


def fit_embedding_mlp(train: DataFrame, y: str, numeric: Sequence[str], emb_col: str, emb_dim: int,
                      hidden: Sequence[int] = (16,), seed: int = 42, max_iter: int = 100):
    """M8-style training of a network on [numerics || looked-up embedding] with Spark ML's
    distributed MLP; returns ``(layers, weights, model)``. Score with ``model.transform`` on
    :func:`embedding_features`; ``weights`` are for :func:`mlp_logits`."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    numeric = list(numeric)
    d = embedding_features(train, numeric, emb_col, emb_dim).select("features", F.col(y).cast("double").alias("label"))
    layers = [len(numeric) + emb_dim, *hidden, 2]
    m = MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed).fit(d)
    return layers, mlp_weights_from_spark(m, layers), m
