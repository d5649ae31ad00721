"""M7: scoring with a stored embedding network.

An artefact is a folder that Spark reads and writes:

* ``meta``: one JSON row: numeric columns with their means and deviations, key
  columns with the buckets of their hash, and the widths of their vectors;
* ``embeddings``: Parquet rows (``key``, ``bucket``, ``vec``);
* ``dense``: Parquet rows (``layer``, ``row``, ``weights``), row -1 the biases.

The vectors grow with the buckets and stay a table, looked up by joins (J4); the dense
layers are fixed by their widths and go to the tasks once.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.models import embedding_lookup, mlp_logits
from tidewatch.operators.schema import require_columns


@dataclass
class EmbeddingNetwork:
    """Numerics, standardised, and the vectors of hashed keys feed dense ReLU layers that end in one logit."""

    numeric: list
    means: dict
    stds: dict
    buckets: dict                   # key column -> buckets of its hash
    widths: dict                    # key column -> length of its vectors
    embeddings: DataFrame           # key, bucket, vec
    dense: list                     # (weights, biases) by layer

    def __post_init__(self) -> None:
        inputs = len(self.numeric) + sum(self.widths[k] for k in self.buckets)
        for w, b in self.dense:
            if np.shape(w) != (inputs, len(b)):
                raise ValueError(f"a layer of {np.shape(w)} weights doesn't fit {inputs} inputs and {len(b)} biases")
            inputs = len(b)
        if inputs != 1:
            raise ValueError("the last layer has one output")

    def save(self, path: str) -> None:
        spark = self.embeddings.sparkSession
        meta = [(self.numeric, [float(self.means[c]) for c in self.numeric], [float(self.stds[c]) for c in self.numeric], list(self.buckets),
                 [int(self.buckets[k]) for k in self.buckets], [int(self.widths[k]) for k in self.buckets])]
        spark.createDataFrame(meta, _META).coalesce(1).write.mode("overwrite").json(os.path.join(path, "meta"))
        self.embeddings.select("key", "bucket", F.col("vec").cast("array<double>").alias("vec")).write.mode("overwrite").parquet(os.path.join(path, "embeddings"))
        rows = [(n, r, [float(v) for v in values]) for n, (w, b) in enumerate(self.dense) for r, values in [(-1, b), *enumerate(np.asarray(w))]]
        spark.createDataFrame(rows, _DENSE).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "dense"))

    def logits(self, df: DataFrame, temperature: float | None = None) -> DataFrame:
        """Adds ``logit`` (divided by a positive ``temperature``) and ``score``. Raises if a column is missing; a missing or
        unreadable numeric is the mean, a null key hashes as no characters, and a bucket without a vector counts as zeros."""
        require_columns(df, [*self.buckets, *self.numeric], "network scoring")
        d = df.select("*", *[F.coalesce((F.expr(f"try_cast(`{c}` AS double)") - F.lit(float(self.means[c]))) / F.lit(float(self.stds[c])), F.lit(0.0)).alias(f"__x{i}")
                             for i, c in enumerate(self.numeric)])
        for i, (key, buckets) in enumerate(self.buckets.items()):
            d = embedding_lookup(d, key, self.embeddings.filter(F.col("key") == key), buckets, f"__e{i}")
        inputs = [f"__x{i}" for i in range(len(self.numeric))] + [f"__e{i}" for i in range(len(self.buckets))]
        d = mlp_logits(d, inputs, self.dense, {f"__e{i}": self.widths[k] for i, k in enumerate(self.buckets)}, out="logit", precision="double")
        z = F.col("logit") / temperature if temperature is not None and temperature > 0 else F.col("logit")
        return d.select(*df.columns, z.alias("logit")).withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit"))))


_META = "numeric array<string>, means array<double>, stds array<double>, keys array<string>, buckets array<int>, widths array<int>"
_DENSE = "layer int, row int, weights array<double>"


def load_network(spark: SparkSession, path: str) -> EmbeddingNetwork:
    """Read an artefact; a missing path raises (``PATH_NOT_FOUND``)."""
    m = spark.read.schema(_META).json(os.path.join(path, "meta")).first()
    layers: dict[int, dict[int, Sequence[float]]] = {}
    for r in spark.read.schema(_DENSE).parquet(os.path.join(path, "dense")).collect():      # fixed by the layers' widths
        layers.setdefault(r.layer, {})[r.row] = r.weights
    dense = [(np.array([layers[n][i] for i in range(len(layers[n]) - 1)]), np.array(layers[n][-1])) for n in sorted(layers)]
    by = lambda names, values: dict(zip(names, values, strict=True))
    return EmbeddingNetwork(list(m.numeric), by(m.numeric, m.means), by(m.numeric, m.stds), by(m["keys"], m.buckets), by(m["keys"], m.widths),
                            spark.read.parquet(os.path.join(path, "embeddings")), dense)


def network_from_tables(numeric: Sequence[str], stats: Mapping[str, tuple[float, float]], buckets: Mapping[str, int],
                        tables: Mapping[str, DataFrame], widths: Mapping[str, int], dense: Sequence) -> EmbeddingNetwork:
    """A network from one table (``bucket``, ``vec``) for each key."""
    every = None
    for key, t in tables.items():
        t = t.select(F.lit(key).alias("key"), F.col("bucket").cast("int").alias("bucket"), F.col("vec").cast("array<double>").alias("vec"))
        every = t if every is None else every.unionByName(t)
    return EmbeddingNetwork(list(numeric), {c: stats[c][0] for c in numeric}, {c: stats[c][1] for c in numeric}, dict(buckets), dict(widths), every, list(dense))
