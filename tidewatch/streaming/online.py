"""Structured Streaming re-aims (ST1-ST4).

* ST1 ``score_stream``: stateless micro-batch scoring with frozen cutoffs
  (validation -> scorer -> temperature -> bands), any stream source/sink.
* ST2 ``velocity_stream`` and ``campaign_stream``: see :mod:`tidewatch.streaming.velocity`.
* ST3 ``dedup_stream``: ``dropDuplicatesWithinWatermark`` on the id.
* ST4 ``band_traffic``: sliding-window traffic and alert counts per band.
"""

from __future__ import annotations

from typing import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import SERVING_CUTOFFS
from tidewatch.operators.bands import band_action, band_expr
from tidewatch.operators.schema import check_constraints
from tidewatch.streaming.velocity import campaign_stream, velocity_stream  # noqa: F401


def score_stream(events: DataFrame, scorer: Callable[[DataFrame], DataFrame],
                 cutoffs: Mapping[str, float] = SERVING_CUTOFFS, rules: Mapping[str, str] | None = None) -> DataFrame:
    """ST1: per-row validation (``violations``), score, frozen-cutoff band and action.

    ``scorer`` appends a ``score`` column (e.g. a fitted model's transform or a
    temperature-scaled logit); invalid rows are kept with their violations and
    band ``low`` so nothing is silently dropped.
    """
    d = check_constraints(events, rules) if rules is not None else events.withColumn(
        "violations", F.array().cast("array<string>"))
    d = scorer(d)
    band = F.when(F.size("violations") > 0, F.lit("low")).otherwise(
        band_expr(F.col("score"), cutoffs["critical"], cutoffs["high"], cutoffs["medium"]))
    return d.withColumn("risk_band", band).withColumn("recommended_action", band_action(F.col("risk_band")))


def scored_sink(path: str) -> Callable[[DataFrame, int], None]:
    """ST1 sink for ``foreachBatch`` of a :func:`score_stream`: one write a batch, rows that broke a rule apart from the scored
    ones (``part=rejected`` / ``part=scored``) under the batch's number. A batch that runs again overwrites what it wrote."""
    import os

    def save(batch: DataFrame, number: int) -> None:
        part = F.when(F.size("violations") > 0, F.lit("rejected")).otherwise(F.lit("scored"))
        batch.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(os.path.join(path, f"batch={number}"))

    return save


def run_scoring(stream: DataFrame, path: str, sink: Callable[[DataFrame, int], None] | None = None) -> tuple[DataFrame, DataFrame]:
    """Drive a :func:`score_stream` over everything available into :func:`scored_sink` tables at ``path`` (its checkpoint beside
    them); returns the scored and the rejected rows, with their ``batch``."""
    import os

    from pyspark.sql import types as T
    q = (stream.writeStream.foreachBatch(sink or scored_sink(os.path.join(path, "rows")))
         .option("checkpointLocation", os.path.join(path, "checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType()), T.StructField("part", T.StringType())])
    rows = stream.sparkSession.read.schema(schema).parquet(os.path.join(path, "rows"))
    return tuple(rows.filter(F.col("part") == p).drop("part") for p in ("scored", "rejected"))


def dedup_stream(events: DataFrame, id_col: str, ts_col: str, delay: str = "1 hour") -> DataFrame:
    """ST3: drop repeated ids seen within the watermark delay."""
    return events.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([id_col])


def band_traffic(scored: DataFrame, ts_col: str, label_col: str | None = None, window: str = "1 hour",
                 slide: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """ST4: rows (and positives) per band in sliding event-time windows. In append mode a window comes out once,
    when the watermark has passed it; with :func:`run_to_latest` (update mode) the open ones are in the result, too."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if label_col:
        aggs.append(F.sum(F.col(label_col).cast("bigint")).alias("positives"))
    return (scored.withWatermark(ts_col, delay)
            .groupBy(F.window(ts_col, window, slide).alias("window"), "risk_band").agg(*aggs))


def run_to_table(stream: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Drive a streaming query over everything available (``availableNow``) into a
    Parquet table under the shared checkpoint folder, then read it back."""
    import os
    import uuid
    from tidewatch.session import checkpoint_dir
    base = os.path.join(checkpoint_dir(stream.sparkSession), "streams", f"{name}_{uuid.uuid4().hex[:10]}")
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("path", os.path.join(base, "out")).option("checkpointLocation", os.path.join(base, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(os.path.join(base, "out"))


def run_to_latest(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Drive a streaming aggregation in update mode over everything available: each batch's changed groups go to
    a partition of their own (a batch that is run again overwrites it), and the table read back holds the last
    state of every group, open ones included."""
    import os
    import uuid
    from tidewatch.session import checkpoint_dir
    spark = stream.sparkSession
    base = os.path.join(checkpoint_dir(spark), "streams", f"{name}_{uuid.uuid4().hex[:10]}")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(base, "out", f"_batch={number}".lstrip("_")))

    q = (stream.writeStream.outputMode("update").foreachBatch(save)
         .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    from pyspark.sql import types as T
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    got = spark.read.schema(schema).option("basePath", os.path.join(base, "out")).parquet(os.path.join(base, "out"))
    values = [c for c in stream.columns if c not in keys]
    last = got.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col("_last")[c].alias(c) for c in stream.columns])


def stream_table(spark, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A driver table read as a file stream (schema taken from the batch read)."""
    import os
    schema = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(sf_dir)
