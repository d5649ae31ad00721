"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_table

#: rows of one Arrow batch sent to Python; keeps a batch of long texts small
BATCH_ROWS = 256
#: characters of text worked on at once inside a Python task
SLICE_CHARS = 4_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator works on, under the names ``__id`` and
    ``__text``, so that other columns of the input can have any name."""
    return df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with bounded batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts lineage, and
    survives lost executors. :func:`tidewatch.session.drop_scratch` deletes these tables."""
    return scratch_table(df, f"llm-{name}")


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until none of the frames has a column of it."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name
