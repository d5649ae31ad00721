"""From raw documents to token ids, in stages; each stage is written as Parquet and read again.

1. language: texts whose language isn't identified go;
2. near_duplicates: one document of each near-duplicate class stays;
3. decontamination: documents with a span of the benchmark go;
4. pii: personal data is replaced by the name of its kind;
5. tokens: the texts are encoded.

All but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import language_id, pii_crf, probminhash, winnow
from tidewatch.llm.common import fresh, read_table, stage_table
from tidewatch.llm.piece_codec import encode_decode

#: a text with a lower score has no clear language
MIN_LANGUAGE_SCORE = 0.4
PIECE_MODEL = "piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language. The classifier is fitted on the bounded sample of labelled rows."""
    return language_id.keep_identified(docs, language_id.fit(docs), MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the least id."""
    return probminhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any span of a benchmark item."""
    found = winnow.contamination(docs, read_table(spark, sf_dir, "benchmark")).filter("n_hit > 0")
    name = fresh("__hit", docs)
    hit = probminhash.stage_sized(found.select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.join(hit, docs["doc_id"].eqNullSafe(F.col(name)), "left_anti")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced, and ``n_chars`` to match."""
    clean = pii_crf.redact(docs, pii_crf.fit(docs))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``text`` (decoded from the ids), ``ids`` and ``n_tokens``."""
    import public_tokenizers

    out = encode_decode(docs, public_tokenizers.path(PIECE_MODEL))
    return out.select("doc_id", F.col("decoded").alias("text"), "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("tokens", tokens),
]

#: the classifiers and the codec can't be said in SQL; the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
