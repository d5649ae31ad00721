"""Registered queries of the training-data operators: one thin query for each operator,
with production parameters, over the whole of its table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import divergence, importance, language_id, licenses, multi_index, page_template, pii_crf, probminhash, toxicity, vector_codes, winnow
from tidewatch.llm.common import read_table
from tidewatch.llm.piece_codec import encode_decode
from tidewatch.llm.token_counts import count_tokens

PIECE_MODEL = "piece_bpe_32k.model"
COUNT_MODEL = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file, from the installed package that holds them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of the ids and of the decoded text."""
    out = encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        "n_corrected",
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return probminhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; one fold by the id is never learned from."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = language_id.remainder("doc_id", 3) == 1
    model = language_id.fit(docs.filter(~held_out))
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; one fold by the id is never learned from."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = language_id.remainder("doc_id", 5) == 0
    model = toxicity.fit(docs.select("doc_id", "text"), labels.filter(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


#: a path for a document, in the form that a crate of files has: folders by thousands and hundreds of its source, and
#: every hundredth file named as a licence file of its folder
PATH_SQL = (
    "concat(coalesce(source, 'unknown'), '/', doc_id // 1000, CASE WHEN doc_id % 1000 = 0 THEN '/LICENSE' "
    "WHEN doc_id % 100 = 0 THEN concat('/', doc_id // 100, '/LICENSE') ELSE concat('/', doc_id // 100, '/', doc_id, '.txt') END)"
)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or inherited on its path."""
    docs = read_table(spark, sf_dir, "documents")
    return licenses.license_scan(docs.select("doc_id", F.expr(PATH_SQL.replace("//", "div")).alias("path"), "text"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return page_template.main_texts(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they exceed a context of 512."""
    return count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path(COUNT_MODEL), limit=512)


def op8_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the divergences for every document."""
    return divergence.judge(read_table(spark, sf_dir, "documents")).drop("char_js", "word_js")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans, and all spans with those that the model adds."""
    docs = read_table(spark, sf_dir, "documents")
    found = pii_crf.spans(docs, pii_crf.fit(docs))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(number(k) for k in pii_crf.KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    out = winnow.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    ids = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return out.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    return multi_index.link_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and place in the draw of every document, with the benchmark as target."""
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every usable embedding, and a digest of the codebooks."""
    coded, books = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_sentencepiece_codec, op2_near_duplicates, op3_language_id, op4_toxicity, op5_license_scan, op6_main_text, op7_token_counts, op8_quality_divergence, op9_pii, op10_winnowing, op11_embedding_near_duplicates, op12_importance_resampling, op13_vector_codes)} | {"pipeline": corpus_pipeline.run}
ORACLES: dict[str, str] = {
    "op5_license_scan": licenses.oracle_sql(PATH_SQL),
    "op8_quality_divergence": divergence.oracle_sql(),
    "op10_winnowing": winnow.oracle_sql(),
    "op11_embedding_near_duplicates": multi_index.oracle_sql(),
    "op12_importance_resampling": importance.oracle_sql(),
    "op13_vector_codes": vector_codes.oracle_sql(),
}
