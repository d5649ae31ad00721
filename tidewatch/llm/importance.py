"""Importance resampling of documents towards a target distribution.

Texts are scanned as bytes: A-Z become lower case and every run of separators one space.
For each order k an overlapped regular-expression scan, with lookarounds that hold a match
to whole words, yields the spans of all runs of k words; the CRC-32 of a span's bytes gives
its bucket. Documents and target texts are counted by bucket, a bucket's gain is the log
ratio of its smoothed shares, and a document's weight the sum of the gains of its features.
Adding Gumbel noise from a hash of the id to the weights and keeping the highest sums
draws documents without replacement in proportion to the exponential of their weights.

Every text is scanned once: its distinct buckets and their counts are written. Bucket counts are
added up in the tasks, and only these (one row for each bucket, a number that is a
parameter) go to the driver. The draw ranks by a distributed prefix sum.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import id_and_text, map_arrow, stage_table
from tidewatch.operators.quantiles import prefix_sums

#: fixed by the contract: what separates words (the bytes of other characters are 0x80 or more)
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: fixed by the contract
BUCKETS, ORDER, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024


def collapsed(text: str) -> bytes:
    """The text's words in lower case (A-Z only), one space between them."""
    return SEPARATORS.sub(b" ", text.encode("utf-8", "surrogatepass").lower()).strip(b" ")


def span_patterns(order: int) -> list[regex.Pattern]:
    """One pattern for each run length up to ``order``; matches begin and end at word edges."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (k - 1)) for k in range(1, order + 1)]


def feature_buckets(text: str, patterns: list[regex.Pattern], buckets: int) -> tuple[list[int], int]:
    """Bucket of every feature of a text (repeats kept) and the number of its words."""
    line = collapsed(text)
    crc = zlib.crc32
    found = [[crc(m[0]) % buckets for m in p.finditer(line, overlapped=True)] for p in patterns]
    return [b for part in found for b in part], len(found[0])


def _scan(order: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = span_patterns(order)
        for b in batches:
            words, sizes, distinct, counts = [], [], [], []
            for text in b.column(1):
                found, n = feature_buckets(text.as_py() or "", patterns, buckets)
                u, c = np.unique(np.array(found, np.int32), return_counts=True)
                words.append(n)
                sizes.append(len(u))
                distinct.append(u)
                counts.append(c)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, x), *y]).astype(x))) for x, y in ((np.int32, distinct), (np.int64, counts))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), *lists], names=["id", "n_words", "buckets", "counts"])

    return run


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return col.flatten().to_numpy(zero_copy_only=False), np.diff(col.offsets.to_numpy())


def _totals(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            at, n = b.column("buckets").flatten().to_numpy(), b.column("counts").flatten().to_numpy()
            np.add.at(total, at, n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    return run


def scanned(df: DataFrame, id_col: str, text_col: str, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """Written table of ``id``, ``n_words``, and the distinct ``buckets`` of the row's features with their ``counts``."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    return stage_table(map_arrow(id_and_text(df, id_col, text_col), _scan(order, buckets), schema), "features")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, over all rows of a :func:`scanned` table."""
    total = np.zeros(buckets, np.int64)
    parts = features.select("buckets", "counts").mapInArrow(_totals(buckets), "bucket int, n long")
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():     # a row for each bucket
        total[r.bucket] = r.n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in the target to that in the source, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    k = float(len(source))
    return np.floor(1000.0 * np.log((t + 1.0) * (s.sum() + k) / ((s + 1.0) * (t.sum() + k)))).astype(np.int64)


def _weigh(gain: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, sizes = _lists(b.column("buckets"))
            n = b.column("counts").flatten().to_numpy()
            ends = np.cumsum(sizes)
            sums = lambda x: np.diff(np.r_[0, np.cumsum(x)][np.r_[0, ends]])
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_words"), pa.array(sums(n)), pa.array(sums(n * gain[at]))], names=["id", "n_words", "n_features", "weight"])

    return run


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id", target_text: str = "text",
             order: int = ORDER, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Weight, score and place in the draw of every row of ``docs``.

    Returns ``id_col``, ``n_features``, ``weight``, ``score`` and ``rank`` (1 for the highest score;
    null if not drawn). Of the documents with at least ``least_words`` words ``percent`` of a
    hundred are drawn, rounded down. A null or empty text has no features and weight 0; a
    null id is hashed as no characters and comes before others in a tie; repeated rows are
    documents of their own, equal ones in any order; other columns are left out; an empty
    table gives an empty result, and an empty target still ranks (its shares are equal).
    """
    features = scanned(docs, id_col, text_col, order, buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(scanned(target, target_id, target_text, order, buckets), buckets))
    schema = T.StructType([features.schema["id"], *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))])
    d = features.select("id", "n_words", "buckets", "counts").mapInArrow(_weigh(gain), schema)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    d = stage_table(d.withColumn("score", F.col("weight") + noise), "scores")
    able = prefix_sums(d.filter(F.col("n_words") >= least_words).withColumn("one", F.lit(1).cast("long")), ["score", "id"], ["one"], descending=True)
    drawn = F.floor(F.col("one_total") * percent / 100).cast("long")
    able = able.withColumn("rank", F.when(F.col("one_cum") <= drawn, F.col("one_cum")))
    other = d.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score", F.col("rank").cast("long").alias("rank")]
    return able.select(*columns).unionByName(other.select(*columns))


def oracle_sql(buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> str:
    """The registered query's result (runs of one word) in DuckDB's SQL; CRC-32 by its table, made from the polynomial."""
    words = "[w for w in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if w <> '']"
    steps = ["t0 AS (SELECT i, i AS c FROM range(256) r(i))"]
    steps += [f"t{k + 1} AS (SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END AS c FROM t{k})" for k in range(8)]
    return "WITH " + ", ".join(steps) + f""", crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM t8),
d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
b AS MATERIALIZED (SELECT item_id, {words} AS w FROM benchmark),
vocab AS (SELECT DISTINCT w FROM (SELECT unnest(w) AS w FROM d UNION ALL SELECT unnest(w) FROM b)),
hexed AS (SELECT w, hex(encode(w)) AS hx FROM vocab),
bytes AS (SELECT w, [CAST('0x' || hx[2 * i + 1:2 * i + 2] AS BIGINT) for i in range(length(hx) // 2)] AS bs FROM hexed),
bucket AS MATERIALIZED (SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bs), lambda acc, x: xor(acc >> 8, tab[CAST(xor(acc & 255, x) AS INTEGER) + 1])), 4294967295) % {buckets} AS k FROM bytes, crc),
df AS MATERIALIZED (SELECT doc_id, k FROM (SELECT doc_id, unnest(w) AS w FROM d) JOIN bucket USING (w)),
bf AS (SELECT k FROM (SELECT unnest(w) AS w FROM b) JOIN bucket USING (w)),
s AS (SELECT k, count(*) AS n FROM df GROUP BY k), t AS (SELECT k, count(*) AS n FROM bf GROUP BY k),
total AS (SELECT CAST((SELECT count(*) FROM df) AS DOUBLE) AS s, CAST((SELECT count(*) FROM bf) AS DOUBLE) AS t),
gain AS (SELECT k, floor(1000.0 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * (total.s + {buckets}) / ((s.n + 1.0::DOUBLE) * (total.t + {buckets})))) AS g FROM s LEFT JOIN t USING (k), total),
weight AS (SELECT doc_id, CAST(sum(g) AS BIGINT) AS weight FROM df JOIN gain USING (k) GROUP BY doc_id),
scored AS (SELECT doc_id, len(w) AS n, coalesce(weight, 0) AS weight, CAST('0x' || substr(sha256(concat('{seed}:', doc_id)), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN weight USING (doc_id)),
noisy AS (SELECT doc_id, n, weight, weight + CAST(floor(-1000.0 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0))) AS BIGINT) AS score FROM scored),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS every FROM noisy WHERE n >= {least_words})
SELECT doc_id, CAST(n AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score, CASE WHEN r <= {percent} * every // 100 THEN CAST(r AS BIGINT) END AS rank
FROM noisy LEFT JOIN ranked USING (doc_id)
"""
