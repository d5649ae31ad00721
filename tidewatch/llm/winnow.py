"""Benchmark decontamination by winnowing, with DataFrame functions only.

Words are hashed, then every run of ``k`` words; of each ``span`` consecutive words the
smallest k-gram hash is kept as their fingerprint (neighbours mostly share it, so a
document keeps about one for every three words). Equal spans have equal fingerprints, so
joining the fingerprints of documents with those of the benchmark finds every span of
``span`` words that both have. Hits are then extended to all windows of the span length
that have this fingerprint, and these are joined with the benchmark's windows by the hash
of the whole window. Hashes have 64 bits, and a false hit would need two at once to agree.

The benchmark's tables are written once and broadcast if their counted rows stay under a
bound; otherwise both joins shuffle (hot fingerprints are split by adaptive skew joins).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text, stage_table

#: fixed by the contract: what separates words after A-Z are lower-cased
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPAN, K = 10, 5
#: rows of a benchmark table (16 bytes each, and the item ids) that may be broadcast
BROADCAST_ROWS = 2_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def _starts(n: Column, size: int) -> Column:
    """0 .. n - size, empty if n < size."""
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def _grams(hashes: str, n: str, size: int) -> Column:
    h = F.col(hashes)
    return F.transform(_starts(F.col(n), size), lambda i: F.xxhash64(*(h[i + j] for j in range(size))))


def fingerprints(df: DataFrame, span: int = SPAN, k: int = K, short: tuple[int, ...] = ()) -> DataFrame:
    """One column ``runs`` more for a frame with ``__words``: array of (``len``, ``j0``,
    ``fp``, ``whs``): windows of ``len`` words that start at ``j0`` and after, have the hashes
    ``whs`` and share the fingerprint ``fp``. Every window of ``span`` words is in one, and
    every window of each length in ``short`` (shorter items, fingerprint of the whole)."""
    g = span - k + 1
    df = df.withColumn("__h", F.transform("__words", lambda w: F.xxhash64(w))).withColumn("__n", F.size("__h"))
    df = df.withColumn("__g", _grams("__h", "__n", k))
    gram = F.col("__g")
    least = lambda i: reduce(lambda a, b: F.least(a, b), [gram[i + j] for j in range(1, g)], gram[i])
    # a window's hash is made of k-grams that cover it
    parts = [*range(0, span - k, k), span - k]
    df = df.select(
        "*",
        F.transform(_starts(F.col("__n"), span), least).alias("__m"),
        F.transform(_starts(F.col("__n"), span), lambda i: F.xxhash64(*(gram[i + j] for j in parts))).alias("__w"),
    )
    m, w = F.col("__m"), F.col("__w")
    df = df.withColumn("__s", F.filter(_starts(F.size(m), 1), lambda j: (j == 0) | (m[j] != m[F.greatest(j - 1, F.lit(0))])))
    s = F.col("__s")
    runs = F.zip_with(
        s, F.concat(F.slice(s, 2, F.greatest(F.size(s), F.lit(1))), F.array(F.size(m))),
        lambda a, b: F.struct(F.lit(span).alias("len"), a.alias("j0"), m[a].alias("fp"), F.slice(w, a + 1, F.least(b - a, F.size(w))).alias("whs")),
    )
    every = [F.when(F.size(m) > 0, runs).otherwise(F.array().cast(_RUNS))]
    every += [_short_runs(size) for size in short]
    return df.withColumn("runs", F.concat(*every)).drop("__h", "__g", "__m", "__w", "__s")


def _short_runs(size: int) -> Column:
    h = F.col("__h")

    def run(i: Column) -> Column:
        x = F.xxhash64(F.lit(size), *(h[i + j] for j in range(size)))
        return F.struct(F.lit(size).alias("len"), i.alias("j0"), x.alias("fp"), F.array(x).alias("whs"))

    return F.transform(_starts(F.col("__n"), size), run)


_RUNS = "array<struct<len:int,j0:int,fp:bigint,whs:array<bigint>>>"


def benchmark_tables(benchmark: DataFrame, span: int = SPAN, k: int = K, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, tuple[int, ...]]:
    """Written tables of the benchmark: distinct fingerprints (``len``, ``fp``), windows
    (``len``, ``wh``, ``items``), and the lengths of items shorter than a span."""
    src = id_and_text(benchmark, id_col, text_col).select("__id", words_of(F.col("__text")).alias("__words"))
    lengths = tuple(sorted(r[0] for r in src.select(F.size("__words").alias("n")).filter(F.col("n").between(1, span - 1)).distinct().collect()))
    # explode_outer: for explode, the optimizer would add a filter on the size of the runs and push it below the projections, which computes them anew for every element
    runs = fingerprints(src, span, k, lengths).select("__id", "__n", F.explode_outer("runs").alias("r")).filter((F.col("r.len") == span) | (F.col("r.len") == F.col("__n")))
    staged = stage_table(runs.select("__id", "r.len", "r.fp", F.explode("r.whs").alias("wh")).distinct(), "benchmark")
    fps = staged.select("len", "fp").distinct()
    windows = staged.groupBy("len", "wh").agg(F.collect_set("__id").alias("items"))
    return stage_table(fps, "benchmark-fps"), stage_table(windows, "benchmark-windows"), lengths


def _sized(df: DataFrame, entries: Column, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast if the rows' ``entries`` (numbers of values) add up to no more than the limit."""
    return F.broadcast(df) if (df.agg(F.sum(entries)).first()[0] or 0) <= limit else df


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Benchmark spans in documents.

    Returns for each row of ``docs``: ``id_col``, ``n_words``, ``spans`` (array of (``start``,
    ``len``): windows of words that a benchmark item has, too), ``items`` (array of the ids
    of these items, distinct) and ``n_hit`` (words inside any of the windows). An item with
    fewer words than a span, but not none, is one window. Null texts have no words; repeated
    rows each give a row; other columns are left out; an empty table on either side gives
    no hits.
    """
    fps, windows, short = benchmark_tables(benchmark, span, k, item_col, item_text_col)
    # a window that many items share has all their ids
    fps, windows = _sized(fps.withColumn("__found", F.lit(True)), F.lit(1)), _sized(windows, 1 + F.size("items"))
    src = id_and_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("__row"), "__id", words_of(F.col("__text")).alias("__words"))
    # each row also sends a run of its own that no fingerprint has, so that rows without hits stay
    own = F.array(F.struct(F.lit(0).alias("len"), F.lit(0).alias("j0"), F.xxhash64("__row").alias("fp"), F.array().cast("array<bigint>").alias("whs")))
    rows = fingerprints(src, span, k, short).select("__row", "__id", "__n", F.explode_outer(F.concat("runs", own)).alias("r")).select("__row", "__id", "__n", "r.*")
    near = rows.join(fps, ["len", "fp"], "left").filter((F.col("len") == 0) | F.col("__found"))
    near = near.select("__row", "__id", "__n", "len", "j0", F.posexplode_outer("whs").alias("at", "wh")).withColumn("wh", F.coalesce("wh", F.xxhash64("__row")))
    hits = near.join(windows, ["len", "wh"], "left").filter((F.col("len") == 0) | F.col("items").isNotNull())
    found = hits.groupBy("__row", "__id", "__n").agg(
        F.collect_set(F.when(F.col("len") > 0, F.struct((F.col("j0") + F.col("at")).alias("start"), F.col("len")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))

    def cover(acc: Column, s: Column) -> Column:
        end = s["start"] + s["len"]
        return F.struct((acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["to"], s["start"]))).alias("n"), F.greatest(acc["to"], end).alias("to"))

    return found.select(
        F.col("__id").alias(id_col), F.col("__n").cast("long").alias("n_words"), F.sort_array("spans").alias("spans"), "items",
        F.aggregate(F.sort_array("spans"), zero, cover)["n"].cast("long").alias("n_hit"),
    )


def oracle_sql(span: int = SPAN) -> str:
    """The registered query's result in DuckDB's SQL, by comparing all windows."""
    words = f"[x for x in string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> '']"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT item_id, {words} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), {span}) AS n, array_to_string(w[i:i + least(len(w), {span}) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {span} + 2, 2))) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN size WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, k)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(cov.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""
