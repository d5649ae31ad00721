"""Quality rules by distribution divergence, with DataFrame functions only.

A document's histogram of character classes and its histogram of common words are
compared with references of the languages by Jensen-Shannon distance (base 2, so 0 to 1).
The references are the pooled counts of all documents of a language that pass the base
rules. A document takes its nearest reference, so a wrong or missing language does no
harm. Histograms of few characters or words are too noisy to judge: below the minimum
lengths they aren't.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stage_table

# fixed values: the contract's word and symbol classes
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: what separates the words of the common-word histogram, after lower-casing
NO_LETTERS = r"[\x00-\x60\x7B-\x7F]+"
# fixed values: frequent function words of the languages; each is a bin of the histogram
COMMON_WORDS = {
    "en": "the of and to in is that for it with as on",
    "de": "der die und das den von zu mit ist nicht ein im",
    "fr": "le la les de et des en un une que qui pour",
    "es": "el la los de que y en del las por con una",
}
CHAR_BINS = ("lower", "upper", "digit", "space", "symbol", "beyond ascii", "other")


@dataclass(frozen=True)
class DivergenceRules:
    """Limits of the base rules and of the divergences."""

    min_words: int = 50
    max_repeat_pct: int = 50
    #: distances above these fail
    max_char_js: float = 0.30
    max_word_js: float = 0.30
    #: guards: shorter documents aren't compared
    min_chars: int = 200
    min_letter_words: int = 100


def bins() -> list[str]:
    return sorted({w for ws in COMMON_WORDS.values() for w in ws.split()})


def counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts and both histograms of every document, without a shuffle.

    Returns ``__id``, ``__lang``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``chars`` and ``commons`` (arrays of counts; the last
    bin of ``commons`` holds all other words).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = df.select(F.col(id_col).alias("__id"), F.col(lang_col).cast("string").alias("__lang"), text.alias("__t"))
    drop = lambda c, pattern: F.regexp_replace(c, pattern, "")
    df = df.select(
        "*",
        F.array_remove(F.split("__t", SPACES), "").alias("__words"),
        F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
        F.array_remove(F.split(F.lower("__t"), NO_LETTERS), "").alias("__plain"),
        drop(F.col("__t"), r"[a-z]+").alias("__c1"),
    )
    df = df.withColumn("__c2", drop(F.col("__c1"), r"[A-Z]+")).withColumn("__c3", drop(F.col("__c2"), r"[0-9]+"))
    df = df.withColumn("__c4", drop(F.col("__c3"), SPACES)).withColumn("__c5", drop(F.col("__c4"), SYMBOLS)).withColumn("__c6", drop(F.col("__c5"), r"[^\x00-\x7F]+"))
    words, common = F.col("__words"), bins()
    fewer = lambda a, b: F.length(a).cast("long") - F.length(b)
    df = df.select(
        "__id", "__lang", "__words",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        fewer("__c4", "__c5").alias("n_symbols"),
        F.array(fewer("__t", "__c1"), fewer("__c1", "__c2"), fewer("__c2", "__c3"), fewer("__c3", "__c4"), fewer("__c4", "__c5"), fewer("__c5", "__c6"), F.length("__c6").cast("long")).alias("chars"),
        F.size("__plain").alias("__n_plain"),
        F.filter("__plain", lambda w: w.isin(common)).alias("__commons"),
        F.transform(
            F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>")),
            lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]),
        ).alias("__w3"),
    )
    w3, c = F.col("__w3"), F.col("__commons")
    df = df.withColumn("__w3s", F.when(F.size(F.array_distinct(w3)) < F.size(w3), F.sort_array(F.transform(w3, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("__w3s")
    again = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    df = df.withColumn("__at", F.sort_array(F.array_distinct(F.flatten(F.filter(again, lambda x: x.isNotNull())))))
    at = F.col("__at")
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    covered = F.aggregate(at, zero, lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(acc["to"], p)).alias("n"), (p + 3).alias("to")))["n"]
    return df.select(
        "__id", "__lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(F.when(F.size(at) > 0, covered), F.lit(0).cast("long")).alias("n_repeat_words"),
        "chars",
        F.array(*((F.size(c) - F.size(F.array_remove(c, w))).cast("long") for w in common), (F.col("__n_plain") - F.size(c)).cast("long")).alias("commons"),
    )


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y.cast("double"))


def js_distance(counts: Column, total: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of counts (with their positive total) and an array of shares."""

    def term(n: Column, b: Column) -> Column:
        a = n / total
        own = F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
        return own + F.when(b > 0, b * F.log2(2 * b / (a + b))).otherwise(F.lit(0.0))

    return F.sqrt(F.greatest(F.lit(0.0), _total(F.zip_with(counts, q, term)) / 2))


def references(staged: DataFrame, rules: DivergenceRules) -> DataFrame:
    """One row: ``refs``, an array of (lang, chars, commons) with the shares of each language."""
    ok = staged.filter(F.col("__lang").isNotNull() & ~_base_failed(rules))
    sums = [F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(len(CHAR_BINS))]
    sums += [F.sum(F.col("commons")[i]).alias(f"w{i}") for i in range(len(bins()) + 1)]
    by = ok.groupBy("__lang").agg(*sums)
    share = lambda names: (lambda a: F.transform(a, lambda x: x / F.greatest(_total(a), F.lit(1.0))))(F.array(*names))
    ref = F.struct(
        F.col("__lang").alias("lang"),
        share([f"c{i}" for i in range(len(CHAR_BINS))]).alias("chars"),
        share([f"w{i}" for i in range(len(bins()) + 1)]).alias("commons"),
    )
    return by.agg(F.sort_array(F.collect_list(ref)).alias("refs"))


def _base_failed(rules: DivergenceRules) -> Column:
    return (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"))


def judge(df: DataFrame, rules: DivergenceRules = DivergenceRules(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, divergences and verdict of every document.

    Returns ``id_col``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``char_js`` and ``word_js`` (distance to the nearest reference; null
    where a guard holds or there is no reference), ``base_failed`` and ``kept``. Null texts
    have no words and fail; rows without a language aren't part of a reference; repeated rows
    each give a row; an empty table gives an empty result. The counts are written once (a
    row of numbers for each document); references are a row for each language.
    """
    staged = stage_table(counts(df, id_col, text_col, lang_col), "divergence-counts")
    refs = references(staged, rules)
    # the totals are columns of their own: inside the lambdas they would be summed again for every bin
    sums = staged.crossJoin(F.broadcast(refs)).select("*", _total(F.col("chars")).alias("__nc"), _total(F.col("commons")).alias("__nw"))
    near = lambda counts, n, name: F.array_min(F.transform("refs", lambda r: js_distance(F.col(counts), F.col(n), r[name])))
    out = sums.select(
        "*",
        F.when(F.col("__nc") >= rules.min_chars, near("chars", "__nc", "chars")).alias("char_js"),
        F.when(F.col("__nw") >= rules.min_letter_words, near("commons", "__nw", "commons")).alias("word_js"),
        _base_failed(rules).alias("base_failed"),
    )
    far = (F.coalesce("char_js", F.lit(0.0)) > rules.max_char_js) | (F.coalesce("word_js", F.lit(0.0)) > rules.max_word_js)
    return out.select(
        F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_js", "word_js", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"),
    )


def oracle_sql(rules: DivergenceRules = DivergenceRules()) -> str:
    """The same result in DuckDB's SQL, from the definitions, for the registered query."""
    words = ", ".join(f"'{w}'" for w in bins())
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, [x for x in string_split_regex(t, '[\x20\x09-\x0D]+') if x <> ''] AS w FROM d),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
lin AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (SELECT w.doc_id, lang, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lin.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN lin USING (doc_id)),
judged AS (SELECT *, (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_pct} * n_words) AS base_failed FROM base),
cnt AS (SELECT doc_id, unnest(['space', 'lower', 'upper', 'digit', 'symbol', 'beyond', 'other']) AS bin,
  unnest([length(t) - length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')), length(t) - length(regexp_replace(t, '[a-z]', '', 'g')), length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')), length(t) - length(regexp_replace(t, '[0-9]', '', 'g')), n_symbols,
  length(t) - length(regexp_replace(t, '[^\x00-\x7F]', '', 'g')), length(regexp_replace(t, '[\x20\x09-\x0D0-9#*$%&|<>a-zA-Z]|[^\x00-\x7F]', '', 'g'))]) AS n, 'c' AS kind FROM base),
plain AS (SELECT doc_id, x FROM (SELECT doc_id, unnest(string_split_regex(lower(t), '[\x00-\x60\x7B-\x7F]+')) AS x FROM d) WHERE x <> ''),
bin AS (SELECT unnest([{words}, '']) AS bin),
com AS (SELECT doc_id, CASE WHEN x IN ({words}) THEN x ELSE '' END AS bin, count(*) AS n FROM plain GROUP BY ALL),
hist AS (SELECT doc_id, kind, bin, n FROM cnt UNION ALL SELECT d.doc_id, 'w', bin.bin, coalesce(com.n, 0) FROM d CROSS JOIN bin LEFT JOIN com ON com.doc_id = d.doc_id AND com.bin = bin.bin),
share AS (SELECT doc_id, kind, bin, n / greatest(sum(n) OVER (PARTITION BY doc_id, kind), 1) AS p, sum(n) OVER (PARTITION BY doc_id, kind) AS total FROM hist),
refn AS (SELECT lang, kind, bin, sum(n) AS n FROM hist JOIN judged USING (doc_id) WHERE lang IS NOT NULL AND NOT base_failed GROUP BY ALL),
ref AS (SELECT lang, kind, bin, n / greatest(sum(n) OVER (PARTITION BY lang, kind), 1) AS q FROM refn),
js AS (SELECT doc_id, kind, lang, any_value(total) AS total, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS js
  FROM share JOIN ref USING (kind, bin) GROUP BY doc_id, kind, lang),
far AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, kind, any_value(total) AS total, min(js) AS js FROM js GROUP BY doc_id, kind)
  WHERE kind = 'c' AND total >= {rules.min_chars} AND js > {rules.max_char_js} OR kind = 'w' AND total >= {rules.min_letter_words} AND js > {rules.max_word_js})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND far.doc_id IS NULL AS kept
FROM judged LEFT JOIN far USING (doc_id)
"""
