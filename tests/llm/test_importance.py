"""Importance resampling against a plain version, and awkward tables."""

import hashlib
import math
import re
import zlib

from pyspark.sql import functions as F

from tidewatch.llm import importance


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, bench, order, percent=10):
    """(id, number of features, weight, score, rank) of every document, by dictionaries."""
    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in range(1, order + 1) for i in range(len(w) - k + 1)]

    s, t = {}, {}
    of = [(i, features(x), len(words(x))) for i, x in docs]
    for _, fs, _ in of:
        for f in fs:
            s[f] = s.get(f, 0) + 1
    for _, x in bench:
        for f in features(x):
            t[f] = t.get(f, 0) + 1
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda f: math.floor(1000 * math.log((t.get(f, 0) + 1) * (total_s + 10000) / ((s.get(f, 0) + 1) * (total_t + 10000))))
    out = []
    for i, fs, n in of:
        w = sum(gain(f) for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((o for o in out if o[4] >= 20), key=lambda o: (-o[3], o[0] is not None, o[0] or 0))
    rank = {id(o): k + 1 for k, o in enumerate(able[:percent * len(able) // 100])}
    return sorted([(*o[:4], rank.get(id(o))) for o in out], key=str)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def bench(spark):
    from tests.llm.conftest import SF

    b = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    return b.union(spark.createDataFrame([(None, None), (None, "A b C")], b.schema))


def test_equals_the_plain_version(spark, docs, texts):
    b = bench(spark)
    target = [tuple(r) for r in b.select("item_id", "text").collect()]
    for order in (1, 3):
        assert rows(importance.resample(docs, b, order=order)) == plain(texts, target, order)


def test_clashing_columns_and_empty_tables(spark, docs, clashing, empty, texts):
    b = bench(spark)
    more = clashing.select("*", *(F.lit("x").alias(c) for c in ("id", "n_features", "weight", "rank", "buckets", "counts", "one", "one_cum", "_bucket")))
    assert rows(importance.resample(more, b)) == rows(importance.resample(docs, b))
    none = importance.resample(empty, b)
    assert none.columns == ["doc_id", "n_features", "weight", "score", "rank"] and none.count() == 0
    assert rows(importance.resample(docs, b.limit(0))) == plain(texts, [], 1)


def test_spans_are_runs_of_words():
    one, two, three = importance.span_patterns(3)
    line = importance.collapsed("  The cat,THE  hat\nÉté 9x!")
    assert line == "the cat the hat Été 9x".encode()
    assert [m[0] for m in two.finditer(line, overlapped=True)] == [b" ".join(p) for p in zip(line.split(), line.split()[1:], strict=False)]
    assert len(list(three.finditer(line, overlapped=True))) == 4 and len(list(one.finditer(line, overlapped=True))) == 6
    assert importance.feature_buckets("", [one], 10) == ([], 0) and importance.feature_buckets(" ,;- ", [one, two], 10) == ([], 0)


def test_repeated_rows_are_drawn_apart(spark):
    text = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(7, text)] * 40 + [(8, text)] * 10, "doc_id long, text string")
    got = importance.resample(df, df.limit(1), target_id="doc_id").collect()
    assert sorted(r.rank for r in got if r.rank) == [1, 2, 3, 4, 5] and len(got) == 50
    assert len({r.score for r in got}) == 2
