import importlib
import sys

import public_tokenizers
import sentencepiece

import corpus_pipeline as C
from tidewatch.llm import pii_crf, probminhash, winnow

SF = "/root/testdata/sf0.001"


def test_stages_and_result(spark, docs, tmp_path):
    assert [n for n, _ in C.STAGES] == ["language", "near_duplicates", "decontamination", "pii", "tokens"]
    at = docs
    for k, (name, stage) in enumerate(C.STAGES):
        before = at
        at = stage(spark, before, SF)
        at.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert at.columns == docs.columns and dict(at.dtypes) == dict(docs.dtypes)
        if name == "language":
            assert at.filter("doc_id in (-1, -2, -3, -7)").count() == 0 and at.filter("doc_id >= 0").count() == before.filter("doc_id >= 0").count()
        if name == "near_duplicates":
            assert probminhash.near_duplicates(at).filter("copies > 1").count() == 0
        if name == "decontamination":
            hit = winnow.contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert at.count() == hit.filter("n_hit = 0").count() < before.count()
        if name == "pii":
            assert at.count() == before.count()
            assert not any(pii_crf.base_spans(r.text) for r in at.collect())
            assert all(r.n_chars == len(r.text) for r in at.collect())
            texts = {r.doc_id: r.text for r in at.collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(C.PIECE_MODEL))
    rows = at.collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert all(r.ids == sp.encode(texts[r.doc_id]) and r.text == texts[r.doc_id] and r.n_tokens == len(r.ids) for r in rows)


def test_stages_take_clashing_columns(spark, docs):
    from pyspark.sql import functions as F

    names = ["__gone", "__hit", "__id", "__k1", "__k2", "__text", "__lang", "__row", "id", "k1", "k2", "stays", "n", "c", "r", "h", "part", "ids", "decoded", "score", "is_first", "copies", "class_id", "n_hit", "items"]
    at, plain = docs.select("*", *(F.lit("clash").alias(n) for n in names)), docs
    for k, (_, stage) in enumerate(C.STAGES):
        at, plain = C.stage_table(stage(spark, at, SF), "clash"), C.stage_table(stage(spark, plain, SF), "plain")
        if k < 4:
            assert at.columns == [*docs.columns, *names]
        keep = plain.columns
        assert sorted(map(str, at.select(*keep).collect())) == sorted(map(str, plain.collect()))


def test_repeated_ids_lose_no_removal(spark):
    text = " ".join(f"word{k}" for k in range(60))
    other = " ".join(f"else{k}" for k in range(60))
    df = spark.createDataFrame([(1, text, "a"), (2, text, "b"), (2, other, "c"), (2, other, "d"), (None, text, "e"), (3, None, "f"), (3, None, "g"), (4, "", "h")], "doc_id long, text string, source string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in probminhash.keep_first(df).select("doc_id", "text").collect() if r.text)
    assert len(got) == 2 and {t for *_, t in got} == {text, other}        # one copy of each text
    assert probminhash.keep_first(df).filter("text IS NULL OR text = ''").count() == 2


def test_empty_input(spark, docs):
    at = docs.limit(0)
    for _, stage in C.STAGES:
        at = stage(spark, at, SF)
        assert at.count() == 0


def test_entry_works_without_the_subpackage(monkeypatch):
    import __spark_entry__ as E

    assert "pipeline" in E.queries() and "op10_winnowing" in E.oracle_sql()
    for name in [m for m in sys.modules if m.startswith("tidewatch.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name.startswith(("tidewatch.llm", "corpus_pipeline")):
                raise ModuleNotFoundError(name, name=name)

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    import tidewatch

    monkeypatch.delattr(tidewatch, "llm", raising=False)
    E = importlib.reload(E)
    assert "pipeline" not in E.queries() and len(E.queries()) > 60
