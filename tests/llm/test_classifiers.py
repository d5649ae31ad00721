import math
import zlib

import numpy as np

from tidewatch.llm import language_id as L
from tidewatch.llm import queries as Q
from tidewatch.llm import toxicity as X

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = Q.op3_language_id(spark, SF).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    # calibrated: the mean score is near the accuracy
    assert abs(np.mean([r.score for r in held]) - np.mean([r.lang_pred == lang[r.doc_id] for r in held])) < 0.05


def test_language_awkward_rows(docs, clashing, empty, texts):
    model = L.fit(clashing)
    got = {(r.doc_id, r.lang_pred, r.score) for r in L.predict(clashing, model).collect()}
    assert {(-1, "und", 0.0), (-2, "und", 0.0), (-3, "und", 0.0), (-7, "und", 0.0)} <= got
    assert L.predict(empty, model).count() == 0
    none = L.fit(empty)
    assert none.languages == [] and none.predict("some text") == ("und", 0.0)
    kept = L.keep_identified(docs, model, 0.4)
    assert kept.columns == docs.columns and kept.filter("doc_id in (-1, -2, -3, -7)").count() == 0


def test_ngram_counts_of_parts_are_those_of_the_whole(monkeypatch):
    text = "Der schnelle, braune Fuchs -- springt über 12 Hunde! " * 30
    whole = L.ngram_counts(text)
    monkeypatch.setattr(L, "PART", 17)
    assert (L.ngram_counts(text) == whole).all()
    assert L.ngram_counts("123 !?") is None


def plain_bucket(gram):
    """Hash of a run of characters (a run of non-letters is one zero), on Python's integers."""
    mask = (1 << 64) - 1
    steps = (0, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
    h = [ord(c) * 0x9E3779B97F4A7C15 & mask if c else 0 for c in gram]
    g = h[-1]
    for j in range(1, len(h)):
        g = (g + h[-1 - j] * steps[j]) & mask
    return ((g ^ g >> 29) * 0xD6E8FEB86659FD93 & mask) >> 49


def test_ngram_counts_against_plain(texts):
    for text in [t for _, t in texts if t and len(t) < 3000][:60] + ["ÄÖ  ßx!", "a", " a", "a ", "ab", "日本 語!", "\U0001d4d0b", "x" * 7]:
        c = [""]
        for ch in text.lower():
            if ch.isalpha():
                c.append(ch)
            elif c[-1]:
                c.append("")
        want = np.zeros(L.BUCKETS, np.int64)
        # the space that opens the text is none of its own characters
        for n in (1, 2, 3):
            for at in range(n - 1, len(c)):
                if at > 0:
                    want[plain_bucket(c[at - n + 1:at + 1])] += 1
        got = L.ngram_counts(text)
        assert got is None and not any(ch.isalpha() for ch in text) or (got == want).all(), text[:40]


def test_ftrl_against_plain():
    """Every weight and step size by the published rule, one coordinate after the other."""
    alpha, beta, l1, l2, classes, epochs = 0.5, 1.0, 0.5, 0.3, 3, 2
    r = np.random.default_rng(1)
    rows = [(np.sort(r.choice(30, 6, replace=False)), r.integers(1, 5, 6), int(y)) for y in r.integers(0, classes, 25)]
    idf = r.uniform(0.5, 2.0, L.BUCKETS)
    got = L.fit_ftrl(rows, classes, idf, list("abc"), alpha, beta, l1, l2, epochs, seed=4)
    z, n = {}, {}

    def weight(key):
        zi, ni = z.get(key, 0.0), n.get(key, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(ni)) / alpha + l2)

    order = np.random.default_rng(4)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            index, count, y = rows[k]
            x = {int(i): (1 + math.log(c)) * idf[i] for i, c in zip(index, count, strict=True)}
            length = math.sqrt(sum(v * v for v in x.values()))
            x = {i: v / length for i, v in x.items()} | {"bias": 1.0}
            logit = [sum(v * weight((i, c)) for i, v in x.items()) for c in range(classes)]
            total = sum(math.exp(v) for v in logit)
            now = {(i, c): weight((i, c)) for i in x for c in range(classes)}
            for (i, c), w in now.items():
                g = x[i] * (math.exp(logit[c]) / total - (c == y))
                old = n.get((i, c), 0.0)
                z[i, c] = z.get((i, c), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w
                n[i, c] = old + g * g
    want = np.array([[weight((i, c)) for c in range(classes)] for i in range(30)])
    assert np.allclose(got.weights[:30], want, atol=1e-12) and np.allclose(got.bias, [weight(("bias", c)) for c in range(classes)], atol=1e-12)
    assert (want == 0).any() and (want != 0).any() and not got.weights[30:].any()


def test_temperature_is_the_least_loss():
    r = np.random.default_rng(2)
    rows = [(np.array([y]), np.array([1]), y if r.random() < 0.8 else 1 - y) for y in r.integers(0, 2, 200)]
    m = L.LanguageModel(["a", "b"], np.ones(L.BUCKETS), np.zeros((L.BUCKETS, 2)), np.zeros(2))
    m.weights[0, 0] = m.weights[1, 1] = 5.0
    found = L.fit_temperature(m, rows)

    def loss(t):
        return -np.mean([np.log(L.softmax(m.logits(i, c) / t)[y]) for i, c, y in rows])

    assert all(loss(found) <= loss(found * f) + 1e-12 for f in (0.5, 0.9, 0.99, 1.01, 1.1, 2.0)) and found > 1
    assert L.fit_temperature(m, []) == 1.0


def test_elastic_net_makes_zeros():
    r = np.random.default_rng(0)
    rows = [(np.sort(r.choice(200, 20, replace=False)) + 500 * y, np.ones(20), y) for y in r.integers(0, 2, 200)]
    idf = np.ones(L.BUCKETS)
    weak, strong = L.fit_ftrl(rows, 2, idf, ["a", "b"], l1=1e-6), L.fit_ftrl(rows, 2, idf, ["a", "b"], l1=2.0)
    assert (strong.weights != 0).sum() < (weak.weights != 0).sum()
    assert all(np.argmax(weak.logits(i, c)) == y for i, c, y in rows)


def test_toxicity_held_out(spark):
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = Q.op4_toxicity(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [(r.score, label[r.doc_id]) for r in got if r.held_out and r.doc_id in label]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.95


def test_toxicity_misspellings_share_vectors(spark):
    r = np.random.default_rng(3)
    word = lambda: "".join(r.choice(list("aeinorst"), r.integers(3, 8)))
    data = []
    for k in range(300):
        words = [word() for _ in range(60)]
        if k % 2:
            words[int(r.integers(60))] = "grumblefitz"
        data.append((*X.grouped(" ".join(words)), k % 2))
    m = X.fit_windows(data)
    clean = " ".join(word() for _ in range(60))
    assert m.score(clean) < 0.5 < m.score(clean + " grumblefitzz") and m.score(clean + " grumblefyz") > m.score(clean)


def test_toxicity_awkward_rows(spark, clashing, empty):
    labels = clashing.select("doc_id").filter("doc_id is not null").selectExpr("doc_id", "cast(doc_id % 2 = 0 as int) as toxic")
    model = X.fit(clashing, labels)
    got = {(r.doc_id, r.score, r.predicted) for r in X.score(clashing, model).collect()}
    assert {(-1, 0.0, 0), (-2, 0.0, 0), (-3, 0.0, 0)} <= got
    assert X.score(empty, model).count() == 0
    nothing = X.fit(empty, labels)
    assert nothing.score("any text at all") < 0.01


def _trained():
    r = np.random.default_rng(3)
    word = lambda: "".join(r.choice(list("aeinorst"), r.integers(3, 8)))
    data, texts = [], []
    for k in range(300):
        words = [word() for _ in range(40)]
        if k % 2:
            at = int(r.integers(38))
            words[at:at + 3] = ["oaken", "grumble", "tin"]          # harmless words that count together
        texts.append(" ".join(words))
        data.append((*X.grouped(texts[-1]), k % 2))
    return X.fit_windows(data), texts, word


def test_toxicity_depends_on_windows_not_on_places():
    m, texts, word = _trained()
    for t in texts[:80]:
        for prefix in ("one", "one two", word()):
            words = (prefix + " " + t).split()
            own = [m.score(" ".join(words[i:i + X.WINDOW_WORDS])) for i in range(len(prefix.split()))]
            assert abs(m.score(prefix + " " + t) - max(m.score(t), *own)) < 1e-9
    whole = texts[1] + " end"
    assert abs(m.score(whole) - max(m.score(" ".join(whole.split()[i:i + 3])) for i in range(len(whole.split()) - 2))) < 1e-9


def test_toxicity_windows_cross_the_parts_of_a_long_text(monkeypatch):
    m, texts, _ = _trained()
    text = " ".join(texts[:20])
    whole = m.logit(text)
    monkeypatch.setattr(X, "PART", 50)
    assert abs(m.logit(text) - whole) < 1e-9


def test_toxicity_gradient_equals_differences():
    r = np.random.default_rng(4)
    emb, soft, bias = r.normal(size=(12, 4)), r.normal(size=4), 0.3
    own, row, n = np.array([3, 5, 5, 9, 1, 3]), np.array([0, 0, 0, 1, 1, 2]), np.array([3, 2, 1])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([0.5, 2.0, 1.0])

    def loss(e, s, b):
        z = np.array([(e[own[row == k]] @ s).mean() + b for k in range(3)])
        return float((weight * (np.log1p(np.exp(z)) - y * z)).sum())

    touched, d_emb, d_soft, d_bias = X.gradient(emb, soft, bias, own, row, n, y, weight)
    assert touched.tolist() == [1, 3, 5, 9]
    for i, t in enumerate(touched):
        for c in range(4):
            e = emb.copy()
            e[t, c] += 1e-6
            assert abs((loss(e, soft, bias) - loss(emb, soft, bias)) / 1e-6 - d_emb[i, c]) < 1e-4
    for c in range(4):
        s = soft.copy()
        s[c] += 1e-6
        assert abs((loss(emb, s, bias) - loss(emb, soft, bias)) / 1e-6 - d_soft[c]) < 1e-4
    assert abs((loss(emb, soft, bias + 1e-6) - loss(emb, soft, bias)) / 1e-6 - d_bias) < 1e-4


def test_toxicity_repeated_rows(spark):
    m, texts, _ = _trained()
    df = spark.createDataFrame([(1, texts[1]), (1, texts[1]), (2, texts[0]), (1, texts[0])], "doc_id long, text string")
    got = sorted(map(tuple, X.score(df, m).collect()))
    assert len(got) == 4 and got == sorted((i, m.score(t), int(m.score(t) >= 0.5)) for i, t in [(1, texts[1]), (1, texts[1]), (2, texts[0]), (1, texts[0])])
