import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.config import FeatureConfig
from tidewatch.operators import features as feat
from tidewatch.operators import models as mdl
from tidewatch.streaming import online as st


def _write(spark, tmp_path, rows, schema, name="ev"):
    d = str(tmp_path / name)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(d)
    return d


SCHEMA = "event_id long, ts timestamp, user_id long, value double"


def _rows():
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rng = np.random.default_rng(3)
    out = []
    for i in range(300):
        t = base + dt.timedelta(seconds=int(rng.integers(0, 10 * 86400)))
        out.append((i, t, int(rng.integers(0, 5)), float(rng.choice([None, 1.0, 2.5, 2.5, 40.0]) or 0.0)))
    return out


def test_velocity_stream_equals_batch(spark, tmp_path):
    rows = _rows()
    d = _write(spark, tmp_path, rows, SCHEMA)
    stream = spark.readStream.schema(SCHEMA).parquet(d)
    out = st.run_to_latest(st.velocity_stream(stream, "user_id", "ts", "event_id", "value"), "t_st2", ["key", "id"])
    got = {r.id: r for r in out.collect()}
    batch = spark.createDataFrame(rows, SCHEMA).select(
        F.col("event_id").alias("TransactionID"), F.unix_seconds("ts").alias("TransactionDT"),
        F.col("value").alias("TransactionAmt"), F.col("user_id").alias("card1"))
    ref = {r.TransactionID: r for r in feat.add_entity_time_features(feat.add_keys(batch), FeatureConfig()).collect()}
    assert len(got) == len(ref) == 300
    for i, r in ref.items():
        g = got[i]
        assert (g.cnt_1h, g.cnt_24h) == (r.cnt_1h, r.cnt_24h)
        assert g.sum_amt_1h == pytest.approx(r.sum_amt_1h) and g.std_amt_7d_hist == pytest.approx(r.std_amt_7d_hist, abs=1e-9)
        assert (g.z_amt_vs_7d is None) == (r.z_amt_vs_7d is None)


def test_velocity_stream_late_rows_flagged(spark, tmp_path):
    import datetime as dt
    import os
    import shutil
    import time
    base = dt.datetime(2024, 1, 10)
    first = _write(spark, tmp_path, [(1, base, 1, 5.0)], SCHEMA, "a")
    # second micro-batch: one row 5 days behind the watermark (delay 1 day), one on time
    second = _write(spark, tmp_path, [(2, base - dt.timedelta(days=5), 1, 7.0), (3, base + dt.timedelta(hours=1), 1, 9.0)],
                    SCHEMA, "c")
    inp = tmp_path / "in"
    os.makedirs(inp)
    for tag, src in (("a", first), ("c", second)):
        for f in sorted(os.listdir(src)):
            if f.endswith(".parquet"):
                shutil.copy(os.path.join(src, f), inp / f"{tag}_{f}")
                time.sleep(1.1)          # distinct modification times -> one file per trigger, in order
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(inp))
    out = st.run_to_latest(st.velocity_stream(stream, "user_id", "ts", "event_id", "value", delay="1 day"), "t_late", ["key", "id"])
    res = {r.id: r for r in out.collect()}
    assert res[1].late is False and res[3].late is False
    assert res[3].cnt_1h == 1 and res[3].mean_amt_7d_hist == 5.0     # state carried across batches
    assert res[2].late is True and res[2].cnt_1h is None


def test_score_and_dedup_streams(spark, tmp_path):
    rows = _rows() + [(0, _rows()[0][1], 0, 1.0)]          # id 0 repeated
    d = _write(spark, tmp_path, rows, SCHEMA)
    ev = spark.readStream.schema(SCHEMA).parquet(d)
    scored = st.score_stream(ev, lambda x: x.withColumn("score", F.lit(0.96)))
    out = st.run_to_table(scored.select("event_id", "risk_band", "recommended_action"), "t_st1").collect()
    assert {r.risk_band for r in out} == {"critical"} and len(out) == 301
    dd = st.run_to_table(st.dedup_stream(spark.readStream.schema(SCHEMA).parquet(d), "event_id", "ts", "1 day")
                         .select("event_id"), "t_st3")
    assert dd.count() == 300


def test_embedding_lookup_and_mlp(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, "b", None), (3, "zz", 1.0)], "id long, k string, x double")
    from tidewatch.functions.keys import stable_hash_bucket
    b = {r.k: r.b for r in df.select("k", stable_hash_bucket("k", 8).alias("b")).collect()}
    emb = spark.createDataFrame([(b["a"], [1.0, 2.0]), (b["b"], [3.0, 4.0])], "bucket int, vec array<float>")
    if b["zz"] in (b["a"], b["b"]):
        pytest.skip("bucket collision in fixture")
    j = mdl.embedding_lookup(df, "k", emb, 8, "emb")
    W1, b1 = np.array([[1.0, -1.0], [0.5, 0.0], [0.0, 1.0]]), np.array([0.1, 0.2])
    W2, b2 = np.array([[1.0], [2.0]]), np.array([-0.5])
    out = {r.id: r.logit for r in mdl.mlp_logits(j, ["x", "emb"], [(W1, b1), (W2, b2)], {"emb": 2}).collect()}

    def ref(x, e):
        v = np.array([x] + e, dtype=np.float32)
        h = np.maximum(v @ W1.astype(np.float32) + b1.astype(np.float32), 0)
        return float((h @ W2.astype(np.float32) + b2.astype(np.float32))[0])
    assert out[1] == pytest.approx(ref(0.5, [1.0, 2.0]), rel=1e-6)
    assert out[2] == pytest.approx(ref(0.0, [3.0, 4.0]), rel=1e-6)
    assert out[3] == pytest.approx(ref(1.0, [0.0, 0.0]), rel=1e-6)


def test_baseline_logistic_learns(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(2000):
        x = float(rng.normal())
        y = int(rng.random() < 1 / (1 + np.exp(-3 * x)))
        rows.append((i, x, None if i % 50 == 0 else x * 2, ["W", "H"][i % 2], f"k{i % 30}", y))
    df = spark.createDataFrame(rows, "id long, a double, b double, ProductCD string, entity_key string, y int")
    m = mdl.fit_baseline(df, "y", ["a", "b"], ["ProductCD"], ["entity_key"])
    sc = m.transform(df)
    from tidewatch.operators.metrics import binary_metrics
    assert binary_metrics(sc, "y", "score").first().auc_roc > 0.8
    assert set(m.coefficients()) == {"a", "b"}


def test_velocity_stream_state_across_batches_equals_batch(spark, tmp_path):
    import os
    import shutil
    import time
    rows = sorted(_rows(), key=lambda r: r[1])
    inp = tmp_path / "multi"
    os.makedirs(inp)
    for part, chunk in enumerate((rows[:100], rows[100:180], rows[180:])):      # time-ordered micro-batches
        d = _write(spark, tmp_path, chunk, SCHEMA, f"part{part}")
        for f in sorted(os.listdir(d)):
            if f.endswith(".parquet"):
                shutil.copy(os.path.join(d, f), inp / f"{part}_{f}")
        time.sleep(1.1)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(inp))
    out = st.run_to_latest(st.velocity_stream(stream, "user_id", "ts", "event_id", "value", delay="30 days"), "t_multi", ["key", "id"])
    got = {r.id: r for r in out.collect()}
    batch = spark.createDataFrame(rows, SCHEMA).select(
        F.col("event_id").alias("TransactionID"), F.unix_seconds("ts").alias("TransactionDT"),
        F.col("value").alias("TransactionAmt"), F.col("user_id").alias("card1"))
    ref = {r.TransactionID: r for r in feat.add_entity_time_features(feat.add_keys(batch), FeatureConfig()).collect()}
    assert len(got) == 300 and not any(r.late for r in got.values())
    for i, r in ref.items():
        g = got[i]
        assert (g.cnt_1h, g.cnt_24h) == (r.cnt_1h, r.cnt_24h), i
        assert g.mean_amt_7d_hist == pytest.approx(r.mean_amt_7d_hist) and \
            g.std_amt_7d_hist == pytest.approx(r.std_amt_7d_hist, abs=1e-9), i
        assert (g.z_amt_vs_7d is None) == (r.z_amt_vs_7d is None), i


def _batches(spark, tmp_path, batches, name):
    """A stream whose micro-batches are the given lists of rows, in this order."""
    import os
    import shutil
    import time
    inp = tmp_path / name
    os.makedirs(inp)
    for k, rows in enumerate(batches):
        d = _write(spark, tmp_path, rows, SCHEMA, f"{name}{k}")
        for f in sorted(os.listdir(d)):
            if f.endswith(".parquet"):
                shutil.copy(os.path.join(d, f), inp / f"{k}_{f}")
        time.sleep(1.1)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(inp))


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_velocity_stream_disorder_and_gap(spark, tmp_path, zone):
    """A row that comes after a later one gets the features of its place and corrects the later one; a key that was
    quiet for a month still has its previous amount."""
    import datetime as dt
    names = [f.strip().split(" ")[0] for f in SCHEMA.split(",")] if isinstance(SCHEMA, str) else SCHEMA.names

    def row(i, text, amount):
        return tuple({"event_id": i, "ts": dt.datetime.fromisoformat(text), "user_id": 1, "value": amount}.get(n) for n in names)

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stream = _batches(spark, tmp_path, [[row(1, "2024-01-01 08:00:00", 5.0), row(2, "2024-01-01 10:00:00", 10.0)], [row(3, "2024-01-01 09:30:00", 7.0)], [row(4, "2024-02-10 00:00:00", 3.0)]], "gap")
        out = st.run_to_latest(st.velocity_stream(stream, "user_id", "ts", "event_id", "value", delay="1 day"), "t_gap", ["key", "id"])
        got = {r.id: (r.cnt_1h, r.mean_amt_7d_hist, r.late) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {1: (1, 0.0, False), 3: (1, 5.0, False), 2: (2, 6.0, False), 4: (1, 10.0, False)}


def _files(spark, tmp_path, batches, schema):
    """One file for each micro-batch, in order."""
    import time
    d = str(tmp_path / "files")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(d)
        time.sleep(0.05)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)


def test_velocity_state_is_evicted_and_last_amount_kept(spark, tmp_path):
    import datetime as dt
    base, day = dt.datetime(2024, 3, 1), dt.timedelta(days=1)
    ties = [(2, base, 1, 3.0), (1, base, 1, 5.0), (9, None, 1, 4.0), (10, base, 1, None)]
    batches = [ties, [(3, base + 20 * day, 2, 1.0)], [(4, base + 21 * day, 2, 1.0)], [(5, base + 30 * day, 1, 8.0)], [(6, base + 30 * day, 1, 2.0)]]
    out = st.run_to_latest(st.velocity_stream(_files(spark, tmp_path, batches, SCHEMA), "user_id", "ts", "event_id", "value", delay="1 hour"), "t_evict", ["key", "id"])
    got = {r.id: r for r in out.collect()}
    assert (got[1].cnt_1h, got[2].cnt_1h, got[10].cnt_1h) == (1, 2, 2) and got[2].sum_amt_1h == 8.0     # ties in the order of ids
    assert got[9].late and got[9].t is None and got[9].cnt_1h is None
    # the first key's rows are gone from the state, but for the amount before the new one (none: the last row had no amount)
    assert (got[5].cnt_24h, got[5].mean_amt_7d_hist) == (1, 0.0)
    assert (got[6].cnt_24h, got[6].mean_amt_7d_hist) == (2, 8.0)


def test_campaign_stream_counts_ties_in_order(spark, tmp_path):
    import datetime as dt
    base = dt.datetime(2024, 3, 1)
    schema = "event_id long, ts timestamp, fp string, entity string"
    batches = [[(1, base, "f", "b"), (None, base, "f", "c"), (2, base, "f", "a")], [(3, base - dt.timedelta(hours=30), "f", "z"), (4, base, None, "a")]]
    out = st.run_to_latest(st.campaign_stream(_files(spark, tmp_path, batches, schema), "fp", "ts", "event_id", "entity", delay="2 days"), "t_camp", ["key", "id"])
    got = {(r.key, r.id): (r.fp_cnt_24h, r.fp_cnt_72h, r.late) for r in out.collect()}
    assert got == {("f", 2): (1, 2, False), ("f", 1): (2, 3, False), ("f", None): (2, 3, False), ("f", 3): (1, 1, False), (None, 4): (1, 1, False)}


class _State:
    """A processor's state and timers in memory, which counts the calls that change them."""

    def __init__(self):
        self.map, self.value, self.calls = {}, None, 0

    getMapState = getValueState = lambda self, *a: _State()

    def registerTimer(self, at):
        self.calls += 1

    def iterator(self):
        return iter(list(self.map.items()))

    def updateValue(self, key, value):
        self.calls += 1
        self.map[key] = value

    def exists(self):
        return self.value is not None


def test_a_group_of_keys_is_placed_in_a_few_calls():
    """Series of many keys at once: the features of each key alone, and state calls that don't grow with keys or rows."""
    import types

    import pandas as pd

    from tidewatch.streaming.velocity import SeriesProcessor, velocity_features
    rng = np.random.default_rng(1)
    rows = pd.DataFrame({"key": [f"k{i}" for i in rng.integers(0, 40, 2000)], "id": np.arange(2000), "t": 1_700_000_000 + rng.integers(0, 20 * 86400, 2000),
                         "amount": np.where(rng.random(2000) < 0.1, np.nan, rng.random(2000) * 100), "tie": ""})
    p = SeriesProcessor(False, FeatureConfig())
    handle = _State()
    p.init(handle)
    now = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    latest = {}
    for part in (rows[:1200], rows[1200:]):
        for out in p.handleInputRows((7,), iter([part]), now):
            latest |= {r.id: r for r in out.itertuples(index=False)}
    assert len(latest) == 2000 and p.blocks.calls + handle.calls <= 20
    for _, s in rows.groupby("key"):
        s = s.sort_values(["t", "id"])
        plain = velocity_features(s["t"].to_numpy(), s["amount"].to_numpy())
        for n, i in enumerate(s["id"]):
            for c, x in plain.items():
                assert getattr(latest[i], c) == pytest.approx(x[n], abs=1e-9, nan_ok=True), (i, c)
