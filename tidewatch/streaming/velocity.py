"""ST2: online velocity (W1-W8) and campaign (W9-W10) features per key, on ``transformWithState``.

Keys are dealt by their hash to a fixed number of groups (``GROUPS``), so that a call of
the processor, its state and its output serve many keys at once: with a group for each
key the calls between the engines, not the rows, would set the time. State of a group,
in RocksDB:

* ``blocks``: a map from a block of time (half of the longest window) to the rows of
  that time; only blocks that get new rows are written again;
* ``before``: for each key the amount of the last row that was evicted (the lagged
  amount of the first row that is left).

An event-time timer at the end of the oldest block's windows evicts what no row
inside the watermark can see any more. A row out of order (but inside the
watermark's delay) gets the features of its place, and the rows after it whose
windows it changed come out again; in update mode the last version of every row
equals the batch operator over the rows that weren't late. Rows older than the
watermark, or without a time, come out with ``late = true`` and no features, so
they can be counted.

A group's rows of one micro-batch are handled by one task (its state is in one
place); the batch operators split a hot key by time.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.config import FeatureConfig

_ROW = "key string, id long, t long, late boolean"
VELOCITY_SCHEMA = _ROW + (", amount double, cnt_1h int, sum_amt_1h double, cnt_24h int, avg_amt_24h double, mean_amt_7d_hist double, "
                          "std_amt_7d_hist double, z_amt_vs_7d double")
CAMPAIGN_SCHEMA = _ROW + ", fp_cnt_24h int, fp_cnt_72h int, fp_growth_ratio_24h_over_72h float"

SCALE = 10 ** 6        # amounts as integer micro-units: window sums are exact
MISSING = -(1 << 62)   # stands for a null time or id between the engines
GROUPS = 2048          # groups of keys; a stream keeps the number that its checkpoint began with

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB and write changes only (``transformWithState`` needs it)."""
    spark.conf.set(_PROVIDER, _ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _cum(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(x)])


def velocity_features(t: np.ndarray, a: np.ndarray, cfg: FeatureConfig = FeatureConfig(), prev: np.ndarray | None = None,
                      key: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """W1-W8 of every row of one key's series, sorted by (time, id): running sums and their differences. The series of several
    keys (``key``: ascending numbers from 0) may follow each other, times more than the longest window apart. ``prev``: the
    amounts before the rows in their series."""
    at = np.arange(len(t))
    prev = np.concatenate([[np.nan], a[:-1]]) if prev is None else prev
    key = np.zeros(len(t), np.int64) if key is None else key
    has, had = ~np.isnan(a), ~np.isnan(prev)
    units = lambda x: np.round(np.nan_to_num(x) * SCALE).astype(np.int64)
    first = {w: np.searchsorted(t, t - w, side="right") for w in (cfg.win_1h, cfg.win_24h, cfg.win_7d)}

    def total(x: np.ndarray, w: int) -> np.ndarray:
        c = _cum(x)
        return c[at + 1] - c[first[w]]

    c1, s1 = total(has.astype(np.int64), cfg.win_1h), total(units(a), cfg.win_1h)
    c24, s24 = total(has.astype(np.int64), cfg.win_24h), total(units(a), cfg.win_24h)
    ch, sh = total(had.astype(np.int64), cfg.win_7d), total(units(prev), cfg.win_7d)
    middle = np.bincount(key[had], prev[had], key[-1] + 1) / np.maximum(np.bincount(key[had], minlength=key[-1] + 1), 1)     # squares around it lose fewer digits
    off = np.where(had, prev - middle[key], 0.0).astype(np.longdouble)
    so, qo = total(off, cfg.win_7d), total(off * off, cfg.win_7d)
    # a window of equal values has a deviation of exactly zero: no change between its present values
    seen = prev[had]
    change = _cum(np.concatenate([[0], (seen[1:] != seen[:-1]).astype(np.int64)])) if len(seen) else np.zeros(1, np.int64)
    number = _cum(had.astype(np.int64))
    lo, hi = number[first[cfg.win_7d]], number[at + 1]
    changes = np.where(hi > lo, change[hi] - change[np.minimum(lo + 1, len(change) - 1)], 0)
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(ch > 0, sh / SCALE / np.maximum(ch, 1), 0.0)
        var = np.where((ch > 0) & (changes > 0), np.maximum(qo / np.maximum(ch, 1) - (so / np.maximum(ch, 1)) ** 2, 0.0), 0.0).astype(np.float64)
        std = np.sqrt(var)
        z = np.where(std > 0, (a - mean) / np.where(std > 0, std, 1.0), np.nan)
        avg = np.where(c24 > 0, s24 / SCALE / np.maximum(c24, 1), 0.0)
    return {"cnt_1h": c1, "sum_amt_1h": s1 / SCALE, "cnt_24h": c24, "avg_amt_24h": avg, "mean_amt_7d_hist": mean,
            "std_amt_7d_hist": std, "z_amt_vs_7d": z}


def campaign_features(t: np.ndarray, present: np.ndarray, cfg: FeatureConfig = FeatureConfig()) -> dict[str, np.ndarray]:
    """W9-W10 of every row of one fingerprint's series, sorted by (time, tie, id), or of several (see :func:`velocity_features`)."""
    at, c = np.arange(len(t)), _cum(present.astype(np.int64))
    n24, n72 = (c[at + 1] - c[np.searchsorted(t, t - w, side="right")] for w in (cfg.win_24h, cfg.win_72h))
    with np.errstate(invalid="ignore", divide="ignore"):
        growth = np.where(n72 > 0, n24 / np.where(n72 > 0, n72, 1), np.nan).astype(np.float32)
    return {"fp_cnt_24h": n24, "fp_cnt_72h": n72, "fp_growth_ratio_24h_over_72h": growth}


def _packed(rows: pd.DataFrame) -> tuple:
    """Rows of a block as one state value: numbers in bytes, texts once each."""
    out: list = [rows[c].to_numpy(kind).tobytes() for c, kind in _NUMBERS]
    for c in ("key", "tie"):
        code, texts = pd.factorize(rows[c], use_na_sentinel=False)
        out += [code.astype(np.int32).tobytes(), [x if isinstance(x, str) else None for x in texts]]
    return tuple(out)


def _unpacked(value: tuple) -> pd.DataFrame:
    rows = {c: np.frombuffer(bytes(x), kind) for (c, kind), x in zip(_NUMBERS, value)}
    for c, code, texts in zip(("key", "tie"), value[3::2], value[4::2]):
        rows[c] = np.array(texts, object)[np.frombuffer(bytes(code), np.int32)]
    return pd.DataFrame(rows)


_NUMBERS = (("t", np.int64), ("id", np.int64), ("amount", np.float64))
_BLOCK = "t binary, id binary, amount binary, key_code binary, key array<string>, tie_code binary, tie array<string>"


class SeriesProcessor(StatefulProcessor):
    """Features of the series of a group of keys, which grow in any order; ``campaign`` chooses W9-W10 instead of W1-W8."""

    def __init__(self, campaign: bool, cfg: FeatureConfig):
        self.campaign, self.cfg = campaign, cfg
        self.keep = cfg.win_72h if campaign else cfg.win_7d
        self.block = max(1, self.keep // 2)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getMapState("blocks", "block long", _BLOCK)
        self.before = handle.getValueState("before", "key array<string>, amount array<double>")

    def close(self) -> None:
        pass

    def _timer(self, block: int) -> None:
        self.handle.registerTimer(((block + 1) * self.block - 1 + self.keep) * 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        mark = max(0, timerValues.getCurrentWatermarkInMs() // 1000)
        late = (new["t"] < mark) | (new["t"] == MISSING)
        fresh = new[~late]
        if len(fresh):
            yield self._place(fresh)
        if late.any():
            gone = new[late]
            yield self._output(pd.DataFrame({"key": gone["key"], "id": gone["id"], "t": gone["t"], "amount": gone["amount"], "late": True}))

    def _evicted(self) -> dict:
        return dict(zip(*self.before.get(), strict=True)) if self.before.exists() else {}

    def _place(self, fresh: pd.DataFrame) -> pd.DataFrame:
        old = {int(b[0]): _unpacked(v) for b, v in self.blocks.iterator()}
        series = fresh[["t", "tie", "id", "amount", "key"]].astype({"amount": "float64"}).assign(fresh=True)
        series = pd.concat([*(o.assign(fresh=False) for o in old.values()), series], ignore_index=True)
        series["code"], keys = pd.factorize(series["key"], use_na_sentinel=False)
        series = series.sort_values(["code", "t", "tie", "id"], kind="stable", ignore_index=True)
        block = series["t"].to_numpy() // self.block
        for b in np.unique(block[series["fresh"]]):
            self.blocks.updateValue((int(b),), _packed(series[block == b]))
        if not old or int(block.min()) < min(old):
            self._timer(int(block.min()))
        # the series of the keys with new rows, one after another; (number of the key) * gap keeps their times apart
        series = series[np.isin(series["code"], series["code"][series["fresh"]])]
        t, amount, new = series["t"].to_numpy(np.int64), series["amount"].to_numpy(np.float64), series["fresh"].to_numpy(bool)
        first = np.flatnonzero(np.r_[True, np.diff(series["code"]) != 0])
        sizes = np.diff(np.r_[first, len(t)])
        number = np.repeat(np.arange(len(first)), sizes)
        place = t - t.min() + number * (t.max() - t.min() + self.keep + 1)
        at = np.arange(len(t))
        start, last = np.minimum.reduceat(np.where(new, at, len(t)), first), np.maximum.reduceat(np.where(new, at, -1), first)
        if self.campaign:
            features = campaign_features(place, series["id"].to_numpy() != MISSING, self.cfg)
            upto = t[last]
        else:
            prev, gone = np.r_[np.nan, amount[:-1]], self._evicted()
            prev[first] = [np.nan if (x := gone.get(k if isinstance(k, str) else None)) is None else x for k in keys[series["code"].to_numpy()[first]]]
            features = velocity_features(place, amount, self.cfg, prev, number)
            # the row after the last new one has a new lagged amount, which the windows that hold this row see
            upto = t[np.minimum(last + 1, first + sizes - 1)]
        out = pd.DataFrame({"key": series["key"].to_numpy(), "id": series["id"].to_numpy(), "t": t, "amount": amount, "late": False, **features})
        return self._output(out[(at >= start[number]) & ((t < (upto + self.keep)[number]) | (at <= last[number]))])

    def _output(self, rows: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split(" ") for c in (CAMPAIGN_SCHEMA if self.campaign else VELOCITY_SCHEMA).split(", ")]
        rows = rows.reindex(columns=[name for name, _ in columns])
        for c in ("id", "t"):
            rows[c] = rows[c].astype("Int64").mask(rows[c] == MISSING)
        return rows.astype({name: "Int32" for name, kind in columns if kind == "int"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        edge = timerValues.getCurrentWatermarkInMs() // 1000 - self.keep
        blocks = sorted(int(b[0]) for b in self.blocks.keys())
        gone = [b for b in blocks if (b + 1) * self.block - 1 <= edge]
        if gone and not self.campaign:
            before = self._evicted()
            for b in gone:
                rows = _unpacked(self.blocks.getValue((b,)))       # in the order of their series
                before |= {k: None if a != a else a for k, a in zip(rows["key"], rows["amount"].tolist(), strict=True)}
            self.before.update((list(before), list(before.values())))
        for b in gone:
            self.blocks.removeKey((b,))
        if len(gone) < len(blocks):
            self._timer(blocks[len(gone)])
        return iter(())


def _seconds(events: DataFrame, time_ts: str) -> Column:
    """Epoch seconds of a time with or without a zone, whatever the session's time zone."""
    if isinstance(events.schema[time_ts].dataType, T.TimestampNTZType):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(time_ts))
    return F.unix_seconds(F.col(time_ts).cast("timestamp"))


def _series_stream(events: DataFrame, key: Column, time_ts: str, id_col: str, amount: Column, tie: Column, campaign: bool,
                   cfg: FeatureConfig, delay: str) -> DataFrame:
    use_rocksdb(events.sparkSession)
    t = _seconds(events, time_ts)
    d = events.select(key.cast("string").alias("key"), F.col(id_col).cast("long").alias("_id"), t.alias("_t"), amount.cast("double").alias("amount"),
                      F.coalesce(tie.cast("string"), F.lit("")).alias("tie"), F.timestamp_seconds(t).alias("_ts"))
    # the watermark's column itself ends here: Spark would drop late rows without a trace, the processor counts them
    d = d.withWatermark("_ts", delay).select("key", F.coalesce("_id", F.lit(MISSING)).alias("id"), F.coalesce("_t", F.lit(MISSING)).alias("t"), "amount", "tie")
    return d.withColumn("_group", F.pmod(F.xxhash64("key"), F.lit(GROUPS))).groupBy("_group").transformWithStateInPandas(SeriesProcessor(campaign, cfg), CAMPAIGN_SCHEMA if campaign else VELOCITY_SCHEMA, "Update", "EventTime")


def velocity_stream(events: DataFrame, key: str, time_ts: str, id_col: str, amount: str,
                    cfg: FeatureConfig = FeatureConfig(), delay: str = "1 day") -> DataFrame:
    """W1-W8 per ``key``; ties in time are in the order of their ids. ``time_ts`` is the event time, ``delay`` how far behind
    the latest one a row may come. The last version of a (key, id) holds, see :func:`tidewatch.streaming.online.run_to_latest`."""
    return _series_stream(events, F.col(key), time_ts, id_col, F.col(amount), F.lit(""), False, cfg, delay)


def campaign_stream(events: DataFrame, key: str, time_ts: str, id_col: str, tie: str,
                    cfg: FeatureConfig = FeatureConfig(), delay: str = "1 day") -> DataFrame:
    """W9-W10 per fingerprint ``key``; ties in time are in the order of ``tie`` (the entity key) and id; rows without an id aren't counted."""
    return _series_stream(events, F.col(key), time_ts, id_col, F.lit(None), F.col(tie), True, cfg, delay)
