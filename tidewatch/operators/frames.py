"""Tie-exact time-range frames over per-key event series.

Semantics (matching the reference's stable-sorted pandas rolling windows):
a row's window ``(t - w, t]`` holds the rows of its key whose time is inside
that range *and* that come at or before it in (time, tiebreak) order, so later
rows that share its timestamp are excluded.

Order encoding: ``ord = t * K + seq`` with ``K = 2^31`` and ``seq`` the rank of
the row among rows of the same (key, t). A RANGE frame on ``ord`` with lower
bound ``w*K - K/2`` then selects exactly ``(t - w, t]`` minus later ties.

Scale design. A plain ``Window.partitionBy(key)`` puts a whole key in one task
and Spark re-aggregates every sliding frame (O(rows x frame)). Here the series
of a *hot* key (more rows than ``target_rows``) is cut into time chunks
(``chunk = floor(t / B_key)``, ``B_key`` a power of two, first sized for the key's
mean rate, then shortened until no chunk of a burst holds over twice
``target_rows`` rows or a chunk is one second) and work is keyed by ``(key, chunk)``, so a hot key
spreads over as many tasks as it has chunks; other keys form a single chunk.
The hot-key table has at most ``rows / target_rows`` entries, so it is
broadcast when its checked size is small and shuffle-joined otherwise.

A *hot second* (more than twice ``target_rows`` rows of one key in one second) is no
group of any window: its rows get their rank by a range-partitioned prefix sum over the
tie-break and are cut into slices of ``target_rows`` ranks, each a chunk of its own;
the seconds before and after it in the time chunk are two more. A row carries the hot
seconds of its own time chunk only (at most :data:`HOTS_IN_CHUNK`, chunks are shortened to
that), never all of its key: where each second of a key is hot, these grow with the time span.

* neighbours (previous / next row) are found inside the chunk, and across a
  chunk edge from a small per-(key, chunk) summary table;
* sliding sums/counts use *event deltas*: every row emits ``+v`` at its own
  ``ord`` and ``-v`` at ``(t + w) * K - 1`` (just before the first row it no
  longer belongs to); a running sum then equals the window sum. Running sums
  are distributed as chunk-local running sums plus per-chunk offsets from a
  prefix sum over the (tiny) chunk-total table. Values are integers (counts,
  fixed-point amounts), so the cancellation is exact. All rows of a hot second
  expire together, as one event with their sum, and so do the rows of any other second in a chunk.

Rows without a time have no place in a series; operators give them back with null
features (:func:`with_untimed`).

The per-chunk summary tables have one row per (key, chunk): they grow with the
time span, not with the row count of a key.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.quantiles import prefix_sums
from tidewatch.session import scratch_table

K = 1 << 31          # slots per second in the composite order (epoch seconds below 2^32, times K, fit a long)
HALF = K >> 1        # a plain RANGE frame is exact up to so many rows of a key in a second; event deltas up to K - 1

ORD = "_ord"
CHUNK = "_chunk"
CLEN = "_clen"
HOTS = "_hots"       # hot seconds in the row's time chunk, ascending, null for a key without any; the column exists only where some key has any
SLICE = "_slice"     # ranks of a hot second in one chunk
INTERNAL = (ORD, CHUNK, CLEN, HOTS, SLICE)


def clen_col(key: str) -> str:
    """Name of the carried chunk-length column of a key (see :func:`prepare_hot_keys`)."""
    return f"_clen__{key}"


def nohot_col(key: str) -> str:
    """Marker column: the key was checked and has no hot values."""
    return f"_clen__nohot__{key}"


def hots_col(key: str) -> str:
    """Name of the carried column of a key's hot seconds."""
    return f"_clen__hots__{key}"


BROADCAST_HOT_KEYS = 200_000   # rows of the hot-key table we are willing to broadcast
HOTS_IN_CHUNK = 16             # hot seconds in one time chunk


def frame_lower(window_seconds: int) -> int:
    """RANGE lower offset on ``ord`` for the half-open window ``(t - w, t]``."""
    return window_seconds * K - HALF


def assign_chunk_length(df: DataFrame, key: str, time: str, target_rows: int | None,
                        out: str = CLEN) -> DataFrame:
    """Add ``out``: chunk length in seconds for hot keys, null (= one chunk) otherwise.

    One aggregate job finds keys with more than ``target_rows`` rows (partial
    aggregation absorbs the skew); their number is bounded by rows/target_rows.
    ``target_rows=None`` disables chunking; ``0`` chunks every key (tests).
    """
    if target_rows is None:
        return df.withColumn(out, F.lit(None).cast("bigint")), False
    stats = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(time).alias("_t0"),
                                 F.max(time).alias("_t1"))
             .filter(F.col("_n") > F.lit(target_rows)))
    hot = stats.select(F.col(key).alias("_k"), _mean_length(target_rows).alias("_cl"))
    n_hot = hot.count()
    if n_hot == 0:
        return df.withColumn(out, F.lit(None).cast("bigint")), False
    hot, seconds = _refine(df.select(F.col(key).alias("_k"), F.col(time).alias("_t")), hot, n_hot, target_rows)
    df = df.join(_sized(hot, n_hot), F.col(key) == F.col("_k"), "left").drop("_k")
    df = _with_hots(df, seconds, F.col(key), F.col(time), "_cl", "_sliced", HOTS)
    return df.withColumnRenamed("_cl", out), True


def _mean_length(target_rows: int):
    """Chunk length for the mean rate of a key: a power of two of seconds."""
    span = F.greatest(F.col("_t1") - F.col("_t0") + 1, F.lit(1)).cast("double")
    want = F.greatest(span * F.lit(float(max(target_rows, 1))) / F.col("_n"), F.lit(1.0))
    return F.pow(F.lit(2.0), F.floor(F.log2(want))).cast("bigint")


def _sized(hot: DataFrame, n_hot: int) -> DataFrame:
    return F.broadcast(hot) if n_hot <= BROADCAST_HOT_KEYS else hot


def _refine(series: DataFrame, hot: DataFrame, n_hot: int, target_rows: int) -> tuple[DataFrame, tuple[DataFrame, int] | None]:
    """``hot`` (``_k``, ``_cl``) with ``_sliced`` (the key has hot seconds), and shorter chunks for keys whose rows come in
    bursts: lengths such that, hot seconds apart, no chunk has more than twice ``target_rows`` rows, and none has more than
    :data:`HOTS_IN_CHUNK` hot seconds, or a chunk is one second. Also the hot seconds by time chunk (``_hk``, ``_hc``, ``_h``)
    and the number of these rows, or None. ``series`` has ``_k`` and ``_t``; only hot keys are counted, each pass by a
    map-side combined count."""
    target = float(max(target_rows, 1))
    hot = scratch_table(hot, "hot-keys")
    crowds = series.join(_sized(hot, n_hot), "_k").groupBy("_k", "_t").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 2 * target)
    crowds = scratch_table(crowds.select("_k", "_t"), "hot-seconds")     # at most rows / (2 target) of them
    n_crowds = crowds.count()
    if n_crowds:
        series = series.join(_sized(crowds, n_crowds), ["_k", "_t"], "left_anti")
    chunk = F.floor(F.col("_t") / F.col("_cl"))

    def fullest(rows: DataFrame, out: str) -> DataFrame:
        each = rows.join(_sized(hot, n_hot), "_k").groupBy("_k", "_cl", chunk.alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
        return each.groupBy("_k", "_cl").agg(F.max("_n").alias(out))

    while True:
        most = hot.join(fullest(series, "_most"), ["_k", "_cl"], "left").join(fullest(crowds, "_hots_most"), ["_k", "_cl"], "left").fillna(0, ["_most", "_hots_most"])
        crowded = ((F.col("_most") > 2 * target) | (F.col("_hots_most") > HOTS_IN_CHUNK)) & (F.col("_cl") > 1)
        over = F.greatest(F.col("_most") / target, F.col("_hots_most") * 2.0 / HOTS_IN_CHUNK)
        shorter = F.greatest(F.lit(1.0), F.floor(F.col("_cl") / F.pow(F.lit(2.0), F.ceil(F.log2(over)))))
        step = scratch_table(most.select("_k", F.when(crowded, shorter.cast("bigint")).otherwise(F.col("_cl")).alias("_cl"), crowded.alias("_again")), "hot-keys")
        hot = step.select("_k", "_cl")
        if step.filter("_again").isEmpty():
            break
    if not n_crowds:
        return hot.withColumn("_sliced", F.lit(False)), None
    sliced = crowds.select("_k").distinct().withColumn("_sliced", F.lit(True))
    seconds = crowds.join(_sized(hot, n_hot), "_k").groupBy(F.col("_k").alias("_hk"), chunk.alias("_hc")).agg(F.sort_array(F.collect_list("_t")).alias("_h"))
    return hot.join(sliced, "_k", "left").fillna(False, ["_sliced"]), (seconds, n_crowds)


def _with_hots(df: DataFrame, seconds: tuple[DataFrame, int] | None, key: Column, time: Column, length: str, sliced: str, out: str) -> DataFrame:
    """``df`` with ``out``, the hot seconds in the time chunk of ``time`` (none: empty; null where the key has none at all), in place of ``sliced``."""
    if seconds is None:
        return df.drop(sliced)
    table, n = seconds
    df = df.join(_sized(table, n), (key == F.col("_hk")) & (F.floor(time / F.col(length)) == F.col("_hc")), "left")
    return df.withColumn(out, F.when(F.col(sliced), F.coalesce("_h", F.array().cast("array<bigint>")))).drop("_hk", "_hc", "_h", sliced)


def prepare_hot_keys(df: DataFrame, keys: Sequence[str], time: str,
                     target_rows: int | None = 1 << 21) -> DataFrame:
    """Compute every key's chunk length once, on the cheap keyed input, and carry it.

    One aggregate job covers all keys (unpivoted key columns); later operators
    on the same keys reuse the column instead of re-running the hot-key
    aggregate over their (expensive) inputs.
    """
    keys = list(keys)
    if target_rows is None:
        return df.select("*", *[F.lit(None).cast("bigint").alias(nohot_col(k)) for k in keys])
    arr = F.array(*[F.struct(F.lit(i).alias("_kid"), F.col(k).cast("string").alias("_k")) for i, k in enumerate(keys)])
    long = df.select(F.col(time).alias("_t"), F.inline(arr))
    stats = (long.groupBy("_kid", "_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_t0"),
                                            F.max("_t").alias("_t1"))
             .filter(F.col("_n") > F.lit(target_rows)))
    hot = stats.select(F.struct("_kid", "_k").alias("_k"), _mean_length(target_rows).alias("_cl"))
    rows = hot.count()            # bounded by len(keys) * rows / target_rows
    if rows:
        hot, seconds = _refine(long.select(F.struct("_kid", "_k").alias("_k"), "_t"), hot, rows, target_rows)
        hot = hot.select("_k._kid", "_k._k", "_cl", "_sliced")
    for i, k in enumerate(keys):
        if rows == 0:       # marker: no hot key, single-chunk plan (no chunk-edge joins)
            df = df.withColumn(nohot_col(k), F.lit(None).cast("bigint"))
            continue
        h = hot.filter(F.col("_kid") == i).select(F.col("_k").alias("_hkey"), F.col("_cl").alias(clen_col(k)), "_sliced")
        df = df.join(_sized(h, rows), F.col(k).cast("string") == F.col("_hkey"), "left").drop("_hkey")
        own = seconds and (seconds[0].filter(F.col("_hk._kid") == i).select(F.col("_hk._k").alias("_hk"), "_hc", "_h"), seconds[1])
        df = _with_hots(df, own, F.col(k).cast("string"), F.col(time).cast("bigint"), clen_col(k), "_sliced", hots_col(k))
    return df


def with_order(df: DataFrame, key: str, time: str, tiebreak: Sequence[str],
               target_rows: int | None = 1 << 21, repartition: bool = True) -> tuple[DataFrame, bool]:
    """Add ``_clen``/``_chunk`` (time chunk) and ``_ord`` (tie-exact composite order).

    Returns ``(df, chunked)``; ``chunked`` is False when no key is hot, and the
    helpers below then skip the chunk-edge summaries (each key is one chunk).
    With ``target_rows=None`` no key is chunked (plain per-key layout, used by
    the ``frame`` strategy). Rows without a time are left out (see :func:`with_untimed`).
    """
    d = df.withColumn(time, F.col(time).cast("bigint")).filter(F.col(time).isNotNull())
    if clen_col(key) in d.columns:          # precomputed once upstream, reuse it
        d, chunked = d.withColumn(CLEN, F.col(clen_col(key))), True
        if hots_col(key) in d.columns:
            d = d.withColumn(HOTS, F.col(hots_col(key)))
    elif nohot_col(key) in d.columns:
        d, chunked = d.withColumn(CLEN, F.lit(None).cast("bigint")), False
    else:
        d, chunked = assign_chunk_length(d, key, time, target_rows)
    if HOTS in d.columns:
        return _sliced_order(d, key, time, tiebreak, max(target_rows or 1, 1)), True
    d = d.withColumn(CHUNK, chunk_of(d, F.col(time), None))
    if repartition:
        # hash on the key alone when nothing is chunked: every later window
        # (key,t), (key), (key, chunk=const) is then satisfied without a new exchange
        d = d.repartition(key, CHUNK) if chunked else d.repartition(key)
    w = Window.partitionBy(key, CHUNK, time).orderBy(*[F.col(c).asc_nulls_first() for c in tiebreak])
    return _with_ord(d, time, F.row_number().over(w) - 1, HALF if target_rows is None else K - 1), chunked


def _with_ord(d: DataFrame, time: str, seq: Column, room: int) -> DataFrame:
    guard = F.when(seq >= room, F.raise_error(F.lit(f"more than {room} rows share one (key, second)")))
    return d.withColumn(ORD, F.coalesce(guard.cast("bigint"), F.col(time) * F.lit(K) + seq))


def _in_hot_second(time: Column) -> Column:
    return F.coalesce(F.array_contains(F.col(HOTS), time), F.lit(False))


def chunk_of(d: DataFrame, time: Column, seq: Column | None) -> Column:
    """Chunk of the place (``time``, ``seq``) of a key's series; chunks of a key ascend with its order. A key with hot seconds
    has its chunks named by their first place; ``_hots`` holds those in the time chunk of ``time``."""
    length = F.floor(time / F.col(CLEN))
    plain = F.coalesce(length, F.lit(0)).cast("bigint")
    if HOTS not in d.columns:
        return plain
    start = length * F.col(CLEN)
    after = F.array_max(F.filter(F.col(HOTS), lambda h: (h < time) & (h >= start))) + 1
    zone = F.greatest(start, F.coalesce(after, start)) * F.lit(K)
    cut = time * F.lit(K) + F.floor(seq / F.col(SLICE)) * F.col(SLICE)
    return F.when(F.col(HOTS).isNull(), plain).when(_in_hot_second(time), cut).otherwise(zone).cast("bigint")


def _sliced_order(d: DataFrame, key: str, time: str, tiebreak: Sequence[str], target_rows: int) -> DataFrame:
    """The order where some keys have hot seconds: ranks in these come from a prefix sum over the tie-break, other ranks from a window."""
    d = d.withColumn(SLICE, F.lit(target_rows).cast("bigint"))
    hot = _in_hot_second(F.col(time))
    w = Window.partitionBy(key, time).orderBy(*[F.col(c).asc_nulls_first() for c in tiebreak])
    few = d.filter(~hot).withColumn("_seq", (F.row_number().over(w) - 1).cast("bigint"))
    many = prefix_sums(d.filter(hot).withColumn("_one", F.lit(1).cast("bigint")), list(tiebreak), ["_one"], [key, time])
    many = many.withColumn("_seq", F.col("_one_cum") - 1).drop("_one", "_one_cum", "_one_total")
    d = _with_ord(few.unionByName(many), time, F.col("_seq"), K - 1)
    d = d.withColumn(CHUNK, chunk_of(d, F.col(time), F.col("_seq"))).drop("_seq")
    return d.repartition(key, CHUNK)


def with_untimed(out: DataFrame, df: DataFrame, time: str) -> DataFrame:
    """``out`` and the rows of ``df`` that have no time, whose new columns are null."""
    t = F.col(time).cast("bigint")
    return out.unionByName(df.withColumn(time, t).filter(F.col(time).isNull()), allowMissingColumns=True)


def previous_values(d: DataFrame, key: str, cols: Sequence[str], prefix: str = "_prev_",
                    chunked: bool = True) -> DataFrame:
    """``lag(c)`` over the whole key series for each column (needs ``with_order``)."""
    w = Window.partitionBy(key, CHUNK).orderBy(ORD)
    if not chunked:
        return d.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in cols])
    d = d.withColumn("_first_in_chunk", F.lag(ORD).over(w).isNull())
    for c in cols:
        d = d.withColumn(prefix + c, F.lag(c).over(w))
    summ = d.groupBy(key, CHUNK).agg(*[F.max_by(c, ORD).alias("_last_" + c) for c in cols])
    ws = Window.partitionBy(key).orderBy(CHUNK)
    summ = summ.select(key, CHUNK, *[F.lag("_last_" + c).over(ws).alias("_edge_" + c) for c in cols])
    d = d.join(summ, [key, CHUNK], "left")
    keep = [F.col(c) for c in d.columns if c not in set(prefix + x for x in cols) and not c.startswith("_edge_")
            and c != "_first_in_chunk"]
    return d.select(*keep, *[F.when(F.col("_first_in_chunk"), F.col("_edge_" + c))
                             .otherwise(F.col(prefix + c)).alias(prefix + c) for c in cols])


def next_values(d: DataFrame, key: str, cols: Sequence[str], prefix: str = "_next_",
                chunked: bool = True) -> DataFrame:
    """``lead(c)`` over the whole key series for each column (needs ``with_order``)."""
    w = Window.partitionBy(key, CHUNK).orderBy(ORD)
    if not chunked:
        return d.select("*", *[F.lead(c).over(w).alias(prefix + c) for c in cols])
    d = d.withColumn("_last_in_chunk", F.lead(ORD).over(w).isNull())
    for c in cols:
        d = d.withColumn(prefix + c, F.lead(c).over(w))
    summ = d.groupBy(key, CHUNK).agg(*[F.min_by(c, ORD).alias("_first_" + c) for c in cols])
    ws = Window.partitionBy(key).orderBy(CHUNK)
    summ = summ.select(key, CHUNK, *[F.lead("_first_" + c).over(ws).alias("_edge_" + c) for c in cols])
    d = d.join(summ, [key, CHUNK], "left")
    keep = [F.col(c) for c in d.columns if c not in set(prefix + x for x in cols) and not c.startswith("_edge_")
            and c != "_last_in_chunk"]
    return d.select(*keep, *[F.when(F.col("_last_in_chunk"), F.col("_edge_" + c))
                             .otherwise(F.col(prefix + c)).alias(prefix + c) for c in cols])


def next_time_where(d: DataFrame, key: str, time: str, cond: Column, out: str,
                    chunked: bool = True) -> DataFrame:
    """Earliest time ``> t`` of a row of the same key where ``cond`` holds (null if none).

    A growing frame over descending time inside the chunk (O(n)), plus the
    minimum over all later chunks from the chunk summary.
    """
    hit = F.when(cond, F.col(time))
    w = (Window.partitionBy(key, CHUNK).orderBy((-F.col(time)).alias("_neg_t"))
         .rangeBetween(Window.unboundedPreceding, -1))
    d = d.withColumn(out, F.min(hit).over(w))
    if not chunked:
        return d
    # slices of one second count as one: their rows aren't later than each other
    zone = F.when(F.col(HOTS).isNotNull(), F.floor(F.col(CHUNK) / K) * K).otherwise(F.col(CHUNK)) if HOTS in d.columns else F.col(CHUNK)
    d = d.withColumn("_zone", zone)
    summ = d.groupBy(key, "_zone").agg(F.min(hit).alias("_cmin"))
    ws = Window.partitionBy(key).orderBy(F.col("_zone").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(key, "_zone", F.min("_cmin").over(ws).alias("_later"))
    d = d.join(summ, [key, "_zone"], "left")
    return d.withColumn(out, F.coalesce(F.col(out), F.col("_later"))).drop("_later", "_zone")


def sliding_sums(d: DataFrame, key: str, time: str, specs: Iterable[tuple], chunked: bool = True) -> DataFrame:
    """Window sums over ``(t - w, t]`` (tie-exact) via chunked event deltas.

    ``specs``: ``(out_name, window_seconds, value_column)`` with integer-valued
    (long / decimal(38,0)) values; nulls count as 0. ``d`` must come from
    :func:`with_order`.
    """
    specs = list(specs)
    names = [s[0] for s in specs]
    types = d.select(*[F.coalesce(s[2], F.lit(0)).alias(s[0]) for s in specs]).schema
    zero = {n: F.lit(0).cast(types[n].dataType) for n in names}
    vals = {s[0]: F.coalesce(s[2], F.lit(0)).cast(types[s[0]].dataType) for s in specs}
    payload = [f for f in d.schema.fields if f.name != key]
    sliced = HOTS in d.columns
    # the rows of one second expire together: the last of them in its chunk carries their sum
    second = Window.partitionBy(key, CHUNK, time).orderBy(ORD)
    running = second.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.select("*", F.lead(ORD).over(second).isNull().alias("_ends"),
                 *[F.sum(vals[n]).over(running).cast(types[n].dataType).alias("_sum_" + n) for n in names])
    # One row in -> itself, and at the end of a second one event for each distinct window, in a single pass over d; expiry
    # events carry null payload, so the shuffle only moves the deltas for them.
    row = F.struct(*[F.col(f.name).alias(f.name) for f in payload],
                   F.col(ORD).alias("_eord"), F.col(CHUNK).alias("_echunk"), F.lit(None).cast("bigint").alias("_et"),
                   F.lit(True).alias("_is_row"), *[vals[n].alias(n) for n in names])

    def expiries(values: dict) -> list[Column]:
        return [F.struct(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in payload],
            ((F.col(time) + F.lit(w)) * F.lit(K) - F.lit(1)).alias("_eord"),
            (F.lit(None).cast("bigint") if sliced else chunk_of(d, F.col(time) + F.lit(w - 1), None)).alias("_echunk"),
            (F.col(time) + F.lit(w - 1)).alias("_et"),
            F.lit(False).alias("_is_row"),
            *[(-values[n] if s[1] == w else zero[n]).cast(types[n].dataType).alias(n) for n, s in zip(names, specs)])
            for w in sorted({s[1] for s in specs})]

    # the key passes through the generator untouched (it is not referenced inside the
    # structs), so its hash partitioning survives; everything else comes out of the structs
    every = F.array(row, *expiries({n: F.col("_sum_" + n) for n in names}))
    if sliced:
        ev = _sliced_events(d, key, time, row, expiries, vals)
    else:
        ev = d.select(F.col(key), F.inline(F.when(F.col("_ends"), every).otherwise(F.array(row))))
    payload = [f.name for f in payload]
    if not chunked:
        # one chunk per key: events stay in their key's partition (no shuffle)
        wrun = (Window.partitionBy(key, "_echunk").orderBy("_eord")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ev = ev.select(key, *payload, "_is_row", *[F.sum(n).over(wrun).alias(n) for n in names])
        return ev.filter("_is_row").select(key, *payload, *names)
    ev = ev.repartition(key, "_echunk")
    # per-chunk totals -> offsets = prefix sum over the key's earlier chunks (one row per chunk)
    tot = ev.groupBy(key, "_echunk").agg(*[F.sum(n).alias(n) for n in names])
    wo = Window.partitionBy(key).orderBy("_echunk").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(key, "_echunk", *[F.sum(n).over(wo).alias("_off_" + n) for n in names])
    wrun = (Window.partitionBy(key, "_echunk").orderBy("_eord")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ev = ev.select(key, *payload, "_echunk", "_is_row", *[F.sum(n).over(wrun).alias(n) for n in names])
    ev = ev.filter("_is_row").join(tot, [key, "_echunk"], "left")
    return ev.select(key, *[c for c in payload if c != "_echunk"],
                     *[(F.col(n) + F.coalesce(F.col("_off_" + n), zero[n])).alias(n) for n in names])


def _sliced_events(d: DataFrame, key: str, time: str, row: Column, expiries, vals: dict) -> DataFrame:
    """Events of a series with hot seconds: all rows of such a second, in whatever slices, expire as one event. The chunk of an
    expiry comes by a join with the hot seconds of the time chunk in which it falls; rows know theirs."""
    hot = _in_hot_second(F.col(time))
    place = (CLEN, HOTS, SLICE)
    kept = d.select(F.col(key), F.inline(F.array(row)))
    ends = d.filter(F.col("_ends") & ~hot).select(key, time, *place, *["_sum_" + n for n in vals])
    many = d.filter(hot).groupBy(key, time).agg(*[F.first(c).alias(c) for c in place], *[F.sum(v).alias("_sum_" + n) for n, v in vals.items()])
    many = scratch_table(many, "hot-sums")             # a row for each hot second
    n = many.count()
    gone = ends.unionByName(many).select(F.col(key), F.col(CLEN).alias("_xl"), F.col(HOTS).isNotNull().alias("_xs"), F.col(SLICE).alias("_xn"),
                                         F.inline(F.array(*expiries({n: F.col("_sum_" + n) for n in vals}))))
    seconds = many.select(F.col(key).alias("_hk"), F.floor(F.col(time) / F.col(CLEN)).alias("_hc"), F.col(time).alias("_t")).groupBy("_hk", "_hc").agg(F.sort_array(F.collect_list("_t")).alias("_h"))
    gone = _with_hots(gone, (seconds, n), F.col(key), F.col("_et"), "_xl", "_xs", "_xh")
    columns = [c for c in gone.columns if c not in (CLEN, HOTS, SLICE, "_xl", "_xh", "_xn")]
    at = gone.drop(*place).withColumnsRenamed({"_xl": CLEN, "_xh": HOTS, "_xn": SLICE})
    at = at.withColumn("_echunk", chunk_of(at, F.col("_et"), F.lit(K - 1)))
    return kept.unionByName(at.select(*columns), allowMissingColumns=True)
