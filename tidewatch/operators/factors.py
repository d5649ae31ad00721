"""M8: learned key embeddings, trained in Spark.

A factorisation machine over standardised numerics and hashed key buckets: every numeric and
every bucket has a weight and a vector of latent factors, and the logit is

    b + sum_j w_j x_j + sum_f c_f + sum of <factors, factors> x x over all pairs,

so an entity, a fingerprint and the numerics act on each other through what is learned of
each. The loss is cross-entropy with positives weighted neg / pos (M9), plus an L2 penalty.

A gradient is one pass over a written table: tasks add up the rows of the parameters that
their rows touch, Spark sums these by parameter row, and one row for each goes to the driver,
which takes L-BFGS steps. Parameters are those of the buckets seen in training (at most the
buckets of the hash), never one for each key. Average precision on the validation part is
read every few steps; training stops when it hasn't grown for ``patience`` readings, and the
best parameters stay. Scoring is joins on the buckets and column expressions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import ENTITY_BUCKETS, FINGERPRINT_BUCKETS
from tidewatch.functions.keys import stable_hash_bucket
from tidewatch.operators import prep
from tidewatch.operators.metrics import binary_metrics
from tidewatch.session import scratch_table


@dataclass(frozen=True)
class FactorConfig:
    factors: int = 8
    penalty: float = 1e-3
    max_iter: int = 60
    check_every: int = 5
    patience: int = 3          # readings of the validation score without a gain
    min_gain: float = 1e-5
    tolerance: float = 1e-6    # of the gradient's largest component
    memory: int = 8
    seed: int = 42
    buckets: Mapping[str, int] = field(default_factory=lambda: {"entity_key": ENTITY_BUCKETS, "fingerprint_key": FINGERPRINT_BUCKETS})


def forward(theta: np.ndarray, x: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logits and summed factors of rows ``x`` (n x numerics) with parameter rows ``slots`` (n x keys, -1: none).
    ``theta``: row 0 the intercept, one row for each numeric, one for each bucket; column 0 weights, the others factors."""
    num = theta[1:x.shape[1] + 1]
    summed, z = x @ num[:, 1:], theta[0, 0] + x @ num[:, 0] - 0.5 * ((x * x) @ (num[:, 1:] ** 2).sum(axis=1))
    for f in range(slots.shape[1]):
        key = theta[np.maximum(slots[:, f], 0)]
        key[slots[:, f] < 0] = 0.0
        summed += key[:, 1:]
        z += key[:, 0] - 0.5 * np.einsum("ij,ij->i", key[:, 1:], key[:, 1:])
    return z + 0.5 * np.einsum("ij,ij->i", summed, summed), summed


def _runs(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows that have a slot, by slot; where each slot's run starts among them; the slots."""
    order = np.argsort(slots, kind="stable")
    order = order[np.searchsorted(slots[order], 0):]
    touched, starts = np.unique(slots[order], return_index=True)
    return order, starts, touched


def gradient(theta: np.ndarray, x: np.ndarray, slots: np.ndarray, y: np.ndarray, w: np.ndarray,
             out: np.ndarray | None = None, runs: Sequence | None = None) -> tuple[float, np.ndarray]:
    """Weighted cross-entropy, summed, and its gradient, added to ``out`` if given. ``runs``: :func:`_runs` of each key's slots, if known."""
    z, summed = forward(theta, x, slots)
    loss = float((w * (np.logaddexp(0.0, z) - y * z)).sum())
    g = w * (1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - y)
    out, j = np.zeros_like(theta) if out is None else out, x.shape[1]
    out[0, 0] += g.sum()
    out[1:j + 1, 0] += x.T @ g
    out[1:j + 1, 1:] += x.T @ (g[:, None] * summed) - ((x * x).T @ g)[:, None] * theta[1:j + 1, 1:]
    for f in range(slots.shape[1]):
        order, starts, touched = _runs(slots[:, f]) if runs is None else runs[f]
        if len(touched):
            s, by = slots[order, f], g[order]
            out[touched] += np.add.reduceat(np.c_[by, by[:, None] * (summed[order] - theta[s, 1:])], starts, axis=0)
    return loss, out


BLOCK = 8192     # rows packed in one
_BLOCKS = "n int, x binary, slots binary, y binary, w binary, runs array<binary>"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (``x``, ``y``, ``w``, ``slots``) as blocks of :data:`BLOCK` rows, each a row of plain buffers with the runs of its slots: a step of
    the training reads these and converts no row. Every row is in one block."""
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            c = b.slice(at, BLOCK)
            slots = c.column("slots").flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(c.num_rows, -1)
            flat = {"x": c.column("x").flatten(), "y": c.column("y"), "w": c.column("w")}
            buffers = {k: v.to_numpy(zero_copy_only=False).astype(np.float64).tobytes() for k, v in flat.items()}
            runs = [r.astype(np.int32).tobytes() for f in range(slots.shape[1]) for r in _runs(slots[:, f])]
            yield pa.RecordBatch.from_pydict({"n": pa.array([c.num_rows], pa.int32()), "x": [buffers["x"]], "slots": [slots.tobytes()], "y": [buffers["y"]], "w": [buffers["w"]],
                                              "runs": pa.array([runs], pa.list_(pa.binary()))})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]]:
    """``x``, ``slots``, ``y``, ``w`` and runs of each block."""
    for b in batches:
        for i in range(b.num_rows):
            n = b.column("n")[i].as_py()
            floats = lambda c: np.frombuffer(b.column(c)[i].as_buffer(), np.float64)
            ints = [np.frombuffer(r.as_buffer(), np.int32) for r in b.column("runs")[i].values] if "runs" in b.schema.names else []
            yield (floats("x").reshape(n, -1), np.frombuffer(b.column("slots")[i].as_buffer(), np.int32).reshape(n, -1), floats("y"),
                   floats("w") if "w" in b.schema.names else None, [*zip(ints[::3], ints[1::3], ints[2::3], strict=True)])


def _partial(theta: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, total = 0.0, np.zeros_like(theta)
        for x, slots, y, w, runs in _blocks(batches):
            loss += gradient(theta, x, slots, y, w, total, runs)[0]
        rows = np.flatnonzero(np.abs(total).sum(axis=1))
        columns = [pa.array(np.r_[-1, rows].astype(np.int32)), *(pa.array(np.r_[loss if k == 0 else 0.0, total[rows, k]]) for k in range(theta.shape[1]))]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", *(f"g{k}" for k in range(theta.shape[1]))])

    return run


def lbfgs(objective: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, cfg: FactorConfig,
          watch: Callable[[int, np.ndarray], bool] = lambda k, t: False) -> tuple[np.ndarray, np.ndarray, int]:
    """Minimise; ``watch(step, parameters)`` may stop it. Returns parameters, gradient and the number of steps."""
    theta = start.copy()
    value, g = objective(theta)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    k = 0
    while k < cfg.max_iter and np.abs(g).max() > cfg.tolerance:
        d, seen = g.copy(), []
        for s, yv in reversed(steps):
            a = (s * d).sum() / (s * yv).sum()
            d -= a * yv
            seen.append(a)
        if steps:
            s, yv = steps[-1]
            d *= (s * yv).sum() / (yv * yv).sum()
        else:
            d /= max(1.0, float(np.abs(g).sum()))
        for (s, yv), a in zip(steps, reversed(seen), strict=True):
            d += s * (a - (yv * d).sum() / (s * yv).sum())
        slope, rate = float((g * d).sum()), 1.0
        for _ in range(30):
            trial = theta - rate * d
            new, ng = objective(trial)
            if new <= value - 1e-4 * rate * slope:
                break
            rate *= 0.5
        else:
            break
        s, yv = trial - theta, ng - g
        if (s * yv).sum() > 1e-12 * (yv * yv).sum():
            steps = [*steps, (s, yv)][-cfg.memory:]
        theta, value, g = trial, new, ng
        k += 1
        if watch(k, theta):
            break
    return theta, g, k


@dataclass
class FactorModel:
    """A fitted model: parameters of the numerics, and of each key's buckets as written tables."""

    numeric: list
    stats: DataFrame
    cfg: FactorConfig
    dense: np.ndarray                 # intercept and numerics
    tables: dict                      # key column -> DataFrame (bucket, w, v)
    gradient_size: float              # largest component of the objective's gradient at the last step
    steps: int
    history: list                     # (step, validation average precision)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``logit`` and ``score``. A bucket that training hasn't seen has no effect; a missing numeric is the mean."""
        d = prep.transform_numeric(df, self.stats, self.numeric, suffix="__z")
        for i, (key, table) in enumerate(self.tables.items()):
            t = table.select(F.col("bucket").alias(f"__b{i}"), F.col("w").alias(f"__w{i}"), F.col("v").alias(f"__v{i}"))
            d = d.withColumn(f"__b{i}", stable_hash_bucket(key, self.cfg.buckets[key])).join(t, f"__b{i}", "left")
        x = [F.col(f"{c}__z").cast("double") for c in self.numeric]
        zero = F.lit(0.0)

        def total(parts: Sequence[Column]) -> Column:
            out = zero
            for p in parts:
                out = out + p
            return out

        linear = total([F.lit(float(self.dense[0, 0])), *(F.lit(float(self.dense[j + 1, 0])) * c for j, c in enumerate(x)), *(F.coalesce(f"__w{i}", zero) for i in range(len(self.tables)))])
        pairs = []
        for k in range(self.cfg.factors):
            terms = [F.lit(float(self.dense[j + 1, k + 1])) * c for j, c in enumerate(x)] + [F.coalesce(F.col(f"__v{i}")[k], zero) for i in range(len(self.tables))]
            s = f"__s{k}"
            d = d.withColumn(s, total(terms))
            pairs.append(F.col(s) * F.col(s) - total([t * t for t in terms]))
        d = d.withColumn("logit", linear + F.lit(0.5) * total(pairs)).withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit"))))
        return d.select(*df.columns, "logit", "score")


def fit_factors(train: DataFrame, valid: DataFrame, y: str, numeric: Sequence[str], keys: Sequence[str] = ("entity_key", "fingerprint_key"),
                cfg: FactorConfig = FactorConfig()) -> FactorModel:
    """Train on ``train``, choose the step by average precision on ``valid``."""
    numeric, keys = list(numeric), list(keys)
    stats = prep.fit_standardizer(train, numeric)
    weight = prep.class_weights(train, y).first()["pos_weight"]

    def rows(df: DataFrame) -> DataFrame:
        d = prep.transform_numeric(df.select(*numeric, *keys, y), stats, numeric)
        return d.select(F.array(*[F.col(c).cast("double") for c in numeric]).alias("x"), F.coalesce(F.col(y).cast("double"), F.lit(0.0)).alias("y"),
                        *[stable_hash_bucket(k, cfg.buckets[k]).alias(f"b{i}") for i, k in enumerate(keys)])

    part = scratch_table(rows(train), "factor-rows")
    first, places = 1 + len(numeric), []
    for i in range(len(keys)):            # at most the buckets of the hash
        found = np.sort(np.array([r[0] for r in part.select(f"b{i}").distinct().collect()], np.int64))
        places.append((found, first))
        first += len(found)
    spark = train.sparkSession
    row_weight = F.when(F.col("y") == 1, F.lit(float(weight))).otherwise(F.lit(1.0))

    def placed(d: DataFrame) -> DataFrame:
        for i, (found, at) in enumerate(places):
            t = spark.createDataFrame([(int(b), at + n) for n, b in enumerate(found)], f"b{i} int, s{i} int")
            d = d.join(F.broadcast(t), f"b{i}", "left")
        return d.select("x", "y", row_weight.alias("w"), F.array(*[F.coalesce(f"s{i}", F.lit(-1)) for i in range(len(keys))]).alias("slots"))

    data = scratch_table(placed(part).mapInArrow(_packed, _BLOCKS), "factor-train")
    held = scratch_table(placed(rows(valid)).mapInArrow(_packed, _BLOCKS), "factor-valid")
    mass = part.agg(F.sum(row_weight)).first()[0] or 1.0
    theta = np.zeros((first, 1 + cfg.factors))
    theta[1:, 1:] = np.random.default_rng(cfg.seed).normal(0.0, 0.05, size=(first - 1, cfg.factors))
    schema = "slot int, " + ", ".join(f"g{k} double" for k in range(1 + cfg.factors))
    penalised = np.ones_like(theta)
    penalised[0] = 0.0

    def objective(t: np.ndarray) -> tuple[float, np.ndarray]:
        got = data.mapInArrow(_partial(t), schema).groupBy("slot").agg(*[F.sum(f"g{k}").alias(f"g{k}") for k in range(t.shape[1])]).toArrow()
        slot, values = got.column("slot").to_numpy(), np.stack([got.column(f"g{k}").to_numpy() for k in range(t.shape[1])], axis=1)
        g = np.zeros_like(t)
        g[slot[slot >= 0]] = values[slot >= 0]
        loss = float(values[slot < 0, 0].sum())
        return loss / mass + 0.5 * cfg.penalty * float((penalised * t * t).sum()), g / mass + cfg.penalty * penalised * t

    history, best = [], (-1.0, 0, theta)

    def reading(step: int, t: np.ndarray) -> bool:
        nonlocal best
        if step % cfg.check_every and step != cfg.max_iter:
            return False
        ap = binary_metrics(_scored(held, t)).first().avg_precision or 0.0
        history.append((step, ap))
        if ap > best[0] + cfg.min_gain:
            best = (ap, len(history), t.copy())
        return len(history) - best[1] >= cfg.patience

    last, g, steps = lbfgs(objective, theta, cfg, reading)
    chosen = best[2] if history else last
    tables = {}
    for key, (found, at) in zip(keys, places, strict=True):
        t = spark.createDataFrame([(int(b), float(chosen[at + n, 0]), [float(v) for v in chosen[at + n, 1:]]) for n, b in enumerate(found)], "bucket int, w double, v array<double>")
        tables[key] = scratch_table(t, f"factors-{key}")
    return FactorModel(numeric, stats, cfg, chosen[:1 + len(numeric)].copy(), tables, float(np.abs(g).max()), steps, history)


def _scored(blocks: DataFrame, theta: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, slots, y, _, _ in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(y.astype(np.int32)), pa.array(1.0 / (1.0 + np.exp(-forward(theta, x, slots)[0])))], names=["y", "p"])

    return blocks.select("n", "x", "slots", "y").mapInArrow(run, "y int, p double")
