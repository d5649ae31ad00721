"""Ranking and calibration metrics (E1-E9) without collecting scores.

All curve metrics start from the score table: one row per distinct score with
positive / negative counts (a map-side-combined aggregate), then cumulative
counts via the distributed prefix sum. Score ties are therefore exact:

* AUC counts a tied (pos, neg) pair as 1/2;
* average precision is the step sum ``sum_n (R_n - R_{n-1}) P_n`` over
  distinct thresholds (not the trapezoid of MLlib's ``areaUnderPR``).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.exprs import nan_to_null
from tidewatch.operators.quantiles import assign_bin, exact_quantiles, prefix_sums

LOGLOSS_EPS = 2.220446049250313e-16   # float64 machine epsilon, the clip used for log-loss


def score_table(scored: DataFrame, y: str = "y", p: str = "p", n_buckets: int | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """Distinct scores (per group) with pos/neg counts and inclusive ascending cumulative counts."""
    c = (scored.select(*groups, nan_to_null(F.col(p)).alias("s"), F.col(y).cast("int").alias("y"))
         .filter(F.col("s").isNotNull())
         .groupBy(*groups, "s").agg(F.sum((F.col("y") == 1).cast("bigint")).alias("pos"),
                           F.sum((F.col("y") != 1).cast("bigint")).alias("neg")))
    return prefix_sums(c, ["s"], ["pos", "neg"], groups, n_buckets=n_buckets)


def _curve(st: DataFrame) -> DataFrame:
    """Add tp/fp (counts with score >= s), precision and recall per threshold."""
    tp = F.col("pos_total") - (F.col("pos_cum") - F.col("pos"))
    fp = F.col("neg_total") - (F.col("neg_cum") - F.col("neg"))
    return st.select("*", tp.alias("tp"), fp.alias("fp"),
                     (tp / (tp + fp)).alias("precision"),
                     (tp / F.nullif(F.col("pos_total"), F.lit(0))).alias("recall"))


def binary_metrics(scored: DataFrame, y: str = "y", p: str = "p", n_buckets: int | None = None) -> DataFrame:
    """E1 + E5: one row ``(auc_roc, avg_precision, brier)``."""
    st = _curve(score_table(scored, y, p, n_buckets))
    P, N = F.first("pos_total"), F.first("neg_total")
    auc_num = F.sum(F.col("pos") * (F.col("neg_cum") - F.col("neg") + F.col("neg") / 2.0))
    ap = F.sum(F.when(F.col("pos") > 0, F.col("pos") / F.col("pos_total") * F.col("precision")))
    curve = st.agg((auc_num / (P * N)).alias("auc_roc"), ap.alias("avg_precision"))
    return curve.crossJoin(brier(scored, y, p))


def pr_curve(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Threshold, precision, recall per distinct score (plus the base rate)."""
    st = _curve(score_table(scored, y, p))
    return st.select(F.col("s").alias("threshold"), "precision", "recall",
                     (F.col("pos_total") / (F.col("pos_total") + F.col("neg_total"))).alias("base_rate"))


def pr_curve_thinned(scored: DataFrame, n_points: int = 200, y: str = "y", p: str = "p", n_buckets: int | None = None) -> DataFrame:
    """E2 for reports: at most ``n_points`` points of the curve, from the cumulative counts of the distinct scores.

    Recall is cut into ``n_points - 1`` equal steps (and zero); of the points that end in a step the one
    with the highest recall, and among these the highest threshold, stays. Average precision changes in a
    step by no more than ``area_slack``, its width times the range of precision in it, so the thinned
    curve's differs from the whole curve's by at most the sum of these. Columns: ``step``, ``threshold``,
    ``precision``, ``recall``, ``base_rate``, ``area`` (the step's share of the thinned average
    precision), ``area_slack``. A step that a large tie jumps over is absent.
    """
    if n_points < 2:
        raise ValueError("a curve has two points at least")
    st = _curve(score_table(scored, y, p, n_buckets)).filter(F.col("pos_total") > 0)
    step = F.ceil(F.col("tp") * (n_points - 1) / F.col("pos_total")).cast("int")
    point = F.struct("s", "precision", "recall", (F.col("pos_total") / (F.col("pos_total") + F.col("neg_total"))).alias("base_rate"))
    cells = st.withColumn("step", step).groupBy("step").agg(F.max_by(point, F.struct("tp", -F.col("fp"))).alias("at"),
                                                           F.min("precision").alias("_least"), F.max("precision").alias("_most"))
    w = Window.orderBy("step")          # at most n_points rows
    d = cells.withColumn("_width", F.col("at.recall") - F.coalesce(F.lag("at.recall").over(w), F.lit(0.0)))
    return d.select("step", F.col("at.s").alias("threshold"), "at.precision", "at.recall", "at.base_rate",
                    (F.col("_width") * F.col("at.precision")).alias("area"), (F.col("_width") * (F.col("_most") - F.col("_least"))).alias("area_slack"))


def best_f1_threshold(scored: DataFrame, y: str = "y", p: str = "p", compat: bool = False) -> DataFrame:
    """Threshold maximising ``F1 = 2PR/(P+R+1e-12)``.

    Candidate thresholds run from the lowest positive score upwards (the curve
    stops once full recall is reached); ties go to the lowest threshold. With
    ``compat=True`` the reported threshold is the next lower candidate, the
    off-by-one of the original implementation.
    """
    st = _curve(score_table(scored, y, p))
    lowest_pos = st.filter(F.col("pos") > 0).agg(F.min("s").alias("_lo"))
    cand = st.crossJoin(F.broadcast(lowest_pos)).filter(F.col("s") >= F.col("_lo"))
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-12))
    cand = cand.withColumn("f1", f1)
    best = cand.agg(F.max(F.struct(F.col("f1"), (-F.col("s")).alias("neg_s"), F.col("precision"),
                                   F.col("recall"))).alias("b"))
    best = best.select((-F.col("b.neg_s")).alias("s_best"), F.col("b.f1").alias("best_f1"),
                       F.col("b.precision").alias("precision_at_best"), F.col("b.recall").alias("recall_at_best"))
    if compat:
        prev = cand.crossJoin(F.broadcast(best)).filter(F.col("s") < F.col("s_best")).agg(F.max("s").alias("_prev"))
        best = best.crossJoin(prev).withColumn("s_best", F.coalesce(F.col("_prev"), F.col("s_best"))).drop("_prev")
    return best.select(F.col("s_best").alias("best_threshold"), "best_f1", "precision_at_best", "recall_at_best")


def boundaries(counts: DataFrame, ks: Sequence[int], cum: str, fields: Sequence[str]) -> list:
    """For each position k, the first row of a cumulative table with ``cum`` >= k (None past its end): one aggregate
    for all positions, ``len(ks)`` rows to the driver."""
    if not ks:
        return []
    row = F.struct(cum, *fields)
    got = counts.agg(*[F.min(F.when(F.col(cum) >= int(k), row)).alias(f"b{i}") for i, k in enumerate(ks)]).first()
    return list(got)


def lift_at_k(scored: DataFrame, top_pcts: Sequence[float] = (1, 3, 8), y: str = "y", p: str = "p",
              id_col: str = "id", n_buckets: int | None = None) -> DataFrame:
    """Precision / recall / lift of the top ``k = max(1, int(n*pct/100))`` rows.

    Order: score descending (rows without a score last), then ``id_col`` ascending. One pass
    over the collapsed scores finds the boundaries of all k; the tie groups that straddle
    them are resolved together by one prefix sum over ids, never gathered in one task.
    """
    spark = scored.sparkSession
    s = scored.select(nan_to_null(F.col(p)).alias("s"), F.col(y).cast("int").alias("y"), F.col(id_col).alias("id"))
    desc = (s.groupBy("s").agg(F.count(F.lit(1)).alias("cnt"), F.sum("y").cast("bigint").alias("pos")))
    desc = prefix_sums(desc, ["s"], ["cnt", "pos"], n_buckets=n_buckets, descending=True)
    tot = desc.agg(F.first("cnt_total").alias("n"), F.first("pos_total").alias("P")).first()
    n, P = int(tot["n"] or 0), int(tot["P"] or 0)
    base = P / n if n else 0.0
    ks = [max(1, int(n * pct / 100)) for pct in top_pcts]
    at = boundaries(desc, ks, "cnt_cum", ["s", "cnt", "pos", "pos_cum"]) if n else []
    split = [(i, b, k - (b["cnt_cum"] - b["cnt"])) for i, (b, k) in enumerate(zip(at, ks)) if k < b["cnt_cum"]]
    in_tie = {}
    if split:
        cond = None
        for _, b, _ in split:
            c = F.col("s").eqNullSafe(F.lit(b["s"]).cast("double"))
            cond = c if cond is None else cond | c
        tie = s.filter(cond).select("s", "id", F.lit(1).alias("c"), F.col("y").alias("yy"))
        ranked = prefix_sums(tie, ["id"], ["c", "yy"], ["s"], n_buckets=n_buckets)
        got = ranked.agg(*[F.max(F.when(F.col("s").eqNullSafe(F.lit(b["s"]).cast("double")) & (F.col("c_cum") == r), F.col("yy_cum")))
                           .alias(f"t{i}") for i, b, r in split]).first()
        in_tie = {i: int(got[f"t{i}"] or 0) for i, _, _ in split}
    rows = []
    for i, (pct, k) in enumerate(zip(top_pcts, ks) if n else ()):
        b = at[i]
        pos_k = b["pos_cum"] - b["pos"] + in_tie.get(i, b["pos"]) if b is not None else P
        prec = pos_k / k
        rows.append((float(pct), k, float(prec), float(pos_k / max(P, 1)), float(prec / max(base, 1e-12))))
    return spark.createDataFrame(rows, "top_pct double, k long, precision double, recall double, lift double")


def brier(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """E5, over rows with a score."""
    return scored.agg(F.avg(F.pow(nan_to_null(F.col(p)) - F.col(y), 2)).alias("brier"))


def log_loss(scored: DataFrame, y: str = "y", p: str = "p", eps: float = LOGLOSS_EPS) -> DataFrame:
    """Mean binary cross-entropy with probabilities clipped to [eps, 1-eps]."""
    s = nan_to_null(F.col(p))
    q = F.when(s.isNotNull(), F.least(F.greatest(s, F.lit(eps)), F.lit(1 - eps)))
    yy = F.col(y).cast("double")
    return scored.agg(F.avg(-(yy * F.log(q) + (1 - yy) * F.log(1 - q))).alias("log_loss"))


def reliability_curve(scored: DataFrame, n_bins: int = 10, y: str = "y", p: str = "p") -> DataFrame:
    """Quantile-binned calibration curve; empty bins are absent.

    Edges are exact linear quantiles of p; bin = number of inner edges < p.
    """
    qs = [i / n_bins for i in range(1, n_bins)]
    d = scored.withColumn("_p", nan_to_null(F.col(p).cast("double"))).filter(F.col("_p").isNotNull())
    edges = [r["value"] for r in exact_quantiles(d.select("_p"), "_p", qs, "linear").orderBy("q").collect()]   # n_bins - 1 values
    d = assign_bin(d, F.col("_p"), [F.lit(e) for e in edges if e is not None], "bin")
    return (d.groupBy("bin").agg(F.avg(F.col(y).cast("double")).alias("prob_true"),
                                 F.avg("_p").alias("prob_pred"),
                                 F.count(F.lit(1)).alias("count")))


def group_metrics(scored: DataFrame, groups: Sequence[str], y: str = "y", p: str = "p", top_pcts: Sequence[float] = (),
                  id_col: str = "id") -> DataFrame:
    """E1, E3, E4 and E5 of every group in one plan: long table (``groups``, ``metric``, ``value``) with rows, base rate, AUC, AP,
    Brier, the best-F1 threshold and its F1, and precision, recall and lift of each top share of the rows (score
    descending, then id; rows without a score last)."""
    groups = list(groups)
    every = scored.select(*groups, F.col(id_col).alias("_id"), F.col(y).cast("int").alias("_y"), nan_to_null(F.col(p).cast("double")).alias("_p"))
    base = every.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_pos"), F.avg(F.pow(F.col("_p") - F.col("_y"), 2)).alias("brier"))
    st = _curve(score_table(every, "_y", "_p", groups=groups))
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-12))
    # at or above the lowest positive score: all scores below it have full recall, too, and no larger F1
    candidate = F.when(F.col("pos_cum") > 0, F.struct(f1.alias("f"), (-F.col("s")).alias("t")))
    curve = st.groupBy(*groups).agg(
        (F.sum(F.col("pos") * (F.col("neg_cum") - F.col("neg") + F.col("neg") / 2.0)) / (F.first("pos_total") * F.first("neg_total"))).alias("auc_roc"),
        F.sum(F.when(F.col("pos") > 0, F.col("pos") / F.col("pos_total") * F.col("precision"))).alias("avg_precision"), F.max(candidate).alias("_best"))
    cells = [("n_rows", F.col("_n").cast("double")), ("base_rate", F.col("_pos") / F.col("_n")), ("auc_roc", F.col("auc_roc")), ("avg_precision", F.col("avg_precision")),
             ("brier", F.col("brier")), ("best_threshold", -F.col("_best.t")), ("best_f1", F.col("_best.f"))]
    long = lambda d, cs: d.select(*groups, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in cs])))
    out = long(base.join(curve, groups, "left"), cells)
    if top_pcts:
        ranked = prefix_sums(every.withColumn("_one", F.lit(1)), ["_p", "_id"], ["_one"], groups, descending=True)
        k = [F.greatest(F.lit(1), F.floor(F.col("_one_total") * float(x) / 100)) for x in top_pcts]
        top = ranked.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_pos"),
                                          *[F.sum(F.when(F.col("_one_cum") <= k[i], F.col("_y"))).alias(f"_hit{i}") for i in range(len(k))])
        cells = []
        for i, x in enumerate(top_pcts):
            size = F.greatest(F.lit(1), F.floor(F.col("_n") * float(x) / 100))
            precision = F.col(f"_hit{i}") / size
            cells += [(f"precision_at_{float(x)}pct", precision), (f"recall_at_{float(x)}pct", F.col(f"_hit{i}") / F.greatest(F.col("_pos"), F.lit(1))),
                      (f"lift_at_{float(x)}pct", precision / F.greatest(F.col("_pos") / F.col("_n"), F.lit(1e-12)))]
        out = out.unionByName(long(top, cells))
    return out


def model_comparison(scored_by_model: Mapping[str, Mapping[str, DataFrame]], y: str = "y", p: str = "p",
                     top_pcts: Sequence[float] = (), id_col: str = "id") -> DataFrame:
    """Long table ``(model, split, metric, value)`` for every model x split, all cells in one plan (see
    :func:`group_metrics`). ``id_col`` breaks ties of ``top_pcts``."""
    every = None
    for model, by_split in scored_by_model.items():
        for split, sdf in by_split.items():
            rows = sdf.select(F.lit(model).alias("model"), F.lit(split).alias("split"), (F.col(id_col) if id_col in sdf.columns else F.lit(0)).alias("id"),
                              F.col(y).cast("int").alias("y"), F.col(p).cast("double").alias("p"))
            every = rows if every is None else every.unionByName(rows)
    return group_metrics(every, ["model", "split"], "y", "p", top_pcts, "id")


def linear_attributions(explain: DataFrame, background: DataFrame, coefs: Mapping[str, float]) -> DataFrame:
    """Mean |phi_j| with ``phi_j = beta_j (x_j - E_bg[x_j])`` (linear SHAP), sorted desc."""
    cols = list(coefs)
    mu = background.agg(*[F.avg(F.col(c)).alias(f"_mu{i}") for i, c in enumerate(cols)])
    d = explain.crossJoin(F.broadcast(mu))
    agg = d.agg(*[F.avg(F.abs(F.lit(float(coefs[c])) * (F.col(c) - F.col(f"_mu{i}")))).alias(f"_a{i}")
                  for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _a{i}" for i, c in enumerate(cols))
    return agg.select(F.expr(f"stack({len(cols)}, {pairs}) as (feature, mean_abs_attribution)")) \
        .orderBy(F.desc("mean_abs_attribution"), "feature")
