"""Evaluation over one tall predictions table.

``preds(model, key, label, score, pred)``: every metric is a grouped
aggregate over ``by`` (model, split, fold, replicate...), so comparing many
models or replicates is one job, not a loop.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.functions.hashing import POISSON1_CDF, md5_words
from sparkwright.operators.ranking import assign_buckets, descending_cumulative, histogram
from sparkwright.session import stored


def _d(c):
    return F.col(c).cast("double")


# ---------------------------------------------------------------- V1 / V2
def regression_metrics(df: DataFrame, label: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """mse = mean((y-p)^2); r2 = 1 - SSE / (n * var_pop(y))."""
    by = by or []
    err = (_d(label) - _d(pred))
    return df.groupBy(*by).agg(
        F.avg(err * err).alias("mse"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.count(label) * F.var_pop(_d(label)))).alias("r2"))


# ---------------------------------------------------------------- V3 / V4 / V7 / V9
def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None,
                     classes: tuple = (0, 1)) -> DataFrame:
    """Dense (label, pred, n) per group over ``classes``, zero cells kept via the (group x class x class) grid;
    a label or prediction outside ``classes`` keeps its own non-zero cells."""
    by = by or []
    counts = df.groupBy(*by, label, pred).agg(F.count(F.lit(1)).alias("n"))
    one = lambda name: F.explode(F.array(*[F.lit(c) for c in classes])).alias(name)
    # each group appears once per cell, which adds nothing to its count
    groups = counts.select(*by).distinct() if by else df.sparkSession.range(1)
    grid = groups.select(*by, one(label)).select(*by, label, one(pred)).withColumn("n", F.lit(0).cast("long"))
    return counts.select(*by, label, pred, "n").unionByName(grid).groupBy(*by, label, pred).agg(F.sum("n").alias("n"))


def _counts(df, label, pred, by):
    y, p = F.col(label), F.col(pred)
    return df.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def _prf(tp, fp, fn):
    precision = F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp.cast("double"), (tp + fn).cast("double")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp.cast("double"), (2 * tp + fp + fn).cast("double")), F.lit(0.0))
    return precision, recall, f1


def precision_recall_f1(df: DataFrame, label: str = "label", pred: str = "pred",
                        by: list[str] | None = None) -> DataFrame:
    """Positive-class precision, recall, F1; 0 where undefined (zero_division=0) (V7)."""
    by = by or []
    c = _counts(df, label, pred, by)
    p, r, f = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(*by, p.alias("precision"), r.alias("recall"), f.alias("f1"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "pred",
                          by: list[str] | None = None) -> DataFrame:
    """Per class precision/recall/F1/support, accuracy, macro and weighted averages, tall (V4)."""
    by = by or []
    c = _counts(df, label, pred, by)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1, f1 = _prf(tp, fp, fn)
    p0, r0, f0 = _prf(tn, fn, fp)
    s1, s0 = (tp + fn), (tn + fp)
    n = (s0 + s1).cast("double")
    acc = F.try_divide((tp + tn).cast("double"), n)
    rows = F.array(
        F.struct(F.lit("0").alias("cls"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("cls"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("cls"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"),
                 (s0 + s1).alias("support")),
        F.struct(F.lit("macro avg").alias("cls"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1"), (s0 + s1).alias("support")),
        F.struct(F.lit("weighted avg").alias("cls"), ((p0 * s0 + p1 * s1) / n).alias("precision"),
                 ((r0 * s0 + r1 * s1) / n).alias("recall"), ((f0 * s0 + f1 * s1) / n).alias("f1"),
                 (s0 + s1).alias("support")))
    return c.select(*by, F.inline(rows))


def accuracy(df: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None) -> DataFrame:
    by = by or []
    return df.groupBy(*by).agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def accuracy_gap(df: DataFrame, split: str, label: str = "label", pred: str = "pred",
                 by: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """Train accuracy, test accuracy and their gap per group (V9); ``split`` is a boolean is-test flag, ``weight`` a row's count."""
    by = by or []
    right, w = F.col(label) == F.col(pred), F.lit(1) if weight is None else F.col(weight)
    share = lambda side: F.try_divide(F.sum(F.when(side & right, w).when(side & ~right, 0)).cast("double"),
                                      F.sum(F.when(side & right.isNotNull(), w)))
    return df.groupBy(*by).agg(share(~F.col(split)).alias("train_acc"), share(F.col(split)).alias("test_acc")) \
        .withColumn("gap", F.col("train_acc") - F.col("test_acc"))


# ---------------------------------------------------------------- V5 / V6 / R5
def roc_auc(df: DataFrame, score: str = "score", label: str = "label", by: list[str] | None = None,
            weight: str | None = None, buckets: int | None = None, few_groups: bool = True) -> DataFrame:
    """Exact ROC AUC by rank sum, ties count half: (sum rank+ - n1(n1+1)/2) / (n1 n0).

    Works on the (group, score) histogram with positives summed per score, so the
    cost is the number of distinct scores, not rows. The rank sum never needs the
    per-score ranks joined back: with scores cut into ordered buckets,
    sum(pos * rank) = sum over buckets of (rows in earlier buckets * positives in the
    bucket + the within-bucket part), so after the in-bucket window everything is
    aggregated to (group, bucket) rows. One class only -> NULL. ``few_groups``: the groups are
    parameter-sized (models, folds, splits); say False for groups that grow with the data.
    """
    by = list(by or [])
    w = F.col(weight) if weight else F.lit(1)
    h = histogram(df, score, by, weight, extra_sums={"pos": (w * F.col(label)).cast("double")})
    hb = assign_buckets(h, score, by, buckets, few_groups=few_groups)
    within = Window.partitionBy(*by, "__bucket").orderBy(score).rowsBetween(Window.unboundedPreceding, 0)
    hb = hb.withColumn("__run", F.sum("cnt").over(within))
    # rank within the bucket (ties averaged) times positives at that score
    part = F.col("pos") * (F.col("__run") - (F.col("cnt") - F.lit(1.0)) / F.lit(2.0))
    per_bucket = hb.groupBy(*by, "__bucket").agg(F.sum(part).alias("__S"), F.sum("pos").alias("__P"),
                                                 F.sum("cnt").alias("__N"))
    # groups x buckets rows; this window covers at most the bucket count per group
    before = Window.partitionBy(*([F.col(c) for c in by] or [F.lit(0)])).orderBy("__bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.withColumn("__off", F.coalesce(F.sum("__N").over(before), F.lit(0.0)))
    a = per_bucket.groupBy(*by).agg(F.sum("__P").alias("n1"), F.sum("__N").alias("n"),
                                    F.sum(F.col("__off") * F.col("__P") + F.col("__S")).alias("srank"))
    n1, n0 = F.col("n1"), F.col("n") - F.col("n1")
    auc = F.when((n1 > 0) & (n0 > 0), (F.col("srank") - n1 * (n1 + F.lit(1.0)) / F.lit(2.0)) / (n1 * n0))
    return a.select(*by, auc.alias("auc"))


def roc_curve(df: DataFrame, score: str = "score", label: str = "label", by: list[str] | None = None,
              drop_intermediate: bool = False, few_groups: bool = True) -> DataFrame:
    """ROC points (threshold, fpr, tpr) per group at every distinct score, descending, plus the
    (inf, 0, 0) origin (V6). ``drop_intermediate`` keeps only corners, as sklearn does."""
    by = by or []
    cum = descending_cumulative(df, score, label, by, few_groups=few_groups)
    if drop_intermediate:
        cum = _corners(cum, score, by, few_groups)
    tot = df.groupBy(*by).agg(F.sum(F.col(label).cast("double")).alias("__P"),
                              F.sum((1 - F.col(label)).cast("double")).alias("__N"))
    pts = cum.join(tot, by) if by else cum.crossJoin(F.broadcast(tot))
    pts = pts.select(*by, F.col(score).cast("double").alias("threshold"),
                     F.try_divide(F.col("fp"), F.col("__N")).alias("fpr"),
                     F.try_divide(F.col("tp"), F.col("__P")).alias("tpr"))
    origin = tot.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(pts)


def _corners(cum: DataFrame, score: str, by: list[str], few_groups: bool = True) -> DataFrame:
    """Keep a point when the second difference of fp or tp (in descending score order) is
    non-zero; the first and last points are always kept (sklearn's drop_intermediate).

    Neighbours: lag/lead inside the point's score bucket, and at bucket edges the last
    point of the previous bucket / first point of the next one (a groups x buckets table),
    so no window spans a whole group.
    """
    pts = cum.select(*by, F.negative(F.col(score)).alias("__o"), score, "tp", "fp", "n_at_score", "pos_at_score")
    hb = assign_buckets(pts, "__o", by, few_groups=few_groups)
    w = Window.partitionBy(*by, "__bucket").orderBy("__o")
    hb = hb.withColumns({"__ptp": F.lag("tp").over(w), "__pfp": F.lag("fp").over(w),
                         "__ntp": F.lead("tp").over(w), "__nfp": F.lead("fp").over(w)})
    edges = hb.groupBy(*by, "__bucket").agg(
        F.min_by(F.struct("tp", "fp"), "__o").alias("__first"), F.max_by(F.struct("tp", "fp"), "__o").alias("__last"))
    wb = Window.partitionBy(*([F.col(c) for c in by] or [F.lit(0)])).orderBy("__bucket")
    edges = edges.select(*by, "__bucket", F.lag("__last").over(wb).alias("__prev_last"),
                         F.lead("__first").over(wb).alias("__next_first"))
    j = hb.join(F.broadcast(edges) if not by else edges, [*by, "__bucket"])
    ptp = F.coalesce(F.col("__ptp"), F.col("__prev_last.tp"))
    pfp = F.coalesce(F.col("__pfp"), F.col("__prev_last.fp"))
    ntp = F.coalesce(F.col("__ntp"), F.col("__next_first.tp"))
    nfp = F.coalesce(F.col("__nfp"), F.col("__next_first.fp"))
    interior = ptp.isNotNull() & ntp.isNotNull()
    bend = ((ntp - 2 * F.col("tp") + ptp) != 0) | ((nfp - 2 * F.col("fp") + pfp) != 0)
    return j.where(~interior | bend).select(*by, score, "n_at_score", "pos_at_score", "tp", "fp")


# ---------------------------------------------------------------- V8 / R4
def threshold_sweep(df: DataFrame, thresholds: list[float], score: str = "score", label: str = "label",
                    by: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Precision/recall/F1 at each threshold (``score >= t``), rounded; ONE pass with conditional sums."""
    by = by or []
    y, s = F.col(label), F.col(score)
    aggs = []
    for i, t in enumerate(thresholds):
        aggs += [F.count_if((s >= t) & (y == 1)).alias(f"tp{i}"), F.count_if((s >= t) & (y == 0)).alias(f"fp{i}"),
                 F.count_if((s < t) & (y == 1)).alias(f"fn{i}")]
    one = df.groupBy(*by).agg(*aggs)
    rows = []
    for i, t in enumerate(thresholds):
        p, r, f = _prf(F.col(f"tp{i}"), F.col(f"fp{i}"), F.col(f"fn{i}"))
        rows.append(F.struct(F.lit(float(t)).alias("threshold"), F.round(p, digits).alias("precision"),
                             F.round(r, digits).alias("recall"), F.round(f, digits).alias("f1")))
    return one.select(*by, F.inline(F.array(*rows)))


def best_threshold(sweep: DataFrame, by: list[str] | None = None, metric: str = "f1") -> DataFrame:
    """Threshold with the highest (rounded) metric; the first (smallest) threshold wins ties."""
    by = by or []
    return sweep.groupBy(*by).agg(
        F.min_by("threshold", F.struct(F.negative(F.col(metric)), F.col("threshold"))).alias("threshold"),
        F.max(metric).alias(metric))


# ---------------------------------------------------------------- V10 - V12
# A draw is a 32-bit word; its weight is the number of these steps at or below it.
_STEPS = [np.uint32(c) for c in (math.ceil(p * 2 ** 32) for p in POISSON1_CDF) if c < 2 ** 32]


def _weights(keys: list[str], replicates: int, seed: int) -> np.ndarray:
    """Poisson(1) weights (keys x replicates): replicate r draws word (r - 1) % 4 of md5(key|(r - 1) // 4|seed)."""
    blocks = -(-replicates // 4)
    words = md5_words([k.encode() for k in keys], [f"|{b}|{seed}".encode() for b in range(blocks)])
    return _poisson1(words).transpose(2, 1, 0).reshape(len(keys), 4 * blocks)[:, :replicates]


def _own_weights(keys: list[str], replicates: int, seed: int) -> np.ndarray:
    """Poisson(1) weights (keys x replicates), each with a hash of its own: the first word of md5(key|replicate|seed)."""
    tails = [f"|{r}|{seed}".encode() for r in range(1, replicates + 1)]
    md5 = hashlib.md5
    drawn = b"".join([md5(k + t).digest() for k in map(str.encode, keys) for t in tails])
    return _poisson1(np.frombuffer(drawn, ">u4")[::4].astype(np.uint32).reshape(len(keys), replicates))


def _poisson1(words: np.ndarray) -> np.ndarray:
    out = np.zeros(words.shape, np.uint8)
    for step in _STEPS:
        out += words >= step
    return out


def bootstrap_draws(df: DataFrame, key: str, replicates: int, seed: int = 42) -> DataFrame:
    """Per replicate, the rows drawn at least once and the total weight (P9); every (row, replicate) is hashed by itself.

    A row drawn k times in a resample has weight k instead of being copied k times; the weights of a row are a
    vector over the replicates, summed in the task that draws it, so rows are never multiplied by replicates."""
    def run(batches):
        drawn, total = np.zeros(replicates, np.int64), np.zeros(replicates, np.int64)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for i in range(0, len(keys), _AT_ONCE):
                w = _own_weights(keys[i:i + _AT_ONCE], replicates, seed)
                drawn += (w > 0).sum(axis=0)
                total += w.sum(axis=0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, replicates + 1, dtype=np.int32)), pa.array(drawn), pa.array(total)],
                                         names=["replicate", "drawn_rows", "total_weight"])

    # the draws cost far more than the rows: deal the keys out, as a scan may be one task
    keys = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k")).repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = keys.mapInArrow(run, "replicate int, drawn_rows long, total_weight long")
    return parts.groupBy("replicate").agg(F.sum("drawn_rows").alias("drawn_rows"), F.sum("total_weight").alias("total_weight"))


_AT_ONCE = 1024          # rows whose weights are held together


def _segment_sums(replicates: int, seed: int):
    """(which, seg, s, p, n): per segment and replicate the rank sum of positives, the positives and the rows.

    Rows come sorted by segment and score and carry their key; their weights are drawn here. Ties share the average rank;
    the last score of a run of rows stays open, as the next run may go on with it."""
    def run(batches):
        state = None

        def close(tot, pos):
            """Add groups of equal scores, in rising order, to the running sums."""
            before = state["n"] + np.cumsum(tot, axis=0) - tot
            state["s"] += (pos * (before + (tot + 1.0) / 2.0)).sum(axis=0)
            state["n"] += tot.sum(axis=0)
            state["p"] += pos.sum(axis=0)

        def result():
            close(state["tot"][None], state["pos"][None])
            return pa.RecordBatch.from_arrays(
                [pa.array([state["key"][0]], pa.int32()), pa.array([state["key"][1]], pa.int64()),
                 *[pa.array([state[c]], pa.list_(pa.float64())) for c in ("s", "p", "n")]], names=["which", "seg", "s", "p", "n"])

        for batch in batches:
            which, seg, score, label = (batch.column(c).to_numpy() for c in ("which", "seg", "score", "label"))
            keys = batch.column("key").to_pylist()
            for i in range(0, len(keys), _AT_ONCE):
                part = slice(i, i + _AT_ONCE)
                w = _weights(keys[part], replicates, seed).astype(np.float64)
                wh, sg, sc = which[part], seg[part], score[part]
                new_seg = np.r_[True, (wh[1:] != wh[:-1]) | (sg[1:] != sg[:-1])]
                cuts = np.flatnonzero(new_seg | np.r_[True, sc[1:] != sc[:-1]])
                tot, pos = np.add.reduceat(w, cuts, axis=0), np.add.reduceat(w * label[part][:, None], cuts, axis=0)
                firsts = np.flatnonzero(new_seg[cuts])
                for lo, hi in zip(firsts, np.r_[firsts[1:], len(cuts)]):
                    at, key = cuts[lo], (int(wh[cuts[lo]]), int(sg[cuts[lo]]))
                    if state is not None and state["key"] == key and state["score"] == sc[at]:
                        tot[lo] += state["tot"]
                        pos[lo] += state["pos"]
                    elif state is not None and state["key"] == key:
                        close(state["tot"][None], state["pos"][None])
                    else:
                        if state is not None:
                            yield result()
                        state = {"key": key, **{c: np.zeros(replicates) for c in ("s", "p", "n")}}
                    close(tot[lo:hi - 1], pos[lo:hi - 1])
                    state.update(score=sc[cuts[hi - 1]], tot=tot[hi - 1].copy(), pos=pos[hi - 1].copy())
        if state is not None:
            yield result()
    return run


_HOT_SCORE, _LANES = 32, 64        # a score on more than 1/32 of a model's rows is dealt to 64 lanes


def bootstrap_auc_difference(df: DataFrame, model_a: str, model_b: str, replicates: int = 500, seed: int = 42,
                             key: str = "row_key", model: str = "model", score: str = "score",
                             label: str = "label", buckets: int | None = None) -> DataFrame:
    """Paired Poisson bootstrap of AUC(model_a) - AUC(model_b): one row per replicate.

    Each row has a Poisson(1) weight per replicate, drawn from md5 of its key, the replicate and the seed and so the same for
    both models (a paired resample); of rows that repeat a key, the n-th (n > 1) draws with the key ``key#n``. What is
    shuffled is one narrow row per score (model, score segment, score, key, label): a segment's task draws the weights
    itself and keeps running sums over the replicates, so neither rows nor weights are multiplied by replicates on the way.
    A score that many rows share is a segment of its own in several lanes, whose sums are added. Replicates whose
    resample has a single class are skipped.
    """
    base = df.where(F.col(model).isin(model_a, model_b)).select(
        F.col(model).alias("m"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"),
        F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("x"))
    nth = F.row_number().over(Window.partitionBy("m", "k").orderBy("y", "x"))
    rows = stored(base.withColumn("i", nth).where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(
        (F.col("m") == model_b).cast("int").alias("which"), F.col("x").alias("score"), F.col("y").cast("double").alias("label"),
        F.when(F.col("i") == 1, F.col("k")).otherwise(F.concat_ws("#", "k", "i")).alias("key")), "bootstrap_rows")
    counts = rows.groupBy("which", "score").agg(F.count(F.lit(1)).alias("c"))
    totals = counts.groupBy("which").agg(F.sum("c").alias("t"))                       # two rows
    hot = counts.join(F.broadcast(totals), "which").where(F.col("c") * _HOT_SCORE > F.col("t")) \
        .groupBy("which").agg(F.collect_list("score").alias("hot"))                    # fewer than 32 scores a model
    placed = assign_buckets(rows, "score", ["which"], buckets, few_groups=True).join(F.broadcast(hot), "which", "left")
    is_hot = F.coalesce(F.array_contains("hot", F.col("score")), F.lit(False))
    below = F.coalesce(F.size(F.filter("hot", lambda h: h < F.col("score"))), F.lit(0))
    # segments rise with the score: bucket, then the hot scores inside it and what lies between them
    seg = F.col("__bucket").cast("long") * (4 * _HOT_SCORE) + F.when(F.col("hot").isNull(), 0).otherwise(2 * below + is_hot.cast("int"))
    lane = F.when(is_hot, F.pmod(F.xxhash64("key"), F.lit(_LANES))).otherwise(F.lit(0))
    # the draws cost far more than the rows: a fixed number of tasks, as small ones would be joined to a few long ones
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = placed.select("which", seg.alias("seg"), lane.alias("lane"), "score", "label", "key") \
        .repartition(parts, "which", "seg", "lane").sortWithinPartitions("which", "seg", "score") \
        .select("which", "seg", "score", "label", "key") \
        .mapInArrow(_segment_sums(replicates, seed), "which int, seg long, s array<double>, p array<double>, n array<double>")
    # 2 x segments x replicates rows; the lanes of a hot score are added, its rows share one rank
    each = sums.select("which", "seg", F.posexplode(F.arrays_zip("s", "p", "n")).alias("r", "v")).groupBy("which", "seg", "r").agg(
        F.sum("v.s").alias("s"), F.sum("v.p").alias("p"), F.sum("v.n").alias("n")) \
        .withColumn("s", F.when(F.col("seg") % 2 == 1, F.col("p") * (F.col("n") + 1.0) / 2.0).otherwise(F.col("s"))) \
        .withColumnRenamed("seg", "bucket")
    before = Window.partitionBy("which", "r").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    total = each.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0.0))).groupBy("which", "r").agg(
        F.sum("p").alias("n1"), F.sum("n").alias("n"), F.sum(F.col("s") + F.col("off") * F.col("p")).alias("srank"))
    n1, n0 = F.col("n1"), F.col("n") - F.col("n1")
    auc = F.when((n1 > 0) & (n0 > 0), (F.col("srank") - n1 * (n1 + F.lit(1.0)) / F.lit(2.0)) / (n1 * n0))
    pivot = total.withColumn("auc", auc).groupBy((F.col("r") + 1).cast("int").alias("replicate")).agg(
        F.max(F.when(F.col("which") == 0, F.col("auc"))).alias("auc_a"), F.max(F.when(F.col("which") == 1, F.col("auc"))).alias("auc_b"))
    return (pivot.where(F.col("auc_a").isNotNull() & F.col("auc_b").isNotNull())
            .select("replicate", "auc_a", "auc_b", (F.col("auc_a") - F.col("auc_b")).alias("diff")))


def confidence_interval(samples: DataFrame, column: str = "diff", lo: float = 0.025, hi: float = 0.975) -> DataFrame:
    """mean, ci_low, ci_high (linear-interpolated percentiles) and whether the interval excludes zero."""
    s = samples.agg(F.avg(column).alias("mean"),
                    F.percentile(F.col(column), F.array(F.lit(lo), F.lit(hi))).alias("__q"),
                    F.count(column).alias("replicates"))
    return s.select("mean", F.col("__q")[0].alias("ci_low"), F.col("__q")[1].alias("ci_high"), "replicates",
                    (~((F.col("__q")[0] <= 0) & (F.col("__q")[1] >= 0))).alias("excludes_zero"))


# ---------------------------------------------------------------- V13
def model_comparison(df: DataFrame, model: str = "model", label: str = "label", pred: str = "pred",
                     score: str = "score", digits: int = 4) -> DataFrame:
    """One row per model: precision, recall, F1, accuracy and AUC, rounded for the report.

    One histogram of (model, score, label, pred) feeds both the counts and the AUC, so the model scores each row once."""
    h = df.groupBy(model, F.col(score).alias("__score"), F.col(label).alias("__y"), F.col(pred).alias("__p")) \
        .agg(F.count(F.lit(1)).alias("__w"))
    y, p, w = F.col("__y"), F.col("__p"), F.col("__w")
    n = lambda cond: F.sum(F.when(cond, w).otherwise(0))
    c = h.groupBy(model).agg(n((y == 1) & (p == 1)).alias("tp"), n((y == 0) & (p == 1)).alias("fp"), n((y == 1) & (p == 0)).alias("fn"),
                             n(y == p).alias("__ok"), n(y.isNotNull() & p.isNotNull()).alias("__all"))
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    scores = c.select(model, precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
                      F.try_divide(F.col("__ok").cast("double"), F.col("__all")).alias("accuracy"))
    auc = roc_auc(h, "__score", "__y", [model], weight="__w")
    return scores.join(auc, model).select(model, *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1", "accuracy", "auc")])
