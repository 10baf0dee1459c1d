"""Regressors, folds, cross-validation and hold-out evaluation.

Ridge is solved from sums of products, which are added up once per fold: the sums of the rows outside a fold are the
total less the fold's, so one pass fits the final model and all fold models.  Boosted trees are
:mod:`cyclewise.operators.boosting`.  Scores of all models of a table come from one pass over it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.config import CYCLE, IMPORTANCE_TOP_N, TARGET, UNIT
from cyclewise.operators import boosting
from cyclewise.operators.boosting import BoostedTrees
from cyclewise.operators.metrics import metric_columns, r2_score, top_k
from cyclewise.operators.ordering import dense_positions, key_group, key_segment_bucket

#: Up to so many features, sums and scores are column expressions; beyond, Arrow batches go through numpy.
EXPRESSION_FEATURES = 16


# ------------------------------------------------------------------ linear scorer (L2, L6)
@dataclass
class LinearModel:
    features: list[str]
    coefficients: list[float]
    intercept: float

    def prediction(self, source: dict[str, str] | None = None) -> Column:
        """The linear score; ``source`` reads some features from other columns."""
        source = source or {}
        expr = F.lit(float(self.intercept))
        for f, w in zip(self.features, self.coefficients):
            expr = expr + F.lit(float(w)) * F.coalesce(F.col(f"`{source.get(f, f)}`").cast("double"), F.lit(0.0))
        return expr

    def transform(self, df: DataFrame, out: str = "predicted", source: dict[str, str] | None = None) -> DataFrame:
        return df.withColumn(out, self.prediction(source))

    def importances(self) -> list[tuple[str, float]]:
        return [(f, abs(float(w))) for f, w in zip(self.features, self.coefficients)]


# ------------------------------------------------------------------ sums of products (L2, L3)
@dataclass
class Gram:
    """Sums over rows of z z' with z = (1, features, label), each less ``centre``; they add and subtract."""

    features: list[str]
    centre: np.ndarray
    sums: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.features, self.centre, self.sums + other.sums)

    def __sub__(self, other: Gram) -> Gram:
        return Gram(self.features, self.centre, self.sums - other.sums)

    def ridge(self, alpha: float) -> LinearModel:
        """The closed form of ``min ||y - Xw - b||² + alpha ||w||²``; the intercept is not penalised."""
        n, d = self.sums[0, 0], len(self.features)
        if n < 0.5:
            return LinearModel(list(self.features), [0.0] * d, 0.0)
        mean = self.sums[0, 1:] / n
        inner = self.sums[1:, 1:] - n * np.outer(mean, mean)
        left = inner[:d, :d] + alpha * np.eye(d)
        w = np.linalg.solve(left, inner[:d, d]) if alpha > 0 else np.linalg.lstsq(left, inner[:d, d], rcond=None)[0]
        whole = self.centre + mean
        return LinearModel(list(self.features), [float(x) for x in w], float(whole[d] - whole[:d] @ w))


def _value(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0))


def gram_sums(df: DataFrame, features: list[str], label: str = TARGET, fold: str | None = None) -> dict[int, Gram]:
    """One :class:`Gram` per value of ``fold`` (key 0 without it), in two passes: the means, then centred products.

    Missing features count as 0.0, rows without a label are left out.  Tasks add up their rows before the shuffle; what
    reaches the driver is one line per fold and feature, whatever the rows.
    """
    names = [*features, label]
    rows = df.filter(F.col(label).isNotNull())
    first = rows.agg(*[F.avg(_value(c)).alias(f"m{i}") for i, c in enumerate(names)]).first()
    centre = np.array([first[i] or 0.0 for i in range(len(names))])
    key = (F.col(fold) if fold else F.lit(0)).cast("int").alias("_g")
    z = [F.lit(1.0), *[_value(c) - F.lit(float(m)) for c, m in zip(names, centre, strict=True)]]
    rows = rows.select(key, *[x.alias(f"z{i}") for i, x in enumerate(z)])
    size = len(z)
    out: dict[int, np.ndarray] = {}
    if len(features) <= EXPRESSION_FEATURES:
        pairs = [(i, j) for i in range(size) for j in range(i, size)]
        for r in rows.groupBy("_g").agg(*[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"s{i}_{j}") for i, j in pairs]).collect():
            sums = out[r["_g"]] = np.zeros((size, size))
            for i, j in pairs:
                sums[i, j] = sums[j, i] = r[f"s{i}_{j}"]
    else:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: dict[int, np.ndarray] = {}
            for pdf in batches:
                x, g = pdf.iloc[:, 1:].to_numpy(float), pdf["_g"].to_numpy()
                for f in np.unique(g):
                    part = x[g == f]
                    held[int(f)] = held.get(int(f), 0) + part.T @ part
            for f, sums in held.items():
                yield pd.DataFrame({"_g": f, "i": range(size), "v": pd.Series(list(sums), dtype=object)})

        lines = rows.mapInPandas(run, "_g int, i int, v array<double>").groupBy("_g", "i")
        for r in lines.agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(size)]).collect():
            out.setdefault(r["_g"], np.zeros((size, size)))[r["i"]] = r[2:]
    return {f: Gram(list(features), centre, s) for f, s in out.items()}


def ridge_fit(df: DataFrame, features: list[str], label: str = TARGET, alpha: float = 1.0) -> LinearModel:
    """Ridge regression from one :class:`Gram`."""
    return ridge_folds(df, features, label, alpha, None)[None]


def ridge_folds(df: DataFrame, features: list[str], label: str = TARGET, alpha: float = 1.0,
                fold: str | None = "fold") -> dict[int | None, LinearModel]:
    """The model of all rows (under ``None``) and with ``fold`` one per fold, fitted on the rows of the others."""
    grams = gram_sums(df, features, label, fold)
    empty = Gram(list(features), np.zeros(len(features) + 1), np.zeros((len(features) + 2,) * 2))
    total = sum(grams.values(), Gram(list(features), next(iter(grams.values()), empty).centre, empty.sums))
    out: dict[int | None, LinearModel] = {None: total.ridge(alpha)}
    if fold:
        out |= {f: (total - g).ridge(alpha) for f, g in grams.items()}
    return out


# ------------------------------------------------------------------ fit and score any model (L1, L6)
def gbt_fit(df: DataFrame, features: list[str], label: str = TARGET, params: dict | None = None) -> BoostedTrees:
    """Boosted trees: trees, depth, rate, row and column sampling, seed."""
    return boosting.fit(df, features, label, params)[None]


def fit_folds(df: DataFrame, features: list[str], config: dict, label: str = TARGET, fold: str | None = None):
    """The model that ``config`` names, fitted on all rows (under ``None``) and, with ``fold``, without each fold."""
    kind = config.get("type", "gbt")
    if kind == "ridge":
        return ridge_folds(df, features, label, float(config.get("ridge", {}).get("alpha", 1.0)), fold)
    if kind == "gbt":
        return boosting.fit(df, features, label, config.get("gbt", {}), fold=fold)
    raise ValueError(f"unsupported model type: {kind!r}")


def predict(model, df: DataFrame, features: list[str], out: str = "predicted",
            source: dict[str, str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Scores ``df`` with a :class:`LinearModel` or :class:`BoostedTrees`.

    ``source`` maps feature names to the columns to read instead (e.g. a
    perturbed copy on the same row).
    """
    return predict_folds({None: model}, df, out, source=source, keep=keep)


def predict_folds(models: dict, df: DataFrame, out: str = "predicted", oof: str | None = None, fold: str = "fold",
                  source: dict[str, str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """``df`` with the final model's score and, with ``oof``, the score of the model that has not seen the row's fold.

    ``keep`` names the columns of ``df`` that stay; the others are not carried through the scoring.
    """
    if keep is not None and not isinstance(models[None], BoostedTrees):
        return predict_folds(models, df, out, oof, fold, source).select(*keep, out, *([oof] if oof else []))
    folds = {f: m for f, m in models.items() if f is not None}
    final = models[None]
    if isinstance(final, BoostedTrees):
        return boosting.score(df, {out: final}, source, folds if oof else None, fold, oof or "oof", keep)
    if len(final.features) <= EXPRESSION_FEATURES or not oof:
        scored = final.transform(df, out, source)
        if not oof:
            return scored
        choice = F.lit(None).cast("double")
        for f, m in folds.items():
            choice = F.when(F.col(fold) == F.lit(f), m.prediction(source)).otherwise(choice)
        return scored.withColumn(oof, choice)
    order = sorted(folds)
    weights = np.array([[m.intercept, *m.coefficients] for m in (final, *[folds[f] for f in order])]).T
    read = [(source or {}).get(f, f) for f in final.features]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[read].to_numpy(float)
            scores = np.where(np.isnan(x), 0.0, x) @ weights[1:] + weights[0]
            at = np.searchsorted(order, pdf[fold].to_numpy())
            yield pdf.assign(**{out: scores[:, 0], oof: scores[np.arange(len(pdf)), 1 + np.minimum(at, len(order) - 1)]})

    schema = df.withColumn(out, F.lit(None).cast("double")).withColumn(oof, F.lit(None).cast("double")).schema
    return df.mapInPandas(run, schema)


def importance_topk(spark, model, features: list[str], k: int = IMPORTANCE_TOP_N):
    """Rows of the ``k`` most important features: mean split gain of trees, absolute coefficients of a linear model."""
    rows = spark.createDataFrame(model.importances(), "feature string, importance double")
    return top_k(rows, "importance", k, "feature")


# ------------------------------------------------------------------ folds (L4, L5)
def kfold_contiguous(df: DataFrame, k: int, unit: str = UNIT, cycle: str = CYCLE) -> DataFrame:
    """Unshuffled k-fold over the key order: first ``n % k`` folds hold one extra row.

    The global row position comes from per-engine counts (small table) plus a
    row number inside each engine, so no task holds the whole table.
    """
    pos = dense_positions(df, keys=[], order=[unit, cycle], bucket=key_segment_bucket(unit, cycle), out="_gpos", coarse=key_group(unit))
    n = df.count()
    q, r = divmod(n, k)
    big = r * (q + 1)
    p0 = F.col("_gpos") - 1
    fold = F.when(F.col("_gpos") <= big, F.floor(p0 / F.lit(q + 1))).otherwise(
        F.lit(r) + F.floor((p0 - F.lit(big)) / F.lit(max(q, 1)))
    )
    return pos.withColumn("fold", fold.cast("int")).drop("_gpos")


def fold_schedule(sizes: list[tuple[int, int]], k: int) -> list[tuple[int, int, int, list[int]]]:
    """Longest-first assignment of groups to ``k`` folds, each to the lightest one (ties: the lowest number).

    ``sizes`` is (rows of a group, how many groups have so many).  Groups of one size go in rounds: a fold joins the
    rounds when the others have caught up with its load, so (rows, first rank, last rank, folds in turn) describes
    them: at most ``k`` lines per size.
    """
    loads = [(0, f) for f in range(k)]
    out = []
    for rows, groups in sorted(sizes, reverse=True):
        heapq.heapify(loads)
        rank, active, given = 0, [], dict.fromkeys(range(k), 0)
        start = dict((f, load) for load, f in loads)
        waiting = sorted((load // rows, load % rows, f) for load, f in loads)
        while rank < groups:
            turn = waiting[0][0] if not active else turn
            while waiting and waiting[0][0] <= turn:
                active.append(waiting.pop(0)[1:])
            active.sort()
            rounds = (waiting[0][0] - turn) if waiting else groups
            take = min(groups - rank, rounds * len(active))
            order = [f for _, f in active]
            out.append((rows, rank + 1, rank + take, order))
            for i, f in enumerate(order):
                given[f] += take // len(order) + (i < take % len(order))
            rank, turn = rank + take, turn + rounds
        loads = [(start[f] + given[f] * rows, f) for f in range(k)]
    return out


def group_kfold(df: DataFrame, k: int, unit: str = UNIT) -> DataFrame:
    """Folds by engine, balanced by rows: the engine with most rows first (ties: smallest id), each to the lightest fold.

    Output ``(unit, n_rows, fold)``, one row per engine.  The driver sees the histogram of engine sizes and the loads;
    an engine's fold follows from its rank among the engines of its size.
    """
    spark = df.sparkSession
    eng = df.groupBy(unit).agg(F.count(F.lit(1)).alias("n_rows"))
    sizes = [(r["n_rows"], r["n"]) for r in eng.groupBy("n_rows").agg(F.count(F.lit(1)).alias("n")).collect()]
    plan = spark.createDataFrame(fold_schedule(sizes, k), "_rows long, _from long, _to long, _order array<int>")
    ranked = dense_positions(eng, keys=["n_rows"], order=[unit], bucket=key_group(unit, 1 << 16), out="_r")
    dealt = ranked.join(plan, (F.col("n_rows") == F.col("_rows")) & F.col("_r").between(F.col("_from"), F.col("_to")))
    turn = F.pmod(F.col("_r") - F.col("_from"), F.size("_order").cast("long")).cast("int")
    return dealt.select(unit, F.col("n_rows").cast("long").alias("n_rows"), F.get("_order", turn).cast("int").alias("fold"))


def with_folds(df: DataFrame, folds: DataFrame, unit: str = UNIT) -> DataFrame:
    return df.join(folds.select(unit, "fold"), unit)


def cv_predictions(df: DataFrame, features: list[str], config: dict, label: str = TARGET) -> DataFrame:
    """``df`` with ``predicted`` by the model that has not seen the row's ``fold``: one fit for all folds, one scoring pass."""
    models = fit_folds(df, features, config, label, fold="fold")
    return predict_folds(models, df, "_final", oof="predicted").drop("_final")


def cv_rmse(oof: DataFrame, label: str = TARGET, pred: str = "predicted") -> DataFrame:
    """Per-fold RMSE, then their mean and population std (one row)."""
    e = F.col(pred) - F.col(label).cast("double")
    per = oof.groupBy("fold").agg(F.sqrt(F.avg(e * e)).alias("rmse"))
    return per.agg(F.avg("rmse").alias("cv_rmse_mean"), F.stddev_pop("rmse").alias("cv_rmse_std"), F.count(F.lit(1)).alias("n_folds"))


# ------------------------------------------------------------------ hold-out evaluation (W6, J1, L8, K5)
def last_rows(df: DataFrame, unit: str = UNIT, cycle: str = CYCLE) -> DataFrame:
    """Latest row of each engine, one each: one aggregate over whole rows."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(unit).agg(F.max_by(row, F.col(cycle)).alias("_last")).select("_last.*")


def last_cycle_eval(features: DataFrame, model, feature_cols: list[str], truth: DataFrame,
                    unit: str = UNIT, truth_col: str = TARGET) -> DataFrame:
    """Score the last cycle of each engine, join its truth, all metrics in one aggregate."""
    scored = predict(model, last_rows(features, unit), feature_cols)
    pairs = scored.select(unit, "predicted").join(
        truth.select(unit, F.col(truth_col).alias("actual")), unit
    )
    return pairs.agg(*metric_columns("actual", "predicted", "test_"))


def prefix_eval(predictions: DataFrame, truth: DataFrame, unit: str = UNIT, cycle: str = CYCLE,
                truth_col: str = TARGET) -> DataFrame:
    """Compatibility protocol: the first N predictions in key order against the N truths in engine order.

    Positions come from :func:`dense_positions` on both sides, so the pairing
    is a keyed join, not a collect.
    """
    n = truth.count()
    p = dense_positions(predictions, keys=[], order=[unit, cycle], bucket=key_segment_bucket(unit, cycle), out="_pos", coarse=key_group(unit)).filter(
        F.col("_pos") <= n
    )
    t = dense_positions(truth, keys=[], order=[unit], bucket=key_group(unit, 64), out="_pos", coarse=key_group(unit, 1 << 16))
    pairs = p.select("_pos", "predicted").join(t.select("_pos", F.col(truth_col).alias("actual")), "_pos")
    return pairs.agg(*metric_columns("actual", "predicted", "test_"))


def actual_vs_predicted(scored: DataFrame, label: str = TARGET, unit: str = UNIT, cycle: str = CYCLE) -> DataFrame:
    """Pairs table with the R² of all pairs attached (a scalar read back from one aggregate)."""
    pairs = scored.select(unit, cycle, F.col(label).cast("double").alias("actual"), F.col("predicted"))
    e = F.col("predicted") - F.col("actual")
    r2 = pairs.agg(r2_score(F.sum(e * e), F.var_pop("actual") * F.count(F.lit(1))).alias("r2")).first()["r2"]
    return pairs.withColumn("r2", F.lit(r2).cast("double"))
