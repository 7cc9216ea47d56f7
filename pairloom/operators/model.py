"""Classifiers of pairs: folds by entity, out-of-fold scores, pruning of candidates, importance. Trees are Spark MLlib's."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.features import BLOCK
from pairloom.operators.metrics import prune_threshold
from pairloom.session import Workspace


def group_folds(entity: str, n_folds: int, seed: int) -> Column:
    """The fold of a whole entity, from 0."""
    return F.pmod(F.xxhash64(F.col(entity), F.lit(seed)), F.lit(n_folds)).cast("int")


def capped(df: DataFrame, most: int | None, seed: int, key: tuple[str, ...] = ("s1_id", "t_id")) -> DataFrame:
    """About `most` rows of df, chosen by a hash of their key, for training; all of them where there are no more."""
    if most is None:
        return df
    n = df.count()
    if n <= most:
        return df
    return df.where(F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1_000_000)) < int(1_000_000 * most / n))


def _fit(train: DataFrame, features: list[str], rounds: int, depth: int, step: float, seed: int, check: str | None = None) -> PipelineModel:
    gbt = GBTClassifier(featuresCol="__x", labelCol="__y", maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed, subsamplingRate=0.8, cacheNodeIds=True, maxMemoryInMB=512)
    if check:
        gbt = gbt.setValidationIndicatorCol(check)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="__x", handleInvalid="keep"), gbt]).fit(train)


def predict(model: PipelineModel, df: DataFrame, p: str = "p") -> DataFrame:
    """df with the probability of a match."""
    out = model.transform(df)
    return out.select(*df.columns, vector_to_array("probability")[1].alias(p))


def rounds_used(model: PipelineModel) -> int:
    return model.stages[-1].getNumTrees


def importance(model: PipelineModel) -> list[tuple[str, float, int]]:
    """(feature, share of the gain, number of splits), highest gain first."""
    names, gbt = model.stages[0].getInputCols(), model.stages[-1]
    splits = dict.fromkeys(range(len(names)), 0)
    for tree in gbt.trees:
        for line in tree.toDebugString.splitlines():
            if line.lstrip().startswith("If (feature "):
                splits[int(line.split("feature ", 1)[1].split(" ", 1)[0])] += 1
    gain = gbt.featureImportances.toArray()
    return sorted(((n, float(gain[i]), splits[i]) for i, n in enumerate(names)), key=lambda x: (-x[1], x[0]))


def train_oof(pairs: DataFrame, features: list[str], n_folds: int = 4, rounds: int = 20, depth: int = 5, step: float = 0.2, seed: int = 42, most_rows: int | None = 3_000_000, p: str = "oof") -> tuple[DataFrame, PipelineModel, dict]:
    """(pairs with out-of-fold probability, model of all rows, figures).

    pairs: s1_id, t_id, hit and the features. Each fold holds whole entities and is scored by a model of the others,
    which stops early on a tenth of their entities; the final model takes 1.1 times the mean number of rounds. Training
    takes at most about most_rows rows; every row is scored. A fold without rows on either side scores 0.
    """
    ws = Workspace(pairs.sparkSession, "oof")
    base = pairs.withColumns({"__y": F.col("hit").cast("double"), "__fold": group_folds("s1_id", n_folds, seed), "__check": group_folds("s1_id", 10, seed + 1) == 0})
    base = ws.write(base, "pairs")
    out, used = None, []
    for k in range(n_folds):
        train = capped(base.where(F.col("__fold") != k), most_rows, seed + k)
        held = base.where(F.col("__fold") == k)
        if train.where("__y = 1").isEmpty() or train.where("__y = 0").isEmpty():
            scored = held.withColumn(p, F.lit(0.0))
        else:
            both = not train.where("__check").isEmpty() and not train.where("not __check").isEmpty()
            model = _fit(train, features, rounds, depth, step, seed + k, "__check" if both else None)
            used.append(rounds_used(model))
            scored = predict(model, held, p)
        scored = scored.select(*pairs.columns, p)
        out = scored if out is None else out.unionByName(scored)
    final = max(2, math.ceil(1.1 * sum(used) / len(used))) if used else rounds
    whole = _fit(capped(base, most_rows, seed + 99), features, final, depth, step, seed + 99)
    return ws.write(out, "oof"), whole, {"rounds": used, "final_rounds": final}


def fit_pruner(pairs: DataFrame, n_folds: int = 4, rounds: int = 10, depth: int = 4, tolerance: float = 0.004, most: float = 0.5, seed: int = 42, most_rows: int = 3_000_000) -> tuple[DataFrame, PipelineModel, float, dict]:
    """(pairs with p0, model, threshold, figures): a small model on the blocking features, and the threshold that loses
    at most `tolerance` of the true pairs. p0 stays as a feature of later models."""
    scored, model, _ = train_oof(pairs, BLOCK, n_folds, rounds, depth, 0.3, seed + 500, most_rows, "p0")
    thr = prune_threshold(scored.select(F.col("p0").alias("p"), "hit"), tolerance, most).first()["threshold"]
    n = scored.agg(F.count(F.lit(1)).alias("pairs_before"), F.count_if(F.col("p0") >= thr).alias("pairs_after"), F.count_if("hit").alias("true_before"), F.count_if(F.col("hit") & (F.col("p0") >= thr)).alias("true_after")).first().asDict()
    return scored, model, thr, n | {"threshold": thr}


def apply_pruner(model: PipelineModel, pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs with p0 of at least threshold."""
    return predict(model, pairs, "p0").where(F.col("p0") >= threshold)


def sample_ids(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n ids without replacement, by the order of a seeded hash."""
    return df.select(key).distinct().orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def competition_sample(pairs: DataFrame, n_seeds: int, most: int, seed: int = 42) -> DataFrame:
    """(s1_id): n_seeds entities and, up to `most` in all, those that compete with them for a target."""
    seeds = sample_ids(pairs, "s1_id", n_seeds, seed)
    targets = pairs.join(seeds, "s1_id", "left_semi").select("t_id").distinct()
    rivals = pairs.join(targets, "t_id", "left_semi").select("s1_id").distinct().join(seeds, "s1_id", "left_anti")
    return seeds.unionByName(sample_ids(rivals, "s1_id", max(0, most - n_seeds), seed + 1))
