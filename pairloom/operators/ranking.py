"""Ranks, competition and group context over pairs (s1_id, t_id, a score).

Every window is over one key and streams; ties fall to the smaller id, so that results do not depend on the order of
rows. Null scores come last. An empty frame gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, groups: list[str], score: str, tie: str = "t_id", rank: str = "rank") -> DataFrame:
    """df with `rank` from 0 in each group, best score first; ranks are unique."""
    w = Window.partitionBy(*groups).orderBy(F.desc_nulls_last(score), F.asc(tie))
    return df.withColumn(rank, (F.row_number().over(w) - 1).cast("int"))


def top_k(df: DataFrame, groups: list[str], score: str, k: int, tie: str = "t_id", rank: str = "rank") -> DataFrame:
    """The k best rows of each group with their rank from 0; the cut is made before the shuffle, too."""
    return ranked(df, groups, score, tie, rank).where(F.col(rank) < k)


def _other_best(score: str, key: str, tie: str) -> tuple[Column, Column]:
    """(rank from 0, best score of any other row of the key)."""
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(score), F.asc(tie))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(w) - 1
    return rank, F.when(rank == 0, F.nth_value(score, 2).over(whole)).otherwise(F.first(score).over(whole))


def competition(df: DataFrame, score: str, prefix: str, s1: str = "s1_id", t: str = "t_id") -> DataFrame:
    """How other s1 claim the same target: {prefix}_t_n claims, {prefix}_t_rank, {prefix}_t_margin, which is the score
    less the best of any other s1, 1.0 without one."""
    rank, other = _other_best(score, t, s1)
    return df.withColumns({
        f"{prefix}_t_n": F.count(F.lit(1)).over(Window.partitionBy(t)).cast("int"), f"{prefix}_t_rank": rank.cast("int"),
        f"{prefix}_t_margin": F.coalesce(F.col(score) - other, F.lit(1.0)),
    })


def group_context(df: DataFrame, score: str, prefix: str, s1: str = "s1_id", t: str = "t_id") -> DataFrame:
    """Place among the candidates of one s1: {prefix}_g_rank, {prefix}_g_gap to the best, {prefix}_g_n, {prefix}_g_sum."""
    w = Window.partitionBy(s1)
    rank = F.row_number().over(w.orderBy(F.desc_nulls_last(score), F.asc(t))) - 1
    return df.withColumns({
        f"{prefix}_g_rank": rank.cast("int"), f"{prefix}_g_gap": F.col(score) - F.max(score).over(w),
        f"{prefix}_g_n": F.count(F.lit(1)).over(w).cast("int"), f"{prefix}_g_sum": F.sum(score).over(w),
    })


def other_best(df: DataFrame, score: str, s1: str = "s1_id", t: str = "t_id") -> DataFrame:
    """df with other_t and other_p: the best other candidate of the same s1 (the second for the first); null without one."""
    w = Window.partitionBy(s1).orderBy(F.desc_nulls_last(score), F.asc(t))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pick = lambda c: F.when(F.row_number().over(w) == 1, F.nth_value(c, 2).over(whole)).otherwise(F.first(c).over(whole))
    return df.withColumns({"other_t": pick(t), "other_p": pick(score)})
