"""Per-key results where a few keys hold most rows: two-stage salted aggregation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import Workspace


@dataclass(frozen=True)
class Agg:
    """A result per key that is computed in two stages. kind: count, sum, min, max, avg, count_distinct."""

    name: str
    kind: str
    of: str | None = None


def _quoted(cols: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in cols]


def _same(keys: list[str], prefix: str) -> Column:
    cond = None
    for k in keys:
        e = F.col(f"`{k}`").eqNullSafe(F.col(f"`{prefix}{k}`"))
        cond = e if cond is None else cond & e
    return cond


def salt(cols: list[str], salts: int) -> Column:
    """A number below salts from a row's values and its partition: the same when a lost task runs again, unlike rand(),
    and different for equal rows of different partitions."""
    return F.pmod(F.xxhash64(*_quoted(cols), F.spark_partition_id()), F.lit(salts)).cast("long")


def heavy_keys(df: DataFrame, keys: list[str], min_share: float | None = None, fraction: float = 0.02, seed: int = 17) -> DataFrame:
    """Keys that hold about min_share of the rows or more, by a sample of their columns alone.

    Which keys are heavy decides only where rows are salted, never a result, so a sample is enough. min_share None is
    a quarter of a shuffle partition's share, so that no unsalted key is much of a task. At most 2/min_share keys, a
    bound that does not follow the data.
    """
    share = min_share or 1 / (4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n = df.select(*_quoted(keys)).sample(fraction, seed).groupBy(*_quoted(keys)).agg(F.count(F.lit(1)).alias("__n"))
    total = n.agg(F.sum("__n").alias("__total"))
    return n.crossJoin(F.broadcast(total)).where((F.col("__n") >= F.col("__total") * F.lit(share / 2)) & (F.col("__n") >= 4)).select(*_quoted(keys))


def salted_aggregate(df: DataFrame, keys: list[str], aggs: list[Agg], heavy_share: float | None = None, salts: int = 64) -> DataFrame:
    """Aggregates per key in two stages without a task per hot key.

    Rows of heavy keys (see heavy_keys; the broadcast side is bounded by its share) get one of `salts` salts, other
    rows salt 0. Stage one groups by key and salt, stage two merges the partial results by key. For count_distinct the
    salt is a hash of the counted value, so that a value falls into one salt and the distinct counts of the salts add up
    exactly; several counted columns are aggregated apart and joined by key.

    A null key forms a group of its own, as in SQL. Null values are ignored by every aggregate but count without a
    column. An empty table gives an empty result. Output columns: keys, then the names of aggs; other columns of df,
    whatever they are called, are dropped before the shuffle.
    """
    wide = list(dict.fromkeys(a.of for a in aggs if a.kind == "count_distinct"))
    if len(wide) > 1:
        plain = [a for a in aggs if a.kind != "count_distinct"]
        out = None
        for i, o in enumerate(wide):
            mine = [a for a in aggs if a.kind == "count_distinct" and a.of == o] + (plain if i == 0 else [])
            part = salted_aggregate(df, keys, mine, heavy_share, salts)
            if out is None:
                out = part
            else:
                q = part.select(*[F.col(f"`{k}`").alias(f"__r_{k}") for k in keys], *[F.col(f"`{a.name}`") for a in mine])
                out = out.join(q, _same(keys, "__r_")).drop(*[f"__r_{k}" for k in keys])
        return out.select(*_quoted(keys), *_quoted([a.name for a in aggs]))
    used = list(dict.fromkeys([*keys, *[a.of for a in aggs if a.of]]))
    base = df.select(*_quoted(used))
    hot = Workspace(df.sparkSession, "heavy").write(heavy_keys(base, keys, heavy_share))
    hot = hot.select(*[F.col(f"`{k}`").alias(f"__h_{k}") for k in keys], F.lit(True).alias("__hot"))
    by = F.pmod(F.xxhash64(F.col(f"`{wide[0]}`")), F.lit(salts)).cast("long") if wide else salt(used, salts)
    salted = base.join(F.broadcast(hot), _same(keys, "__h_"), "left").withColumn("__salt", F.when(F.col("__hot"), by).otherwise(F.lit(0).cast("long")))
    first: list[Column] = []
    last: list[Column] = []
    for i, a in enumerate(aggs):
        c, p = F.col(f"`{a.of}`") if a.of else F.lit(1), f"__a{i}"
        if a.kind == "count":
            first.append(F.count(c).alias(p))
            last.append(F.sum(p).alias(a.name))
        elif a.kind in ("sum", "min", "max"):
            f = {"sum": F.sum, "min": F.min, "max": F.max}[a.kind]
            first.append(f(c).alias(p))
            last.append(f(p).alias(a.name))
        elif a.kind == "avg":
            first += [F.sum(c).alias(p + "s"), F.count(c).alias(p + "n")]
            last.append((F.sum(p + "s") / F.when(F.sum(p + "n") > 0, F.sum(p + "n"))).alias(a.name))
        elif a.kind == "count_distinct":
            first.append(F.count_distinct(c).alias(p))
            last.append(F.sum(p).alias(a.name))
        else:
            raise ValueError(f"unknown aggregate {a.kind}")
    return salted.groupBy(*_quoted(keys), "__salt").agg(*first).groupBy(*_quoted(keys)).agg(*last)


def salted_top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank", salts: int = 64) -> DataFrame:
    """The k first rows of each key by `order`, which should end in a unique column, with their rank from 1.

    Stage one keeps the k first rows of each key and salt, stage two of each key; no task sorts all rows of a hot key.
    Every key is salted: a key of few rows costs nothing by it. Null keys form a group. Fewer than k rows: all are kept.
    """
    part = df.withColumn("__salt", salt(df.columns, salts))
    w1 = Window.partitionBy(*_quoted(keys), "__salt").orderBy(*order)
    part = part.withColumn("__rn", F.row_number().over(w1)).where(F.col("__rn") <= k).drop("__rn", "__salt")
    w2 = Window.partitionBy(*_quoted(keys)).orderBy(*order)
    return part.withColumn(rank, F.row_number().over(w2)).where(F.col(rank) <= k)
