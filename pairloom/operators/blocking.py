"""Candidate pairs by shared keys: keys of records, their frequency, the weighted vote, cuts, and the rerank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import vocabulary as V
from pairloom.functions.normalise import skeleton
from pairloom.functions.similarity import cheap_similarity
from pairloom.operators.ranking import top_k


def _split(c: str | Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def _bigrams(words: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat(F.get(words, i), F.lit("_"), F.get(words, i + 1)))).otherwise(none)


def _cross(left: Column, right: Column) -> Column:
    return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.concat(a, F.lit("#"), b))))


def record_keys() -> Column:
    """array<struct<channel, key>> of a normalised record, each key once. Channels are those of the vocabulary."""
    core, addr, nums, codes, sound = _split("name_core"), _split("addr_norm"), _split("nums"), _split("codes"), skeleton(F.col("name_phon"))
    digits = lambda t: t.rlike("^[0-9]+$")
    long_ = F.filter(nums, lambda n: F.length(n) >= 3)
    words = F.filter(addr, lambda t: (F.length(t) >= 4) & t.rlike("^[a-z]+$"))
    one = lambda c, ok: F.when(ok, F.array(c)).otherwise(F.array().cast("array<string>"))
    compact = F.replace(F.col("name_core"), F.lit(" "), F.lit(""))
    values = {
        0: one(F.col("name_core"), F.col("name_core") != ""),
        1: F.filter(core, lambda t: (F.length(t) >= 3) & ~digits(t)),
        2: one(F.substring(compact, 1, 5), F.length(compact) >= 4),
        3: F.filter(_split(sound), lambda t: (F.length(t) >= 2) & ~digits(t)),
        4: _bigrams(core),
        5: long_,
        6: codes,
        7: _bigrams(addr),
        8: F.when(F.size(core) > 0, F.transform(F.slice(long_, 1, 3), lambda n: F.concat(core[0], F.lit("#"), n))).otherwise(F.array().cast("array<string>")),
        9: one(sound, F.col("name_phon") != ""),
        10: words,
        11: _cross(F.slice(F.array_distinct(F.filter(addr, digits)), 1, 2), F.slice(F.array_distinct(words), 1, 4)),
    }
    tag = lambda ch: lambda k: F.struct(F.lit(ch).alias("channel"), k.alias("key"))
    return F.concat(*[F.transform(F.array_distinct(v), tag(ch)) for ch, v in values.items()])


def build_keys(norm: DataFrame, entity: str = "entity_id", scope: str | None = "country", carry: tuple[str, ...] = ()) -> DataFrame:
    """(entity, carry, scope, channel, key): one row per record and key. Keys match only within one scope; None is no scope."""
    s = F.coalesce(F.trim(f"`{scope}`"), F.lit("")) if scope else F.lit("")
    return norm.select(F.col(f"`{entity}`"), *carry, s.alias("scope"), F.explode(record_keys()).alias("k")).select(entity, *carry, "scope", "k.channel", "k.key")


KEY = ["scope", "channel", "key"]


def key_index(target_keys: DataFrame, n_targets: int | Column, df_cap: int | None = 1000) -> DataFrame:
    """(scope, channel, key, df, idf): keys of at most df_cap targets, idf = log(1 + n_targets / df) over all targets.

    df_cap leaves out keys too common to tell records apart: it is part of the candidates' definition, and their pairs
    come in only by rarer keys. None keeps every key.
    """
    n = target_keys.groupBy(*KEY).agg(F.count(F.lit(1)).alias("df"))
    n = n if df_cap is None else n.where(F.col("df") <= df_cap)
    total = n_targets if isinstance(n_targets, Column) else F.lit(n_targets)
    return n.withColumn("idf", F.log1p(total / F.col("df")))


def weights() -> Column:
    """The vote of a key's channel."""
    return F.element_at(F.array(*[F.lit(w) for _, _, w in V.CHANNELS]), F.col("channel") + 1)


def vote(s1_keys: DataFrame, target_keys: DataFrame, index: DataFrame, carry: tuple[str, ...] = ("t_source",)) -> DataFrame:
    """(s1_id, t_id, carry, key_score, n_keys): for each pair that shares a kept key, the sum of weight times idf.

    The index, the targets' keys and the queries' keys share one partitioning by key; sums are combined before pairs
    are shuffled. A key is on at most df_cap targets, so no key makes a task of its own.
    """
    post = target_keys.join(index, KEY)
    hits = s1_keys.join(post, KEY)
    return hits.groupBy("s1_id", "t_id", *carry).agg(F.sum(weights() * F.col("idf")).alias("key_score"), F.count(F.lit(1)).cast("int").alias("n_keys"))


def generate_candidates(s1: DataFrame, targets: DataFrame, scope: str | None = "country", df_cap: int | None = 1000, k_wide: int = 80, k_max: int = 20) -> DataFrame:
    """(s1_id, t_id, t_source, key_score, n_keys, rerank, rank_src): the k_max best targets of each s1 and source.

    s1 and targets: normalised records, one row per entity_id; targets with source. The vote is cut at k_wide before
    any similarity is computed; the rest is ranked by similarity plus a little of the vote.
    """
    k1 = build_keys(s1.withColumnRenamed("entity_id", "s1_id"), "s1_id", scope)
    k2 = build_keys(targets.select(F.col("entity_id").alias("t_id"), F.col("source").alias("t_source"), "name_core", "name_phon", "addr_norm", "nums", "codes", *([scope] if scope else [])), "t_id", scope, ("t_source",))
    voted = vote(k1, k2, key_index(k2, targets.count(), df_cap))
    wide = top_k(voted.withColumn("key_score", F.round("key_score", 6)), ["s1_id", "t_source"], "key_score", k_wide, rank="__wide").drop("__wide")
    score = cheap_similarity(rerank_pairs(wide, s1, targets)).withColumn("rerank", F.round(F.col("similarity") + 0.02 * F.log1p("key_score"), 6))
    cut = top_k(score, ["s1_id", "t_source"], "rerank", k_max, rank="rank_src")
    return cut.select("s1_id", "t_id", "t_source", "key_score", "n_keys", "rerank", "rank_src")


def rerank_pairs(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """pairs with the views of both records, q_* of s1 and t_* of the target."""
    views = ["name_core", "name_phon", "addr_norm", "nums"]
    q = s1.select(F.col("entity_id").alias("s1_id"), *[F.col(v).alias(f"q_{v}") for v in views])
    t = targets.select(F.col("entity_id").alias("t_id"), *[F.col(v).alias(f"t_{v}") for v in views])
    return spread(pairs).join(q, "s1_id").join(t, "t_id")


def spread(pairs: DataFrame) -> DataFrame:
    """pairs over all shuffle partitions by s1_id, before records are joined for costly scores: few rows of ids would
    else be gathered into few tasks, and the join by s1_id needs this partitioning anyway."""
    return pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s1_id")


def dedup_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first by `order`, which should end in a unique column. Null keys are one group."""
    first = F.min(F.struct(*[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(order)], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"))).alias("__f")
    return df.groupBy(F.col(f"`{key}`").alias("__k")).agg(first).select("__f.__row.*")
