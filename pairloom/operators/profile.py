"""Profiles of a split, diagnosis of lost pairs, and checks of result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions import vocabulary as V
from pairloom.operators.blocking import KEY


def profile(s1: DataFrame, targets: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """One row of counts and rates of a split.

    s1, targets: (entity_id, source, country, translit, addr_missing); truth: (s1_id, t_id), listed as often as given;
    universe: (s1_id) of all entities with a truth row, those without a match included. A target that does not exist
    counts as another country.
    """
    per = universe.select("s1_id").distinct().join(truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")), "s1_id", "left").fillna(0, ["n"])
    a = per.agg(
        F.count(F.lit(1)).alias("gt_entities"), F.avg((F.col("n") == 0).cast("int")).alias("singleton_rate"), F.avg("n").alias("matches_per_entity_mean"),
        F.avg(F.when(F.col("n") > 0, F.col("n"))).alias("matches_per_matched_entity_mean"), F.max("n").alias("matches_per_entity_max"),
    )
    q = s1.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("qc"))
    t = targets.select(F.col("entity_id").alias("t_id"), F.col("country").alias("tc"))
    b = truth.join(q, "s1_id", "left").join(t, "t_id", "left").agg(F.avg((~F.col("qc").eqNullSafe(F.col("tc"))).cast("int")).alias("cross_country_match_rate"))
    c = truth.groupBy("t_id").agg(F.count(F.lit(1)).alias("n")).agg(F.avg((F.col("n") > 1).cast("int")).alias("target_multi_claim_rate"))
    d = s1.agg(F.count(F.lit(1)).alias("n_source1"), F.avg("translit").alias("translit_rate_source1"), F.avg("addr_missing").alias("addr_missing_rate_source1"))
    e = targets.agg(F.count(F.lit(1)).alias("n_targets"), F.count_if(F.col("source") == 2).alias("n_source2"), F.count_if(F.col("source") == 3).alias("n_source3"), F.avg("translit").alias("translit_rate_targets"), F.avg("addr_missing").alias("addr_missing_rate_targets"))
    out = a
    for x in (b, c, d, e):  # one row each
        out = out.crossJoin(F.broadcast(x))
    return out


def match_histogram(truth: DataFrame, universe: DataFrame, most: int = 12) -> DataFrame:
    """(n_matches, entities): entities by their number of matches, `most` and more together."""
    per = universe.select("s1_id").distinct().join(truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")), "s1_id", "left").fillna(0, ["n"])
    return per.groupBy(F.least("n", F.lit(most)).alias("n_matches")).agg(F.count(F.lit(1)).alias("entities"))


def decisions(row: dict, most_violation: float = 0.01) -> dict:
    """Choices that follow from a profile: keys by country, and whether targets may be given to one entity only."""
    return {"scope_country": row["cross_country_match_rate"] <= 0.001, "exclusive": (False, True) if row["target_multi_claim_rate"] <= most_violation else (False,)}


def diagnose(truth: DataFrame, s1_keys: DataFrame, t_keys: DataFrame, candidates: DataFrame, k: int, df_cap: int) -> DataFrame:
    """(s1_id, t_id, category, rank_src, shared_channels, min_df) of every true pair.

    category: kept (rank below k), lost_topk, no_shared_key, lost_dfcap (all shared keys are on more than df_cap
    targets), lost_vote. Shared keys are found by joining the keys of true pairs only.
    """
    y = truth.select("s1_id", "t_id").distinct()
    df = t_keys.groupBy(*KEY).agg(F.count(F.lit(1)).alias("df"))
    mine = y.join(s1_keys, "s1_id").join(t_keys.select("t_id", *KEY), ["t_id", *KEY]).join(df, KEY)
    names = F.element_at(F.array(*[F.lit(n) for _, n, _ in V.CHANNELS]), F.col("channel") + 1)
    shared = mine.groupBy("s1_id", "t_id").agg(F.array_join(F.array_sort(F.collect_set(names)), ",").alias("shared_channels"), F.min("df").alias("min_df"))
    x = y.join(candidates.select("s1_id", "t_id", "rank_src"), ["s1_id", "t_id"], "left").join(shared, ["s1_id", "t_id"], "left")
    kind = F.when(F.col("rank_src") < k, "kept").when(F.col("rank_src").isNotNull(), "lost_topk").when(F.col("min_df").isNull(), "no_shared_key").when(F.col("min_df") > df_cap, "lost_dfcap").otherwise("lost_vote")
    return x.select("s1_id", "t_id", kind.alias("category"), "rank_src", F.coalesce("shared_channels", F.lit("")).alias("shared_channels"), "min_df")


def lost_channels(diagnosis: DataFrame, n: int = 25) -> DataFrame:
    """(category, channel, pairs): the n most frequent channels that lost pairs share."""
    x = diagnosis.where("category <> 'kept' and shared_channels <> ''").select("category", F.explode(F.split("shared_channels", ",")).alias("channel"))
    return x.groupBy("category", "channel").agg(F.count(F.lit(1)).alias("pairs")).orderBy(F.desc("pairs"), "category", "channel").limit(n)


def lost_examples(diagnosis: DataFrame, n: int = 60) -> DataFrame:
    """At most n pairs of each category but kept."""
    w = Window.partitionBy("category").orderBy("s1_id", "t_id")
    return diagnosis.where("category <> 'kept'").withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def list_errors(lists: DataFrame, s1: DataFrame, targets: DataFrame, column: str) -> DataFrame:
    """(label, rule, source1_entity_id, id): every breach of the rules of a result table (source1_entity_id, column).

    Rules: duplicate_row, unknown_source1, blank_id (empty or with blanks at its ends), duplicate_id, wrong_prefix (not
    S2- or S3-), unknown_target, missing_source1. s1 and targets: (entity_id). A null or empty list is a list of none.
    """
    rows = lists.select("source1_entity_id", F.col(f"`{column}`").alias("l"))
    known, there = s1.select(F.col("entity_id").alias("source1_entity_id")).distinct(), targets.select(F.col("entity_id").alias("id")).distinct()
    ids = rows.where(F.coalesce("l", F.lit("")) != "").select("source1_entity_id", F.explode(F.split("l", ",", -1)).alias("id"))
    none = F.lit(None).cast("string")
    blank = (F.col("id") == "") | F.col("id").rlike("^\\s|\\s$")
    ok = F.col("id").rlike("^S[23]-")
    out = [
        ("duplicate_row", rows.groupBy("source1_entity_id").count().where("count > 1").select("source1_entity_id", none.alias("id"))),
        ("unknown_source1", rows.select("source1_entity_id").join(known, "source1_entity_id", "left_anti").select("source1_entity_id", none.alias("id"))),
        ("blank_id", ids.where(blank)),
        ("duplicate_id", ids.groupBy("source1_entity_id", "id").count().where("count > 1").drop("count")),
        ("wrong_prefix", ids.where(~ok)),
        ("unknown_target", ids.where(ok).join(there, "id", "left_anti").select("source1_entity_id", "id")),
        ("missing_source1", known.join(rows.select("source1_entity_id"), "source1_entity_id", "left_anti").select("source1_entity_id", none.alias("id"))),
    ]
    all_ = None
    for rule, x in out:
        x = x.select(F.lit(column).alias("label"), F.lit(rule).alias("rule"), "source1_entity_id", "id")
        all_ = x if all_ is None else all_.unionByName(x)
    return all_


def validate(matches: DataFrame, candidates: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Breaches of both result tables, and not_candidate: matches that are no candidates of the same entity."""
    pairs = lambda df, c: df.where(F.coalesce(c, F.lit("")) != "").select("source1_entity_id", F.explode(F.split(c, ",", -1)).alias("id"))
    extra = pairs(matches, "matched_entity_ids").join(pairs(candidates, "candidate_entity_ids"), ["source1_entity_id", "id"], "left_anti")
    extra = extra.select(F.lit("matched_entity_ids").alias("label"), F.lit("not_candidate").alias("rule"), "source1_entity_id", "id")
    return list_errors(matches, s1, targets, "matched_entity_ids").unionByName(list_errors(candidates, s1, targets, "candidate_entity_ids")).unionByName(extra)
