"""Scores of matches against truth: per entity F0.5, macro means, blocking figures, breakdowns and thresholds.

truth and pairs are frames of (s1_id, t_id), universe of (s1_id): the entities scored, one row each. Pairs and truth of
other entities are left out; repeated pairs and truth rows count once. An entity without truth scores 1 if nothing is
matched to it, else 0. Means over nothing are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with hit: whether the pair is in truth."""
    known = truth.select("s1_id", "t_id").distinct().withColumn("hit", F.lit(True))
    return pairs.join(known, ["s1_id", "t_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def known_truth(truth: DataFrame, s1: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(truth whose two ids exist, one row of counts: n_truth of known s1, n_unknown_targets among them)."""
    mine = truth.join(s1.select("s1_id").distinct(), "s1_id", "left_semi")
    ids = targets.select("t_id").distinct().withColumn("__there", F.lit(True))
    marked = mine.join(ids, "t_id", "left")
    counts = marked.agg(F.count(F.lit(1)).alias("n_truth"), F.count_if(F.col("__there").isNull()).alias("n_unknown_targets"))
    return marked.where("__there").select("s1_id", "t_id"), counts


def f05(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """F0.5 of one entity."""
    return F.when(n_true == 0, (n_pred == 0).cast("double")).when(tp > 0, 1.25 * tp / (0.25 * n_true + n_pred)).otherwise(F.lit(0.0))


def per_entity(pairs: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """(s1_id, tp, n_pred, n_true, f05): one row per entity of universe.

    Pairs and truth are laid one upon the other and summed, so each comes to its entity once and is combined before.
    """
    both = pairs.select("s1_id", "t_id").distinct().withColumns({"p": F.lit(1), "y": F.lit(0)}).unionByName(truth.select("s1_id", "t_id").distinct().withColumns({"p": F.lit(0), "y": F.lit(1)}))
    pair = both.groupBy("s1_id", "t_id").agg(F.max("p").alias("p"), F.max("y").alias("y"))
    sums = pair.groupBy("s1_id").agg(F.sum(F.col("p") * F.col("y")).alias("tp"), F.sum("p").alias("n_pred"), F.sum("y").alias("n_true"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    out = universe.select("s1_id").distinct().join(sums, "s1_id", "left").select("s1_id", zero("tp"), zero("n_pred"), zero("n_true"))
    return out.withColumn("f05", f05(F.col("tp"), F.col("n_pred"), F.col("n_true")))


def _means() -> list[Column]:
    precision = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred"))
    recall = F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true"))
    return [
        F.avg("f05").alias("macro_f05"), F.avg(precision).alias("macro_precision"), F.avg(recall).alias("macro_recall"),
        F.avg(F.when(F.col("n_true") == 0, F.col("f05"))).alias("f05_singletons"), F.avg(F.when(F.col("n_true") > 0, F.col("f05"))).alias("f05_non_singletons"),
        F.count(F.lit(1)).alias("n_entities"), F.count_if(F.col("n_true") == 0).alias("n_singletons"), F.coalesce(F.sum("n_pred"), F.lit(0)).alias("n_pred_pairs"),
    ]


def macro_f05(pairs: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: macro F0.5, precision (entities with matches) and recall (entities with truth), by singletons, counts."""
    return per_entity(pairs, truth, universe).agg(*_means())


def oracle_f05(tp: Column, n_true: Column) -> Column:
    """F0.5 that a perfect matcher reaches on candidates with tp true pairs."""
    return F.when(n_true == 0, 1.0).when(tp > 0, 1.25 * tp / (0.25 * n_true + tp)).otherwise(0.0)


def _ratio(a: Column, b: Column) -> Column:
    return a / F.greatest(b, F.lit(1))


def blocking_stats(pairs: DataFrame, truth: DataFrame, universe: DataFrame, n_targets: int | Column) -> DataFrame:
    """One row: candidate pairs, pairs per entity, reduction ratio, pair recall, oracle macro F0.5, entities fully covered."""
    n_t = n_targets if isinstance(n_targets, Column) else F.lit(n_targets)
    e, n, u = per_entity(pairs, truth, universe), F.sum("n_pred"), F.count(F.lit(1))
    full = F.count_if((F.col("tp") == F.col("n_true")) & (F.col("n_true") > 0))
    return e.agg(
        n.alias("candidate_pairs"), _ratio(n, u).alias("avg_candidates_per_s1"), (1 - _ratio(n, u * n_t)).alias("reduction_ratio"), _ratio(F.sum("tp"), F.sum("n_true")).alias("pair_recall"),
        F.avg(oracle_f05(F.col("tp"), F.col("n_true"))).alias("oracle_macro_f05"), _ratio(full, F.count_if(F.col("n_true") > 0)).alias("entities_fully_covered"),
    )


def k_curve(candidates: DataFrame, truth: DataFrame, universe: DataFrame, k_max: int, n_targets: int) -> DataFrame:
    """(k, candidate_pairs, avg_candidates_per_s1, reduction_ratio, pair_recall, oracle_macro_f05) for k from 1 to k_max.

    Hits are counted once by entity and rank, and each k sums the ranks below it; entities without a hit count as a whole.
    """
    hits = labelled(candidates.select("s1_id", "t_id", "rank_src").where(F.col("rank_src") < k_max).join(universe.select("s1_id").distinct(), "s1_id", "left_semi"), truth)
    per = hits.groupBy("s1_id", "rank_src").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("h"))
    ks = F.explode(F.sequence(F.col("rank_src") + 1, F.lit(k_max))).alias("k")
    upto = per.select("s1_id", "n", "h", ks).groupBy("k", "s1_id").agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
    true = truth.select("s1_id", "t_id").distinct().groupBy("s1_id").agg(F.count(F.lit(1)).alias("y"))
    true = universe.select("s1_id").distinct().join(true, "s1_id", "left").select("s1_id", F.coalesce("y", F.lit(0)).alias("y"))
    whole = true.agg(F.count(F.lit(1)).alias("u"), F.sum("y").alias("ys"), F.count_if(F.col("y") == 0).alias("lone"))
    gain = F.when(F.col("y") > 0, oracle_f05(F.col("h"), F.col("y"))).otherwise(0.0)
    by_k = upto.join(true, "s1_id").groupBy("k").agg(F.sum("n").alias("n"), F.sum("h").alias("h"), F.sum(gain).alias("f"))
    x = by_k.crossJoin(F.broadcast(whole))
    return x.select(
        "k", F.col("n").alias("candidate_pairs"), _ratio(F.col("n"), F.col("u")).alias("avg_candidates_per_s1"), (1 - _ratio(F.col("n"), F.col("u") * n_targets)).alias("reduction_ratio"),
        _ratio(F.col("h"), F.col("ys")).alias("pair_recall"), _ratio(F.col("f") + F.col("lone"), F.col("u")).alias("oracle_macro_f05"),
    )


def choose_k(curve: DataFrame, tolerance: float = 0.002) -> DataFrame:
    """One row k: the smallest with a recall of at least that of the last k less tolerance."""
    w = Window.partitionBy()
    last = F.max_by("pair_recall", "k").over(w)  # one row a k
    return curve.withColumn("__last", last).where(F.col("pair_recall") >= F.col("__last") - tolerance).agg(F.min("k").alias("k"))


def match_bucket(n: Column) -> Column:
    return F.when(n == 0, "0 (singleton)").when(n == 1, "1").when(n <= 3, "2-3").otherwise("4+")


def error_breakdown(pairs: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """(view, value, entities, macro_f05, precision, recall) by country, script, address and number of true matches.

    entities: (s1_id, country, translit, addr_missing), one row each. One pass with grouping sets.
    """
    yes = lambda c: F.when(F.col(c) > 0, "yes").otherwise("no")
    e = per_entity(pairs, truth, entities).join(entities, "s1_id")
    e = e.select("tp", "n_pred", "n_true", "f05", F.coalesce("country", F.lit("")).alias("country"), yes("translit").alias("non_latin_script"), yes("addr_missing").alias("address_missing"), match_bucket(F.col("n_true")).alias("true_match_count"))
    views = ["country", "non_latin_script", "address_missing", "true_match_count"]
    g = e.groupingSets([[v] for v in views], *views).agg(*[F.grouping(v).alias(f"__{v}") for v in views], *_means())
    name = F.coalesce(*[F.when(F.col(f"__{v}") == 0, F.lit(v)) for v in views])
    value = F.coalesce(*[F.when(F.col(f"__{v}") == 0, F.col(v)) for v in views])
    return g.select(name.alias("view"), value.alias("value"), F.col("n_entities").alias("entities"), "macro_f05", F.col("macro_precision").alias("precision"), F.col("macro_recall").alias("recall"))


def error_patterns(pairs: DataFrame) -> DataFrame:
    """One row of counts and shares of wrong and missed pairs.

    pairs: (sel, hit, c_exact, num_conflict, addr_miss_q, addr_miss_t, translit_mix, c_tset), one row a candidate.
    """
    fp, fn = F.col("sel") & ~F.col("hit"), ~F.col("sel") & F.col("hit")
    absent = (F.col("addr_miss_q") + F.col("addr_miss_t")) > 0
    share = lambda mask, cond: F.avg(F.when(mask, cond.cast("double")))
    return pairs.agg(
        F.count_if(fp).alias("false_positive_pairs"), share(fp, F.col("c_exact") > 0).alias("fp_share_identical_core_name"), share(fp, F.col("num_conflict") > 0).alias("fp_share_numeric_conflict"),
        share(fp, absent).alias("fp_share_address_missing"), F.count_if(fn).alias("false_negative_pairs"), share(fn, F.col("translit_mix") > 0).alias("fn_share_mixed_script"),
        share(fn, absent).alias("fn_share_address_missing"), share(fn, F.col("c_tset") < 60).alias("fn_share_low_name_similarity"),
    )


def error_examples(pairs: DataFrame, n: int = 40) -> DataFrame:
    """The n wrong pairs of highest p and the n missed pairs of lowest p; pairs: (s1_id, t_id, p, sel, hit)."""
    fp = pairs.where(F.col("sel") & ~F.col("hit")).orderBy(F.desc("p"), "s1_id", "t_id").limit(n).withColumn("type", F.lit("false_positive"))
    fn = pairs.where(~F.col("sel") & F.col("hit")).orderBy(F.asc("p"), "s1_id", "t_id").limit(n).withColumn("type", F.lit("false_negative"))
    return fp.unionByName(fn).select("type", "s1_id", "t_id", "p")


def prune_threshold(scored: DataFrame, tolerance: float = 0.004, most: float = 0.5) -> DataFrame:
    """One row threshold: the score that loses at most `tolerance` of the true pairs, at most `most`, 0 without any.

    scored: (p, hit). The exact order statistic: scores are counted per value, and the running count runs over the
    buckets of a thousandth first, so that no task orders all rows.
    """
    pos = scored.where("hit").groupBy("p").agg(F.count(F.lit(1)).alias("n")).withColumn("b", F.floor(F.col("p") * 1000))
    per = pos.groupBy("b").agg(F.sum("n").alias("n"))
    w = Window.partitionBy().orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # at most 1001 rows
    base = per.select("b", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"), F.sum("n").over(Window.partitionBy()).alias("total"))
    inner = Window.partitionBy("b").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    run = pos.join(F.broadcast(base), "b").withColumn("upto", F.col("base") + F.sum("n").over(inner))
    cut = run.where(F.col("upto") > F.floor(F.col("total") * tolerance)).agg(F.min("p").alias("p"))
    return cut.select(F.when(F.col("p").isNull(), 0.0).otherwise(F.least("p", F.lit(most))).alias("threshold"))
