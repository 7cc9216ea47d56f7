"""Features of candidate pairs: the model's columns in their order, and the context that the other candidates give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions import similarity as S
from pairloom.functions import vocabulary as V
from pairloom.functions.normalise import skeleton
from pairloom.operators.blocking import spread
from pairloom.operators.ranking import competition, group_context, other_best

BLOCK = ["key_score", "n_keys", "rerank", "rank_src", "is_s3", "blk_t_n", "blk_t_rank", "blk_t_margin", "blk_g_rank", "blk_g_gap", "blk_g_n", "blk_g_sum"]
SCORED = {
    "n_ratio": ("ratio", "name_norm"), "n_tset": ("token_set", "name_norm"), "n_tsort": ("token_sort", "name_norm"), "n_partial": ("partial", "name_norm"), "n_jw": ("jaro_winkler", "name_norm"),
    "c_ratio": ("ratio", "name_core"), "c_tset": ("token_set", "name_core"), "c_partial_tset": ("partial_token_set", "name_core"), "c_jw": ("jaro_winkler", "name_core"), "c_exact": None, "c_compact_ratio": ("ratio", "__compact"),
    "p_ratio": ("ratio", "name_phon"), "p_tset": ("token_set", "name_phon"), "sk_ratio": ("ratio", "__sk"), "sk_tset": ("token_set", "__sk"),
    "a_ratio": ("ratio", "addr_norm"), "a_tset": ("token_set", "addr_norm"), "a_tsort": ("token_sort", "addr_norm"), "a_partial": ("partial", "addr_norm"), "combo_tset": ("token_set", "__combo"), "n_char_cos": ("trigram_cosine", "name_norm"), "a_char_cos": ("trigram_cosine", "addr_norm"),
}
PAIR = [
    *SCORED, "n_idf_jac", "n_idf_shared", "a_idf_jac", "a_idf_shared", "num_shared", "num_q", "num_t", "num_jac", "num_conflict", "post_shared", "post_conflict", "post_any",
    "code_shared", "code_conflict", "first_eq", "acronym", "len_ratio", "ntok_q", "ntok_t", "antok_q", "antok_t", "addr_miss_q", "addr_miss_t", "translit_q", "translit_t", "translit_mix",
    "rx_t_n", "rx_q_n", "rx_t_legal", "rx_q_legal", "rx_t_bracket", "rx_t_amp", "rx_t_generic", "rx_t_first_id", "rx_q_first_id", "rx_t_handle", "rx_same_tokens", "name_x_addr", "best_name",
]
CONTEXT = ["p1", "p1_t_n", "p1_t_rank", "p1_t_margin", "p1_g_rank", "p1_g_gap", "p1_g_n", "p1_g_sum", "p1_g_n_hi", "sup_p", "sup_name", "sup_addr", "sup_score"]


def words(text: str | Column) -> Column:
    return F.filter(F.split(text, " "), lambda t: t != "")


def word_weights(targets: DataFrame, view: str, n_targets: int | Column) -> DataFrame:
    """(word, w): log(1 + n_targets / (df + 1)) of the words of a view, df counted over targets."""
    n = n_targets if isinstance(n_targets, Column) else F.lit(n_targets)
    df = targets.select(F.explode(F.array_distinct(words(view))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return df.select("word", F.log1p(n / (F.col("df") + 1)).alias("w"))


def weighted_words(records: DataFrame, key: str, view: str, weight: DataFrame, n_targets: int | Column, out: str) -> DataFrame:
    """(key, out): a map of a record's words to their weights; a word of no target weighs most. Records without words
    are absent."""
    n = n_targets if isinstance(n_targets, Column) else F.lit(n_targets)
    w = records.select(key, F.explode(F.array_distinct(words(view))).alias("word")).join(weight, "word", "left").withColumn("w", F.coalesce("w", F.log1p(n)))
    return w.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("word", "w"))).alias(out))  # the words of one record


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def idf_overlap(q: Column, t: Column) -> tuple[Column, Column]:
    """(Jaccard, shared weight) of two maps of words to weights; null maps are empty."""
    none = F.create_map().cast("map<string,double>")
    q, t = F.coalesce(q, none), F.coalesce(t, none)
    shared = _sum(F.transform(F.array_intersect(F.map_keys(q), F.map_keys(t)), lambda w: F.element_at(q, w)))
    total = _sum(F.map_values(q)) + _sum(F.map_values(t)) - shared
    return F.when(total > 0, shared / total).otherwise(0.0), shared


def raw_words(name: Column) -> Column:
    """Words of a name as written: lower case, commas as blanks, dots left out."""
    return words(F.trim(F.regexp_replace(F.replace(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), ",", " "), F.lit("."), F.lit("")), "\\s+", " ")))


def name_variation(q: Column, t: Column) -> dict[str, Column]:
    """What was added to and removed from a name: q the first name as written, t the other."""
    qw, tw = raw_words(q), raw_words(t)
    more, less = S.left_over(tw, qw), S.left_over(qw, tw)
    has = lambda ws, vocabulary: F.exists(ws, lambda w: w.isin(*vocabulary)).cast("int")
    ids = F.create_map(*[F.lit(x) for i, w in enumerate(V.EXTRA_WORDS, 1) for x in (w, i)])
    first = lambda ws: F.when(F.size(ws) == 0, 0).otherwise(F.coalesce(F.try_element_at(ids, F.get(ws, 0)), F.lit(len(V.EXTRA_WORDS) + 1)))
    low = F.lower(F.coalesce(t, F.lit("")))
    return {
        "rx_t_n": F.size(more), "rx_q_n": F.size(less), "rx_t_legal": has(more, V.PLAIN_LEGAL), "rx_q_legal": has(less, V.PLAIN_LEGAL),
        "rx_t_bracket": F.exists(more, lambda w: w.contains("[") | w.contains("(")).cast("int"), "rx_t_amp": has(more, ("&", "and", "&-")), "rx_t_generic": has(more, V.GENERIC_ADDED),
        "rx_t_first_id": first(more), "rx_q_first_id": first(less), "rx_t_handle": (low.contains("@") | low.contains(".com") | low.contains("#") | low.contains("www")).cast("int"),
        "rx_same_tokens": ((F.size(more) == 0) & (F.size(less) == 0)).cast("int"),
    }


def acronym(q: Column, t: Column) -> Column:
    """Whether the initials of one core are the other one written together."""
    initials = lambda x: F.array_join(F.transform(words(x), lambda w: F.substring(w, 1, 1)), "")
    compact = lambda x: F.replace(x, F.lit(" "), F.lit(""))
    hit = lambda a, b: (F.length(initials(a)) > 1) & (initials(a) == compact(b))
    return (hit(q, t) | hit(t, q)).cast("int")


def record_side(records: DataFrame, key: str, weights: tuple[DataFrame, DataFrame], n_targets: int) -> DataFrame:
    """(key, r): a record's views and what is computed once for all its pairs."""
    name = weighted_words(records, key, "name_core", weights[0], n_targets, "nw")
    addr = weighted_words(records, key, "addr_norm", weights[1], n_targets, "aw")
    r = records.join(name, key, "left").join(addr, key, "left")
    return r.select(key, F.struct(
        "name_norm", "name_core", "name_phon", "addr_norm", "translit", "addr_missing", "nw", "aw", F.coalesce("business_name", F.lit("")).alias("raw"), skeleton(F.col("name_phon")).alias("__sk"),
        F.replace("name_core", F.lit(" "), F.lit("")).alias("__compact"), F.concat_ws(" ", "name_core", "addr_norm").alias("__combo"),
        words("nums").alias("nums"), words("postal").alias("postal"), words("codes").alias("codes"),
    ).alias("r"))


def pair_features(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """pairs with the columns of PAIR. s1 and targets: normalised records, one row per entity_id.

    Word weights come from the targets. What belongs to one record is computed before it is joined to its pairs; all
    string scores of a pair come from one call.
    """
    n = targets.count()
    weights = (word_weights(targets, "name_core", n), word_weights(targets, "addr_norm", n))
    q = record_side(s1.withColumnRenamed("entity_id", "s1_id"), "s1_id", weights, n).withColumnRenamed("r", "q")
    t = record_side(targets.withColumnRenamed("entity_id", "t_id"), "t_id", weights, n).withColumnRenamed("r", "t")
    x = spread(pairs).join(q, "s1_id").join(t, "t_id")
    c = F.col
    x = x.withColumn("__s", S.scores({f: (k[0], c(f"q.{k[1]}"), c(f"t.{k[1]}")) for f, k in SCORED.items() if k}))
    nj, ns = idf_overlap(c("q.nw"), c("t.nw"))
    aj, as_ = idf_overlap(c("q.aw"), c("t.aw"))
    num, post, code = (S.overlap(c(f"q.{v}"), c(f"t.{v}")) for v in ("nums", "postal", "codes"))
    first = lambda v: F.substring_index(v, " ", 1)
    ql, tl = F.length("q.name_core"), F.length("t.name_core")
    f = {k: c(f"__s.{k}") for k, v in SCORED.items() if v} | {
        "c_exact": ((c("q.name_core") == c("t.name_core")) & (c("q.name_core") != "")).cast("int"),
        "n_idf_jac": nj, "n_idf_shared": ns, "a_idf_jac": aj, "a_idf_shared": as_,
        "num_shared": num["shared"], "num_q": num["q"], "num_t": num["t"], "num_jac": num["jac"], "num_conflict": num["conflict"],
        "post_shared": post["shared"], "post_conflict": post["conflict"], "post_any": ((post["q"] > 0) & (post["t"] > 0)).cast("int"), "code_shared": code["shared"], "code_conflict": code["conflict"],
        "first_eq": ((first(c("q.name_core")) == first(c("t.name_core"))) & (c("q.name_core") != "")).cast("int"), "acronym": acronym(c("q.name_core"), c("t.name_core")),
        "len_ratio": F.least(ql, tl) / F.greatest(ql, tl, F.lit(1)), "ntok_q": F.size(words(c("q.name_core"))), "ntok_t": F.size(words(c("t.name_core"))),
        "antok_q": F.size(words(c("q.addr_norm"))), "antok_t": F.size(words(c("t.addr_norm"))), "addr_miss_q": c("q.addr_missing"), "addr_miss_t": c("t.addr_missing"),
        "translit_q": c("q.translit"), "translit_t": c("t.translit"), "translit_mix": (c("q.translit") != c("t.translit")).cast("int"),
        **name_variation(c("q.raw"), c("t.raw")), "name_x_addr": c("__s.c_tset") * c("__s.a_tset") / 100, "best_name": F.greatest(*[c(f"__s.{k}") for k in ("n_tset", "c_tset", "p_tset", "c_compact_ratio")]),
    }
    return x.select(*[c(k) for k in pairs.columns], *[f[k].cast("double").alias(k) for k in PAIR])


def finalise_candidates(candidates: DataFrame, k: int) -> DataFrame:
    """Candidates of rank below k with is_s3, competition and group context of their rerank."""
    kept = candidates.where(F.col("rank_src") < k).withColumn("is_s3", (F.col("t_source") == 3).cast("double"))
    return group_context(competition(kept, "rerank", "blk"), "rerank", "blk")


def add_context(pairs: DataFrame, targets: DataFrame, p: str = "p1") -> DataFrame:
    """pairs with the columns of CONTEXT: competition and group context of p, how many other candidates of the entity
    are likely, and how much the best other candidate supports this one (-1 without another)."""
    hi = (F.col(p) >= 0.5).cast("int")
    x = group_context(competition(pairs, p, "p1"), p, "p1")
    x = x.withColumns({"p1": F.col(p), "p1_g_n_hi": F.sum(hi).over(Window.partitionBy("s1_id")) - hi})
    x = other_best(x, p)
    side = lambda key, pre: targets.select(F.col("entity_id").alias(key), F.col("name_core").alias(f"{pre}_n"), F.col("addr_norm").alias(f"{pre}_a"))
    x = x.join(side("t_id", "__t"), "t_id", "left").join(side("other_t", "__o"), "other_t", "left")
    x = x.withColumn("__s", S.scores({"n": ("token_set", F.col("__t_n"), F.col("__o_n")), "a": ("token_set", F.col("__t_a"), F.col("__o_a"))}))
    there = F.col("other_t").isNotNull()
    n, a = F.col("__s.n") / 100, F.col("__s.a") / 100
    return x.select(*pairs.columns, *[c for c in CONTEXT if c in x.columns and c not in pairs.columns], *[e.alias(k) for k, e in {
        "sup_p": F.when(there, F.col("other_p")).otherwise(-1.0), "sup_name": F.when(there, n).otherwise(-1.0), "sup_addr": F.when(there, a).otherwise(-1.0),
        "sup_score": F.when(there, F.col("other_p") * (0.5 * n + 0.5 * a)).otherwise(0.0),
    }.items()])
