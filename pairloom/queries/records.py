"""Queries over normalised records of the train split: views, keys, votes, candidates, similarities and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import similarity as S
from pairloom.functions import vocabulary as V
from pairloom.functions.normalise import VIEWS, normalise, normalise_sql, skeleton_sql
from pairloom.operators import blocking, features, metrics, model, profile
from pairloom.operators.packed import explode_packed
from pairloom.queries.shape import SQL as SHAPE_SQL
from pairloom.queries.shape import TARGET_ID
from pairloom.queries.tables import TRAIN, table
from pairloom.session import Workspace
from pairloom.sources import files

RECORD = ["entity_id", "business_name", "business_address", "country", "loaded_at"]
ORDER = ["source", "loaded_at", "business_name", "business_address"]
#: The reference's cap is a parameter; the queries take one that bites at these sizes.
DF_CAP, K = 200, 5


def records(spark: SparkSession, d: str, names: list[str] = TRAIN) -> DataFrame:
    """Rows of the sources with their number; repeated rows included."""
    out = None
    for n in names:
        t = table(spark, d, n).select(*RECORD, F.lit(int(n[-1])).cast("tinyint").alias("source"))
        out = t if out is None else out.unionByName(t)
    return out


def records_sql(names: list[str] = TRAIN) -> str:
    return " union all ".join(f"select {', '.join(RECORD)}, cast({n[-1]} as tinyint) source from {n}" for n in names)


def norm_records(spark: SparkSession, d: str) -> DataFrame:
    return normalise(records(spark, d)).select("entity_id", "source", *VIEWS)


def dedup_targets(spark: SparkSession, d: str) -> DataFrame:
    return blocking.dedup_first(records(spark, d, TRAIN[1:]), "entity_id", ORDER)


def _sides(spark: SparkSession, d: str, scope: str = "train") -> tuple[DataFrame, DataFrame]:
    """(source 1, targets): normalised, one row an entity, written once."""
    ws = Workspace(spark, "sides")
    names = [n.replace("train", scope) for n in TRAIN]
    return tuple(ws.write(normalise(blocking.dedup_first(records(spark, d, n), "entity_id", ORDER)), "side") for n in (names[:1], names[1:]))


def _keys(s1: DataFrame, t: DataFrame) -> tuple[DataFrame, DataFrame]:
    k1 = blocking.build_keys(s1.withColumnRenamed("entity_id", "s1_id"), "s1_id")
    return k1, blocking.build_keys(t.withColumnRenamed("entity_id", "t_id").withColumnRenamed("source", "t_source"), "t_id", carry=("t_source",))


def _truth(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "train_matches").select(F.regexp_replace("source1_entity_id", "^[\\s\\u00a0]+|[\\s\\u00a0]+$", "").alias("s1_id"), "matched_entity_ids")
    return explode_packed(rows, "matched_entity_ids", "t_id", keep=TARGET_ID, carry=["s1_id"]).select("s1_id", "t_id").distinct()


def _universe(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train_matches").select(F.regexp_replace("source1_entity_id", "^[\\s\\u00a0]+|[\\s\\u00a0]+$", "").alias("s1_id")).where("s1_id is not null").distinct()


def block_keys(spark, d):
    """Keys of source 1 in all channels."""
    return _keys(*_sides(spark, d))[0]


def key_index(spark, d):
    s1, t = _sides(spark, d)
    return blocking.key_index(_keys(s1, t)[1], t.count(), DF_CAP)


def key_cap_stats(spark, d):
    """Keys of targets by channel: how many the cap keeps and drops, and the postings it drops."""
    k = _keys(*_sides(spark, d))[1].groupBy(*blocking.KEY).agg(F.count(F.lit(1)).alias("df"))
    return k.groupBy("channel").agg(F.count_if(F.col("df") <= DF_CAP).alias("kept"), F.count_if(F.col("df") > DF_CAP).alias("dropped"), F.coalesce(F.sum(F.when(F.col("df") > DF_CAP, F.col("df"))), F.lit(0)).alias("postings_dropped"))


def block_vote(spark, d):
    s1, t = _sides(spark, d)
    k1, k2 = _keys(s1, t)
    return blocking.vote(k1, k2, blocking.key_index(k2, t.count(), DF_CAP)).withColumn("key_score", F.round("key_score", 6))


def block_topk(spark, d):
    return blocking.top_k(block_vote(spark, d), ["s1_id", "t_source"], "key_score", K, rank="rank_src")


def candidates(spark, d):
    """Wide cut by the vote, rerank by similarity, final cut."""
    return blocking.generate_candidates(*_sides(spark, d), df_cap=DF_CAP, k_wide=20, k_max=K)


def candidate_recall(spark, d):
    """How many true pairs the candidates hold, per source."""
    hit = metrics.labelled(candidates(spark, d), _truth(spark, d))
    return hit.groupBy("t_source").agg(F.count(F.lit(1)).alias("pairs"), F.count_if("hit").alias("true_pairs"))


def diagnosis(spark, d):
    """True pairs by what the vote's top K does to them."""
    s1, t = _sides(spark, d)
    k1, k2 = _keys(s1, t)
    return profile.diagnose(_truth(spark, d), k1, k2, block_topk(spark, d), K, DF_CAP).fillna(-1, ["rank_src", "min_df"])


def lost_channels(spark, d):
    return profile.lost_channels(diagnosis(spark, d))


def lost_examples(spark, d):
    return profile.lost_examples(diagnosis(spark, d))


def split_profile(spark, d):
    s1, t = _sides(spark, d)
    return profile.profile(s1, t, _truth(spark, d), _universe(spark, d))


def match_histogram(spark, d):
    return profile.match_histogram(_truth(spark, d), _universe(spark, d))


def error_breakdown(spark, d):
    """The best voted target of each entity and source as its matches, scored by country, script, address and matches."""
    s1 = _sides(spark, d)[0].select(F.col("entity_id").alias("s1_id"), "country", "translit", "addr_missing")
    return metrics.error_breakdown(block_topk(spark, d).where("rank_src = 0"), _truth(spark, d), s1)


def _true_pairs(spark: SparkSession, d: str) -> DataFrame:
    """True pairs whose records exist, with q_* and t_* views."""
    s1, t = _sides(spark, d)
    views = [*VIEWS, "business_name"]
    q = s1.select(F.col("entity_id").alias("s1_id"), *[F.col(v).alias(f"q_{v}") for v in views])
    return blocking.spread(_truth(spark, d)).join(q, "s1_id").join(t.select(F.col("entity_id").alias("t_id"), *[F.col(v).alias(f"t_{v}") for v in views]), "t_id")


def _score(kind: str):
    def run(spark, d):
        p = _true_pairs(spark, d)
        return p.select("s1_id", "t_id", F.round(S.scores({"v": (kind, F.col("q_name_core"), F.col("t_name_core"))})["v"], 6).alias("score"))

    return run


lcs_ratio, token_set_ratio, token_sort_ratio, jaro_winkler = _score("ratio"), _score("token_set"), _score("token_sort"), _score("jaro_winkler")
partial_ratio, partial_token_set_ratio = _score("partial"), _score("partial_token_set")


def trigram_cos(spark, d):
    s = S.scores({"v": ("trigram_cosine", F.col("q_name_norm"), F.col("t_name_norm"))})["v"]
    return _true_pairs(spark, d).select("s1_id", "t_id", F.round(s, 6).alias("cosine"))


def num_overlap(spark, d):
    o = S.overlap(features.words("q_nums"), features.words("t_nums"))
    return _true_pairs(spark, d).select("s1_id", "t_id", *[(F.round(v, 6) if k == "jac" else v.cast("int")).alias(k) for k, v in o.items()])


def idf_jaccard(spark, d):
    s1, t = _sides(spark, d)
    n = t.count()
    w = features.word_weights(t, "name_core", n)
    q = features.weighted_words(s1.withColumnRenamed("entity_id", "s1_id"), "s1_id", "name_core", w, n, "q")
    r = features.weighted_words(t.withColumnRenamed("entity_id", "t_id"), "t_id", "name_core", w, n, "r")
    p = _truth(spark, d).join(s1.select(F.col("entity_id").alias("s1_id")), "s1_id").join(t.select(F.col("entity_id").alias("t_id")), "t_id")
    jac, shared = features.idf_overlap(F.col("q"), F.col("r"))
    return p.join(q, "s1_id", "left").join(r, "t_id", "left").select("s1_id", "t_id", F.round(jac, 6).alias("jaccard"), F.round(shared, 6).alias("shared"))


def name_variation(spark, d):
    v = features.name_variation(F.col("q_business_name"), F.col("t_business_name"))
    return _true_pairs(spark, d).select("s1_id", "t_id", *[e.cast("int").alias(k) for k, e in v.items()])


def acronym(spark, d):
    f = lambda c: F.substring_index(c, " ", 1)
    first = ((f(F.col("q_name_core")) == f(F.col("t_name_core"))) & (F.col("q_name_core") != "")).cast("int")
    ql, tl = F.length("q_name_core"), F.length("t_name_core")
    return _true_pairs(spark, d).select("s1_id", "t_id", features.acronym(F.col("q_name_core"), F.col("t_name_core")).alias("acronym"), first.alias("first_eq"), F.round(F.least(ql, tl) / F.greatest(ql, tl, F.lit(1)), 6).alias("len_ratio"))


def pair_features(spark, d):
    """All 61 features of the true pairs."""
    s1, t = _sides(spark, d)
    return features.pair_features(_truth(spark, d), s1, t)


def context_features(spark, d):
    """Context of the candidates by their rerank as probability."""
    s1, t = _sides(spark, d)
    c = blocking.generate_candidates(s1, t, df_cap=DF_CAP, k_wide=20, k_max=K)
    return features.add_context(c.select("s1_id", "t_id", F.least(F.lit(1.0), F.col("rerank")).alias("p1")), t)


def id_lists(spark, d):
    """Result lists of source 1 from the true pairs, in order of the target's id."""
    p = _truth(spark, d).withColumn("p", F.lit(0.5))
    return files.id_lists(table(spark, d, "train_source1").select(F.col("entity_id").alias("s1_id")), p, "p", "matched_entity_ids")


def truth_lists(spark, d):
    """Comma lists read as ground truth: the last labelled row of an entity counts."""
    return files.truth_pairs(table(spark, d, "train_matches"), "gt_row").fillna({"pos": -1, "t_id": ""})


def validate_rules(spark, d):
    """Breaches of the truth lists as a result file: repeated rows, odd ids, unknown targets, missing entities."""
    t = table(spark, d, "train_source2").select("entity_id").unionByName(table(spark, d, "train_source3").select("entity_id"))
    m = table(spark, d, "train_matches").select("source1_entity_id", "matched_entity_ids")
    return profile.list_errors(m, table(spark, d, "train_source1"), t, "matched_entity_ids").groupBy("rule").agg(F.count(F.lit(1)).alias("breaches"))


def tsv_round_trip(spark, d):
    """Source 1 written as a tab-separated file and read again."""
    ws = Workspace(spark, "tsv")
    t = table(spark, d, "train_source1").select("entity_id", *[F.regexp_replace(F.coalesce(c, F.lit("")), "[\\t\\r\\n]", " ").alias(c) for c in ("business_name", "business_address", "country")])
    files.write_tsv(t, f"{ws.root}/train/train_source1.tsv")
    return files.read_source(spark, ws.root, "train", 1)


# SQL

_S1 = "trim(regexp_replace(source1_entity_id, '^[\\s\\x{00a0}]+|[\\s\\x{00a0}]+$', '', 'g'))"
_ROWS = f"""src as ({records_sql()}), ded as (select * exclude rn from (select *, row_number() over (partition by entity_id, source = 1 order by source, loaded_at nulls first, business_name nulls first, business_address nulls first) rn from src) where rn = 1),
 {normalise_sql('ded')}, q as (select * from norm where source = 1), t as (select * from norm where source > 1), p3 as ({SHAPE_SQL['p3_found']}),
 truth as (select distinct {_S1} s1_id, matched_entity_id t_id from p3 join train_matches using (gt_row) where source1_entity_id is not null),
 universe as (select distinct {_S1} s1_id from train_matches where source1_entity_id is not null)"""


def _split(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def keys_sql(rel: str) -> str:
    """Keys of the rows of rel: (entity_id, source, scope, channel, key)."""
    core, addr, nums, codes = (_split(c) for c in ("name_core", "addr_norm", "nums", "codes"))
    sk, long_ = skeleton_sql("name_phon"), f"list_filter({nums}, lambda n: length(n) >= 3)"
    words = f"list_filter({addr}, lambda w: length(w) >= 4 and regexp_matches(w, '^[a-z]+$'))"
    first = lambda xs: f"list_filter({xs}, lambda w, i: list_position({xs}, w) = i)"
    pairs = lambda xs: f"case when len({xs}) > 1 then list_transform(range(1, len({xs})), lambda i: ({xs})[i] || '_' || ({xs})[i + 1]) else [] end"
    digit = f"list_filter({addr}, lambda w: regexp_matches(w, '^[0-9]+$'))"
    value = {
        0: "case when name_core <> '' then [name_core] else [] end", 1: f"list_filter({core}, lambda w: length(w) >= 3 and not regexp_matches(w, '^[0-9]+$'))",
        2: "case when length(replace(name_core, ' ', '')) >= 4 then [left(replace(name_core, ' ', ''), 5)] else [] end", 3: f"list_filter({_split(sk)}, lambda w: length(w) >= 2 and not regexp_matches(w, '^[0-9]+$'))",
        4: pairs(core), 5: long_, 6: codes, 7: pairs(addr), 8: f"case when name_core <> '' then list_transform(list_slice({long_}, 1, 3), lambda n: ({core})[1] || '#' || n) else [] end", 9: f"case when name_phon <> '' then [{sk}] else [] end",
        10: words, 11: f"flatten(list_transform(list_slice({first(digit)}, 1, 2), lambda a: list_transform(list_slice({first(words)}, 1, 4), lambda b: a || '#' || b)))",
    }
    return " union all ".join(f"select entity_id, source, coalesce(trim(country), '') as scope, {ch} as channel, unnest(list_distinct({v})) as key from {rel}" for ch, v in value.items())


_VOTE = f"""{_ROWS}, k1 as ({keys_sql('q')}), k2 as ({keys_sql('t')}), ix as (select scope, channel, key, count(*) df, ln(1 + (select count(*) from t) / count(*)) idf from k2 group by all having count(*) <= {DF_CAP}),
 vote as (select k1.entity_id s1_id, k2.entity_id t_id, k2.source t_source, round(sum(idf * ([{', '.join(str(w) for _, _, w in V.CHANNELS)}])[channel + 1]), 6) key_score, cast(count(*) as integer) n_keys from k1 join k2 using (scope, channel, key) join ix using (scope, channel, key) group by all),
 topk as (select *, cast(row_number() over (partition by s1_id, t_source order by key_score desc, t_id) - 1 as integer) rank_src from vote qualify row_number() over (partition by s1_id, t_source order by key_score desc, t_id) <= {K})"""
_DIAG = f"""{_VOTE}, kd as (select scope, channel, key, count(*) df from k2 group by all), sh as (select s1_id, t_id, min(df) min_df, array_to_string(list_sort(list_distinct(list(([{', '.join(repr(n) for _, n, _ in V.CHANNELS)}])[k1.channel + 1]))), ',') shared_channels
  from truth join k1 on k1.entity_id = s1_id join k2 on k2.entity_id = t_id and k2.scope = k1.scope and k2.channel = k1.channel and k2.key = k1.key join kd on kd.scope = k1.scope and kd.channel = k1.channel and kd.key = k1.key group by all),
 diag as (select s1_id, t_id, case when rank_src < {K} then 'kept' when rank_src is not null then 'lost_topk' when min_df is null then 'no_shared_key' when min_df > {DF_CAP} then 'lost_dfcap' else 'lost_vote' end category, coalesce(rank_src, -1) rank_src, coalesce(shared_channels, '') shared_channels, coalesce(min_df, -1) min_df
  from truth left join topk using (s1_id, t_id) left join sh using (s1_id, t_id))"""
_PAIRS = f"{_ROWS}, pairs as (select truth.s1_id, truth.t_id, " + ", ".join(f"q.{v} q_{v}, t.{v} t_{v}" for v in [*VIEWS, "business_name"]) + " from truth join q on q.entity_id = s1_id join t on t.entity_id = t_id)"


def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence by the table of all prefixes, row by row."""
    row = f"list_reduce(list_prepend([0], list_transform(range(1, length({b}) + 1), lambda j: [j])), lambda r, j: list_append(r, case when substr({b}, j[1], 1) = ca[1] then prev[j[1]] + 1 else greatest(prev[j[1] + 1], r[len(r)]) end))"
    start = f"list_transform(range(0, length({b}) + 1), lambda z: cast(0 as bigint))"
    return f"list_extract(list_reduce(list_prepend({start}, list_transform(string_split({a}, ''), lambda c: [ascii(c)])), lambda prev, ca: {row.replace('substr(' + b + ', j[1], 1) = ca[1]', 'ascii(substr(' + b + ', j[1], 1)) = ca[1]')}), -1)"


def _ratio(a: str, b: str) -> str:
    return f"case when {a} = {b} then 100.0 when {a} = '' or {b} = '' then 0.0 else 200.0 * {_lcs(a, b)} / (length({a}) + length({b})) end"


_SETS = f"""{_PAIRS}, w as (select s1_id, t_id, {_split('q_name_core')} a, {_split('t_name_core')} b from pairs),
 x as (select *, array_to_string(list_sort(list_distinct(list_filter(a, lambda v: list_contains(b, v)))), ' ') i, array_to_string(list_sort(list_distinct(list_filter(a, lambda v: not list_contains(b, v)))), ' ') l, array_to_string(list_sort(list_distinct(list_filter(b, lambda v: not list_contains(a, v)))), ' ') r from w),
 y as (select *, trim(i || ' ' || l) il, trim(i || ' ' || r) ir from x)"""
_RAW = "list_filter(string_split(regexp_replace(replace(replace(lower(coalesce({c}, '')), ',', ' '), '.', ''), '\\s+', ' ', 'g'), ' '), lambda w: w <> '')"
_LEFT = "list_filter({a}, lambda w, i: len(list_filter(list_slice({a}, 1, i), lambda v: v = w)) > len(list_filter({b}, lambda v: v = w)))"
_IN = lambda ws, vocabulary: f"cast(len(list_filter({ws}, lambda w: w in ({', '.join(repr(x) for x in vocabulary)}))) > 0 as integer)"
_FIRST = "case when len({x}) = 0 then 0 else coalesce(list_position([" + ", ".join(repr(x) for x in V.EXTRA_WORDS) + f"], {{x}}[1]), {len(V.EXTRA_WORDS) + 1}) end"
_GRAMS = lambda x: f"flatten(list_transform({_split(x)}, lambda w: list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3))))"

SQL = {
    "norm_records": f"with src as ({records_sql()}), {normalise_sql('src')} select entity_id, source, {', '.join(VIEWS)} from norm",
    "dedup_targets": f"with src as ({records_sql(TRAIN[1:])}) select {', '.join(RECORD)}, source from src qualify row_number() over (partition by entity_id order by source, loaded_at nulls first, business_name nulls first, business_address nulls first) = 1",
    "block_keys": f"with {_ROWS}, k as ({keys_sql('q')}) select entity_id s1_id, scope, channel, key from k",
    "key_index": f"with {_VOTE} select * from ix",
    "key_cap_stats": f"with {_VOTE}, k as (select channel, count(*) df from k2 group by scope, channel, key) select channel, count(case when df <= {DF_CAP} then 1 end) kept, count(case when df > {DF_CAP} then 1 end) dropped, cast(coalesce(sum(case when df > {DF_CAP} then df end), 0) as bigint) postings_dropped from k group by channel",
    "block_vote": f"with {_VOTE} select * from vote",
    "block_topk": f"with {_VOTE} select * from topk",
    "diagnosis": f"with {_DIAG} select * from diag",
    "lost_channels": f"with {_DIAG}, e as (select category, unnest(string_split(shared_channels, ',')) channel from diag where category <> 'kept' and shared_channels <> '') select category, channel, count(*) pairs from e group by all order by pairs desc, category, channel limit 25",
    "lost_examples": f"with {_DIAG} select * from diag where category <> 'kept' qualify row_number() over (partition by category order by s1_id, t_id) <= 60",
    "split_profile": f"""with {_ROWS}, per as (select u.s1_id, count(t_id) n from universe u left join truth using (s1_id) group by all)
 select count(*) gt_entities, avg(cast(n = 0 as integer)) singleton_rate, avg(n) matches_per_entity_mean, avg(case when n > 0 then n end) matches_per_matched_entity_mean, max(n) matches_per_entity_max,
 (select avg(cast(q.country is distinct from t.country as integer)) from truth left join q on q.entity_id = s1_id left join t on t.entity_id = t_id) cross_country_match_rate,
 (select avg(cast(n > 1 as integer)) from (select count(*) n from truth group by t_id)) target_multi_claim_rate, (select count(*) from q) n_source1, (select avg(translit) from q) translit_rate_source1, (select avg(addr_missing) from q) addr_missing_rate_source1,
 (select count(*) from t) n_targets, (select count(*) from t where source = 2) n_source2, (select count(*) from t where source = 3) n_source3, (select avg(translit) from t) translit_rate_targets, (select avg(addr_missing) from t) addr_missing_rate_targets from per""",
    "match_histogram": f"with {_ROWS}, per as (select u.s1_id, count(t_id) n from universe u left join truth using (s1_id) group by all) select least(n, 12) n_matches, count(*) entities from per group by 1",
    "error_breakdown": f"""with {_VOTE}, sel as (select s1_id, t_id from topk where rank_src = 0), e0 as (select q.entity_id s1_id, coalesce(country, '') country, case when translit > 0 then 'yes' else 'no' end non_latin_script, case when addr_missing > 0 then 'yes' else 'no' end address_missing from q),
 e1 as (select e0.*, (select count(*) from sel where sel.s1_id = e0.s1_id) n_pred, (select count(*) from truth where truth.s1_id = e0.s1_id) n_true, (select count(*) from sel join truth using (s1_id, t_id) where sel.s1_id = e0.s1_id) tp from e0),
 e as (select *, case when n_true = 0 then '0 (singleton)' when n_true = 1 then '1' when n_true <= 3 then '2-3' else '4+' end true_match_count, case when n_true = 0 then cast(n_pred = 0 as double) when tp > 0 then 1.25 * tp / (0.25 * n_true + n_pred) else 0.0 end f from e1)
 """ + " union all ".join(f"select '{v}' as view, {v} as value, count(*) entities, avg(f) macro_f05, avg(case when n_pred > 0 then tp / n_pred end) as precision, avg(case when n_true > 0 then tp / n_true end) recall from e group by {v}" for v in ("country", "non_latin_script", "address_missing", "true_match_count")),
    "lcs_ratio": f"with {_PAIRS} select s1_id, t_id, round({_ratio('q_name_core', 't_name_core')}, 6) score from pairs",
    "token_sort_ratio": f"with {_PAIRS}, z as (select s1_id, t_id, array_to_string(list_sort({_split('q_name_core')}), ' ') a, array_to_string(list_sort({_split('t_name_core')}), ' ') b from pairs) select s1_id, t_id, round({_ratio('a', 'b')}, 6) score from z",
    "token_set_ratio": f"with {_SETS} select s1_id, t_id, round(case when len(a) = 0 or len(b) = 0 then 0.0 when i <> '' and (l = '' or r = '') then 100.0 else greatest({_ratio('il', 'ir')}, case when i <> '' then greatest({_ratio('i', 'il')}, {_ratio('i', 'ir')}) else 0.0 end) end, 6) score from y",
    "jaro_winkler": f"with {_PAIRS} select s1_id, t_id, round(jaro_winkler_similarity(q_name_core, t_name_core), 6) score from pairs",
    "trigram_cos": f"""with {_PAIRS}, g as (select s1_id, t_id, {_GRAMS('q_name_norm')} a, {_GRAMS('t_name_norm')} b from pairs), ga as (select s1_id, t_id, g, count(*) n from (select s1_id, t_id, unnest(a) g from g) group by all), gb as (select s1_id, t_id, g, count(*) n from (select s1_id, t_id, unnest(b) g from g) group by all),
 dot as (select s1_id, t_id, sum(ga.n * gb.n) d from ga join gb using (s1_id, t_id, g) group by all), na as (select s1_id, t_id, sqrt(sum(n * n)) x from ga group by all), nb as (select s1_id, t_id, sqrt(sum(n * n)) y from gb group by all)
 select s1_id, t_id, round(coalesce(d / (x * y), 0.0), 6) cosine from pairs left join dot using (s1_id, t_id) left join na using (s1_id, t_id) left join nb using (s1_id, t_id)""",
    "num_overlap": f"""with {_PAIRS}, n as (select s1_id, t_id, {_split('q_nums')} a, {_split('t_nums')} b from pairs), o as (select *, len(list_filter(a, lambda v: list_contains(b, v))) s from n)
 select s1_id, t_id, cast(s as integer) shared, cast(len(a) as integer) q, cast(len(b) as integer) t, round(case when len(a) + len(b) - s > 0 then s / (len(a) + len(b) - s) else 0.0 end, 6) jac, cast(len(a) > 0 and len(b) > 0 and s = 0 as integer) conflict from o""",
    "idf_jaccard": f"""with {_PAIRS}, tw as (select distinct entity_id, unnest({_split('name_core')}) word from t), df as (select word, count(*) df from tw group by all), n as (select count(*) n from t),
 wq as (select distinct s1_id, t_id, unnest({_split('q_name_core')}) word from pairs), wt as (select distinct s1_id, t_id, unnest({_split('t_name_core')}) word from pairs), wi as (select word, ln(1 + n / (coalesce(df, 0) + 1)) w from (select word from wq union select word from wt) left join df using (word), n),
 a as (select s1_id, t_id, sum(w) a from wq join wi using (word) group by all), b as (select s1_id, t_id, sum(w) b from wt join wi using (word) group by all), c as (select s1_id, t_id, sum(w) c from wq join wt using (s1_id, t_id, word) join wi using (word) group by all)
 select s1_id, t_id, round(case when coalesce(a, 0) + coalesce(b, 0) - coalesce(c, 0) > 0 then coalesce(c, 0) / (coalesce(a, 0) + coalesce(b, 0) - coalesce(c, 0)) else 0.0 end, 6) jaccard, round(coalesce(c, 0.0), 6) shared from pairs left join a using (s1_id, t_id) left join b using (s1_id, t_id) left join c using (s1_id, t_id)""",
    "name_variation": f"""with {_PAIRS}, r as (select s1_id, t_id, lower(coalesce(t_business_name, '')) low, {_RAW.format(c='q_business_name')} q, {_RAW.format(c='t_business_name')} t from pairs), v as (select *, {_LEFT.format(a='t', b='q')} m, {_LEFT.format(a='q', b='t')} l from r)
 select s1_id, t_id, cast(len(m) as integer) rx_t_n, cast(len(l) as integer) rx_q_n, {_IN('m', V.PLAIN_LEGAL)} rx_t_legal, {_IN('l', V.PLAIN_LEGAL)} rx_q_legal, cast(len(list_filter(m, lambda w: contains(w, '[') or contains(w, '('))) > 0 as integer) rx_t_bracket, {_IN('m', ('&', 'and', '&-'))} rx_t_amp, {_IN('m', V.GENERIC_ADDED)} rx_t_generic,
 cast({_FIRST.format(x='m')} as integer) rx_t_first_id, cast({_FIRST.format(x='l')} as integer) rx_q_first_id, cast(contains(low, '@') or contains(low, '.com') or contains(low, '#') or contains(low, 'www') as integer) rx_t_handle, cast(len(m) = 0 and len(l) = 0 as integer) rx_same_tokens from v""",
    "acronym": f"""with {_PAIRS}, i as (select *, array_to_string(list_transform({_split('q_name_core')}, lambda w: left(w, 1)), '') qi, array_to_string(list_transform({_split('t_name_core')}, lambda w: left(w, 1)), '') ti from pairs)
 select s1_id, t_id, cast((length(qi) > 1 and qi = replace(t_name_core, ' ', '')) or (length(ti) > 1 and ti = replace(q_name_core, ' ', '')) as integer) acronym, cast(split_part(q_name_core, ' ', 1) = split_part(t_name_core, ' ', 1) and q_name_core <> '' as integer) first_eq,
 round(least(length(q_name_core), length(t_name_core)) / greatest(length(q_name_core), length(t_name_core), 1), 6) len_ratio from i""",
    "id_lists": f"with {_ROWS}, l as (select s1_id, string_agg(t_id, ',' order by t_id) l from truth group by s1_id) select s1.entity_id source1_entity_id, coalesce(l, '') matched_entity_ids from (select distinct entity_id from train_source1) s1 left join l on l.s1_id = s1.entity_id",
    "truth_lists": """with r as (select trim(source1_entity_id) s1_id, arg_max(coalesce(matched_entity_ids, ''), gt_row) l from train_matches group by 1), v as (select s1_id, list_filter(list_transform(string_split(l, ','), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') l from r)
 select s1_id, cast(-1 as integer) pos, '' t_id from v where len(l) = 0 union all select s1_id, cast(generate_subscripts(l, 1) - 1 as integer), unnest(l) from v where len(l) > 0""",
    "validate_rules": """with m as (select source1_entity_id s, matched_entity_ids l from train_matches), i as (select s, unnest(string_split(l, ',')) id from m where coalesce(l, '') <> ''), t as (select entity_id from train_source2 union select entity_id from train_source3), q as (select distinct entity_id from train_source1),
 e as (select 'duplicate_row' as rule from m group by s having count(*) > 1 union all select 'unknown_source1' from m where not exists (select 1 from q where entity_id = s) union all select 'blank_id' from i where id = '' or regexp_matches(id, '^\\s|\\s$') union all select 'duplicate_id' from i group by s, id having count(*) > 1
  union all select 'wrong_prefix' from i where not regexp_matches(id, '^S[23]-') union all select 'unknown_target' from i where regexp_matches(id, '^S[23]-') and not exists (select 1 from t where entity_id = id) union all select 'missing_source1' from q where not exists (select 1 from m where s = entity_id)) select rule, count(*) breaches from e group by rule""",
    "tsv_round_trip": "select entity_id, regexp_replace(coalesce(business_name, ''), '[\\t\\r\\n]', ' ', 'g') business_name, regexp_replace(coalesce(business_address, ''), '[\\t\\r\\n]', ' ', 'g') business_address, regexp_replace(regexp_replace(coalesce(country, ''), '[\\t\\r\\n]', ' ', 'g'), '^\\s+|\\s+$', '', 'g') country, cast(1 as tinyint) source from train_source1",
}
QUERIES = {f: globals()[f] for f in (
    "norm_records", "dedup_targets", "block_keys", "key_index", "key_cap_stats", "block_vote", "block_topk", "candidates", "candidate_recall", "diagnosis", "lost_channels", "lost_examples", "split_profile", "match_histogram", "error_breakdown",
    "lcs_ratio", "token_sort_ratio", "token_set_ratio", "jaro_winkler", "partial_ratio", "partial_token_set_ratio", "trigram_cos", "num_overlap", "idf_jaccard", "name_variation", "acronym", "pair_features", "context_features", "id_lists", "truth_lists", "validate_rules", "tsv_round_trip",
)}


def _labelled_candidates(spark, d):
    s1, t = _sides(spark, d)
    c = blocking.generate_candidates(s1, t, df_cap=DF_CAP, k_wide=20, k_max=K)
    return metrics.labelled(features.finalise_candidates(Workspace(spark, "candidates").write(c), K), _truth(spark, d)), s1, t


def pruned_candidates(spark, d):
    """Candidates that the learned pruner keeps, with their out-of-fold score."""
    pairs, _, _ = _labelled_candidates(spark, d)
    scored, _, threshold, _ = model.fit_pruner(Workspace(spark, "pairs").write(pairs), n_folds=2, rounds=5, depth=3)
    return scored.where(F.col("p0") >= threshold).select("s1_id", "t_id", "hit", "p0")


def stage1_scores(spark, d):
    """Out-of-fold probabilities of the candidates from all features."""
    pairs, s1, t = _labelled_candidates(spark, d)
    x = features.pair_features(pairs.withColumn("p0", F.lit(0.0)), s1, t)
    return model.train_oof(x, [*features.BLOCK, *features.PAIR], n_folds=2, rounds=5, depth=4, p="p1")[0].select("s1_id", "t_id", "hit", "p1")


def feature_importance(spark, d):
    """Share of the gain of the blocking features in the pruner."""
    pairs, _, _ = _labelled_candidates(spark, d)
    m = model.fit_pruner(Workspace(spark, "pairs").write(pairs), n_folds=2, rounds=5, depth=3)[1]
    return spark.createDataFrame(model.importance(m), "feature string, gain double, splits int")


def competition_sample(spark, d):
    """Seed entities and those that compete with them for a target."""
    return model.competition_sample(block_topk(spark, d), 200, 400)


def error_patterns(spark, d):
    """Wrong and missed pairs among the candidates, the best rerank of each source taken as matches."""
    pairs, s1, t = _labelled_candidates(spark, d)
    x = features.pair_features(pairs.withColumn("sel", F.col("rank_src") == 0), s1, t)
    return metrics.error_patterns(x)


def unions(spark, d):
    """Set operations over ids: union, intersection and difference of the targets named in truth and those that exist."""
    named = _truth(spark, d).select("t_id").distinct()
    there = records(spark, d, TRAIN[1:]).select(F.col("entity_id").alias("t_id")).distinct()
    tag = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    return tag(named.union(there).distinct(), "union").unionByName(tag(named.intersect(there), "intersect")).unionByName(tag(there.subtract(named), "except")).unionByName(tag(records(spark, d, TRAIN[1:]), "union all"))


SQL["unions"] = f"""with {_ROWS}, a as (select distinct t_id from truth), b as (select entity_id t_id from train_source2 union select entity_id from train_source3)
 select 'union' what, count(*) n from (select * from a union select * from b) union all select 'intersect', count(*) from (select * from a intersect select * from b) union all select 'except', count(*) from (select * from b except select * from a)
 union all select 'union all', count(*) from (select entity_id from train_source2 union all select entity_id from train_source3)"""
QUERIES |= {f.__name__: f for f in (pruned_candidates, stage1_scores, feature_importance, competition_sample, error_patterns, unions)}
