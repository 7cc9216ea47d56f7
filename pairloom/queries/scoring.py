"""Queries of decoders, windows and metrics over scored pairs, and their SQL.

The scored pairs are the orders' suppliers: s1 is the order, t the supplier, and p a number from 0.05 to 0.96 made of
discount and quantity. An order's true suppliers are those of its lines with a small tax.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators import decoders, metrics, ranking
from pairloom.queries.tables import table


def _scored(spark: SparkSession, d: str) -> DataFrame:
    p = F.round(F.lit(0.05) + 9.0 * F.max(F.col("l_discount").cast("double")) + F.max(F.col("l_quantity").cast("double")) / 10000.0, 6)
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("s1_id"), F.col("l_suppkey").alias("t_id")).agg(p.alias("p"))


def _truth(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").where(F.col("l_tax").cast("double") <= 0.03).select(F.col("l_orderkey").alias("s1_id"), F.col("l_suppkey").alias("t_id"))


def _universe(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("s1_id"))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return ranking.ranked(_scored(spark, d), ["s1_id"], "p", rank="rank_src")


def _selected(spark: SparkSession, d: str) -> DataFrame:
    return decoders.decode_expected_f(_scored(spark, d), 1.0, 1.0)


GRID = [p for p in decoders.candidate_policies() if p["kind"] == "expected_f" and p["alpha"] in (0.7, 1.0) and p["empty_bias"] in (1.0, 2.0) or p["kind"] == "threshold" and p["t_top"] in (0.3, 0.6) and p["t_rest"] in (0.3, 0.5, 0.8)]


def rank_within(spark, d):
    return _candidates(spark, d)


def topk(spark, d):
    return ranking.top_k(_scored(spark, d), ["s1_id"], "p", 2)


def competition(spark, d):
    return ranking.competition(_scored(spark, d), "p", "blk")


def group_ctx(spark, d):
    return ranking.group_context(_scored(spark, d), "p", "blk")


def other_best(spark, d):
    return ranking.other_best(_scored(spark, d), "p").fillna({"other_t": -1, "other_p": -1.0})


def decode_threshold(spark, d):
    return decoders.decode_threshold(_scored(spark, d), 0.6, 0.4)


def decode_expected_f(spark, d):
    return _selected(spark, d)


def exclusivity(spark, d):
    return decoders.enforce_exclusivity(decoders.decode_threshold(_scored(spark, d), 0.6, 0.4))


def macro_f05(spark, d):
    return metrics.macro_f05(_selected(spark, d).where("sel"), _truth(spark, d), _universe(spark, d))


def block_stats(spark, d):
    return metrics.blocking_stats(_candidates(spark, d).where("rank_src < 2"), _truth(spark, d), _universe(spark, d), table(spark, d, "supplier").count())


def k_curve(spark, d):
    return metrics.k_curve(_candidates(spark, d), _truth(spark, d), _universe(spark, d), 6, table(spark, d, "supplier").count())


def choose_k(spark, d):
    return metrics.choose_k(k_curve(spark, d), 0.02)


def prune_threshold(spark, d):
    return metrics.prune_threshold(metrics.labelled(_scored(spark, d), _truth(spark, d)), 0.1)


def error_examples(spark, d):
    return metrics.error_examples(metrics.labelled(_selected(spark, d), _truth(spark, d)))


def policy_grid(spark, d):
    return decoders.score_policies(spark, _scored(spark, d), _truth(spark, d), _universe(spark, d), GRID)


def best_policy(spark, d):
    t = policy_grid(spark, d)
    return t.orderBy(F.desc(F.round("macro_f05", 12)), "policy_id").limit(1).select("policy_id", "macro_f05")


def labels(spark, d):
    return metrics.labelled(_scored(spark, d), _truth(spark, d))


def known_truth(spark, d):
    """Truth of all lines against half the suppliers: how many targets are unknown."""
    some = table(spark, d, "supplier").where("s_nationkey < 12").select(F.col("s_suppkey").alias("t_id"))
    return metrics.known_truth(_truth(spark, d), _universe(spark, d), some)[1]


_S = """s as (select l_orderkey s1_id, l_suppkey t_id, round(0.05 + 9.0 * max(cast(l_discount as double)) + max(cast(l_quantity as double)) / 10000.0, 6) p from lineitem group by all),
 y as (select distinct l_orderkey s1_id, l_suppkey t_id from lineitem where cast(l_tax as double) <= 0.03), u as (select o_orderkey s1_id from orders)"""
_RANKED = f"{_S}, c as (select *, cast(row_number() over (partition by s1_id order by p desc, t_id) - 1 as integer) rank_src from s)"


def _expected(alpha: str, bias: str, rel: str = "s", key: str = "") -> str:
    k = f"{key}, " if key else ""
    return f"""e1 as (select *, power(greatest(1e-6, least(1 - 1e-6, p)), {alpha}) q from {rel}),
 e2 as (select *, row_number() over (partition by {k}s1_id order by p desc, t_id) k, sum(q) over (partition by {k}s1_id order by p desc, t_id rows unbounded preceding) sk,
  sum(q) over (partition by {k}s1_id) sa, exp(sum(ln(1 - q)) over (partition by {k}s1_id)) p0 from e1),
 e3 as (select *, 1.25 * sk / (0.25 * sa / greatest(1 - p0, 1e-9) + k) e from e2),
 e4 as (select *, max(e) over (partition by {k}s1_id) best from e3),
 e5 as (select *, min(case when e >= best - 1e-12 then k end) over (partition by {k}s1_id) cut from e4),
 ef as (select * exclude (q, k, sk, sa, p0, e, best, cut), best > {bias} * p0 and k <= cut sel from e5)"""


_THR = "case when row_number() over (partition by {k}s1_id order by p desc, t_id) = 1 then p >= {a} else p >= {b} and max(p) over (partition by {k}s1_id) >= {a} end"
_ENT = """ent as (select s1_id, coalesce(tp, 0) tp, coalesce(n_pred, 0) n_pred, coalesce(n_true, 0) n_true from u left join (select s1_id, count(*) n_pred, count(y.t_id) tp from {sel} left join y using (s1_id, t_id) group by s1_id) using (s1_id)
  left join (select s1_id, count(*) n_true from y group by s1_id) using (s1_id)),
 ent2 as (select *, case when n_true = 0 then cast(n_pred = 0 as double) when tp > 0 then 1.25 * tp / (0.25 * n_true + n_pred) else 0.0 end f from ent)"""
_ORACLE = "case when n_true = 0 then 1.0 when tp > 0 then 1.25 * tp / (0.25 * n_true + tp) else 0.0 end"


def _values(rows: list[dict]) -> str:
    v = lambda x: "null" if x is None else ("true" if x is True else "false" if x is False else f"'{x}'" if isinstance(x, str) else repr(x))
    lines = ", ".join("(" + ", ".join([str(i), *(v(p.get(c)) for c in ("kind", "t_top", "t_rest", "alpha", "empty_bias")), v(bool(p.get("exclusive")))]) + ")" for i, p in enumerate(rows))
    return f"select cast(policy_id as integer) policy_id, kind, cast(t_top as double) t_top, cast(t_rest as double) t_rest, cast(alpha as double) alpha, cast(empty_bias as double) empty_bias, exclusive from (values {lines}) g(policy_id, kind, t_top, t_rest, alpha, empty_bias, exclusive)"


_GRID = f"""{_S}, g as ({_values(GRID)}), x as (select * from s cross join g),
 th as (select *, {_THR.format(k='policy_id, ', a='t_top', b='t_rest')} sel from x where kind = 'threshold'), xe as (select * from x where kind = 'expected_f'), {_expected('alpha', 'empty_bias', 'xe', 'policy_id')},
 al as (select * from th union all select * from ef),
 se as (select policy_id, s1_id, t_id from (select *, row_number() over (partition by policy_id, t_id order by p desc, s1_id) rn from al where sel) where not exclusive or rn = 1),
 pe as (select g.policy_id, u.s1_id, coalesce(tp, 0) tp, coalesce(n_pred, 0) n_pred, coalesce(n_true, 0) n_true from g cross join u
  left join (select policy_id, s1_id, count(*) n_pred, count(y.t_id) tp from se left join y using (s1_id, t_id) group by all) using (policy_id, s1_id) left join (select s1_id, count(*) n_true from y group by s1_id) using (s1_id)),
 gr as (select policy_id, avg(case when n_true = 0 then cast(n_pred = 0 as double) when tp > 0 then 1.25 * tp / (0.25 * n_true + n_pred) else 0.0 end) macro_f05,
  avg(case when n_pred > 0 then tp / n_pred end) macro_precision, avg(case when n_true > 0 then tp / n_true end) macro_recall from pe group by policy_id)"""
_CURVE = f"""{_RANKED}, ks as (select unnest(range(1, 7)) k), lab as (select c.*, y.t_id is not null hit from c left join y using (s1_id, t_id)), nt as (select u.s1_id, count(y.t_id) n_true from u left join y using (s1_id) group by all),
 pk as (select k, nt.s1_id, n_true, count(lab.t_id) n, count(case when hit then 1 end) tp from ks cross join nt left join lab on lab.s1_id = nt.s1_id and rank_src < k group by all),
 curve as (select cast(k as integer) k, cast(sum(n) as bigint) candidate_pairs, sum(n) / count(*) avg_candidates_per_s1, 1 - sum(n) / (count(*) * (select count(*) from supplier)) reduction_ratio,
  sum(tp) / sum(n_true) pair_recall, avg({_ORACLE}) oracle_macro_f05 from pk group by k)"""
_OTHER = "case when row_number() over (partition by {key} order by p desc, {tie}) = 1 then nth_value({c}, 2) over (partition by {key} order by p desc, {tie} rows between unbounded preceding and unbounded following) else first_value({c}) over (partition by {key} order by p desc, {tie}) end"

SQL = {
    "rank_within": f"with {_RANKED} select * from c",
    "topk": f"with {_RANKED} select s1_id, t_id, p, rank_src as rank from c where rank_src < 2",
    "competition": f"with {_S} select *, cast(count(*) over (partition by t_id) as integer) blk_t_n, cast(row_number() over (partition by t_id order by p desc, s1_id) - 1 as integer) blk_t_rank, coalesce(p - {_OTHER.format(key='t_id', tie='s1_id', c='p')}, 1.0) blk_t_margin from s",
    "group_ctx": f"with {_S} select *, cast(row_number() over (partition by s1_id order by p desc, t_id) - 1 as integer) blk_g_rank, p - max(p) over (partition by s1_id) blk_g_gap, cast(count(*) over (partition by s1_id) as integer) blk_g_n, sum(p) over (partition by s1_id) blk_g_sum from s",
    "other_best": f"with {_S} select *, coalesce({_OTHER.format(key='s1_id', tie='t_id', c='t_id')}, -1) other_t, coalesce({_OTHER.format(key='s1_id', tie='t_id', c='p')}, -1.0) other_p from s",
    "decode_threshold": f"with {_S} select *, {_THR.format(k='', a=0.6, b=0.4)} sel from s",
    "decode_expected_f": f"with {_S}, {_expected('1.0', '1.0')} select * from ef",
    "exclusivity": f"with {_S}, t as (select *, {_THR.format(k='', a=0.6, b=0.4)} sel from s) select s1_id, t_id, p, sel and row_number() over (partition by t_id, sel order by p desc, s1_id) = 1 sel from t",
    "macro_f05": f"""with {_S}, {_expected('1.0', '1.0')}, se as (select s1_id, t_id from ef where sel), {_ENT.format(sel='se')} select avg(f) macro_f05, avg(case when n_pred > 0 then tp / n_pred end) macro_precision, avg(case when n_true > 0 then tp / n_true end) macro_recall,
 avg(case when n_true = 0 then f end) f05_singletons, avg(case when n_true > 0 then f end) f05_non_singletons, count(*) n_entities, count(case when n_true = 0 then 1 end) n_singletons, cast(sum(n_pred) as bigint) n_pred_pairs from ent2""",
    "block_stats": f"""with {_RANKED}, se as (select s1_id, t_id from c where rank_src < 2), {_ENT.format(sel='se')} select cast(sum(n_pred) as bigint) candidate_pairs, sum(n_pred) / count(*) avg_candidates_per_s1, 1 - sum(n_pred) / (count(*) * (select count(*) from supplier)) reduction_ratio,
 sum(tp) / sum(n_true) pair_recall, avg({_ORACLE}) oracle_macro_f05, count(case when tp = n_true and n_true > 0 then 1 end) / count(case when n_true > 0 then 1 end) entities_fully_covered from ent""",
    "k_curve": f"with {_CURVE} select * from curve",
    "choose_k": f"with {_CURVE} select min(k) k from curve where pair_recall >= (select pair_recall from curve where k = 6) - 0.02",
    "prune_threshold": f"with {_S}, pos as (select p, row_number() over (order by p) - 1 i, count(*) over () n from s join y using (s1_id, t_id)) select coalesce(least(min(p), 0.5), 0.0) threshold from pos where i = floor(0.1 * n)",
    "error_examples": f"""with {_S}, {_expected('1.0', '1.0')}, lab as (select ef.*, y.t_id is not null hit from ef left join y using (s1_id, t_id))
 select * from (select 'false_positive' as type, s1_id, t_id, p from lab where sel and not hit order by p desc, s1_id, t_id limit 40) union all select * from (select 'false_negative', s1_id, t_id, p from lab where hit and not sel order by p, s1_id, t_id limit 40)""",
    "policy_grid": f"with {_GRID} select g.*, macro_f05, macro_precision, macro_recall from gr join g using (policy_id)",
    "best_policy": f"with {_GRID} select policy_id, macro_f05 from gr order by round(macro_f05, 12) desc, policy_id limit 1",
    "labels": f"with {_S} select s.*, y.t_id is not null hit from s left join y using (s1_id, t_id)",
    "known_truth": "select count(*) n_truth, count(case when s_suppkey is null then 1 end) n_unknown_targets from (select l_orderkey, l_suppkey from lineitem where cast(l_tax as double) <= 0.03) join orders on o_orderkey = l_orderkey left join (select s_suppkey from supplier where s_nationkey < 12) on s_suppkey = l_suppkey",
}
QUERIES = {f.__name__: f for f in (rank_within, topk, competition, group_ctx, other_best, decode_threshold, decode_expected_f, exclusivity, macro_f05, block_stats, k_curve, choose_k, prune_threshold, error_examples, policy_grid, best_policy, labels, known_truth)}
