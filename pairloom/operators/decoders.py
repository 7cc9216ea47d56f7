"""From probabilities of pairs (s1_id, t_id, p) to the set of matches of each entity, and the choice among policies."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.operators.metrics import f05

POLICY = "policy_id int, kind string, t_top double, t_rest double, alpha double, empty_bias double, exclusive boolean"


def _by(keys: list[str]) -> tuple:
    w = Window.partitionBy(*keys, "s1_id")
    return w, w.orderBy(F.desc("p"), "t_id")


def decode_threshold(df: DataFrame, t_top: float | Column, t_rest: float | Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """df with sel: the best pair of an entity from t_top on; others from t_rest on where the best one is selected."""
    w, o = _by(list(keys))
    top, rest = (x if isinstance(x, Column) else F.lit(x) for x in (t_top, t_rest))
    first = F.row_number().over(o) == 1
    return df.withColumn("sel", F.when(first, F.col("p") >= top).otherwise((F.col("p") >= rest) & (F.max("p").over(w) >= top)))


def decode_expected_f(df: DataFrame, alpha: float | Column = 1.0, empty_bias: float | Column = 1.0, keys: tuple[str, ...] = ()) -> DataFrame:
    """df with sel: the first k pairs of an entity, where k maximises the expected F0.5; none where none is likelier.

    With q = p ** alpha, S the sum of all q, S_k that of the k largest and P0 the chance that no pair is true, the
    expectation of k pairs is 1.25 S_k / (0.25 S / (1 - P0) + k); it must exceed empty_bias P0.
    """
    a, bias = (x if isinstance(x, Column) else F.lit(x) for x in (alpha, empty_bias))
    e = _expected_f(df, [a], keys)
    return e.withColumn("sel", _likely(0, bias)).select(*df.columns, "sel")


def _expected_f(df: DataFrame, alphas: list[Column], keys: tuple[str, ...] = ()) -> DataFrame:
    """df with __k, the place of a pair in its entity, and for the i-th power __none{i} (P0), __best{i} (the highest
    expectation) and __cut{i} (the k that has it). All powers share one sort."""
    w, o = _by(list(keys))
    run = o.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = range(len(alphas))
    e = df.withColumns({f"__q{i}": F.pow(F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("p"))), a) for i, a in enumerate(alphas)})
    e = e.withColumns({"__k": F.row_number().over(o)} | {f"__s{i}": F.sum(f"__q{i}").over(run) for i in each} | {f"__all{i}": F.sum(f"__q{i}").over(w) for i in each} | {f"__none{i}": F.exp(F.sum(F.log1p(-F.col(f"__q{i}"))).over(w)) for i in each})
    e = e.withColumns({f"__e{i}": 1.25 * F.col(f"__s{i}") / (0.25 * F.col(f"__all{i}") / F.greatest(1 - F.col(f"__none{i}"), F.lit(1e-9)) + F.col("__k")) for i in each})
    e = e.withColumns({f"__best{i}": F.max(f"__e{i}").over(w) for i in each})
    e = e.withColumns({f"__cut{i}": F.min(F.when(F.col(f"__e{i}") >= F.col(f"__best{i}") - 1e-12, F.col("__k"))).over(w) for i in each})
    return e.drop(*[f"__{c}{i}" for c in ("q", "s", "all", "e") for i in each])


def _likely(i: int, bias: Column) -> Column:
    """Whether a pair of _expected_f is selected by its i-th power."""
    return (F.col(f"__best{i}") > bias * F.col(f"__none{i}")) & (F.col("__k") <= F.col(f"__cut{i}"))


def enforce_exclusivity(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """df with sel left only at the entity of highest p among those that selected the same target."""
    w = Window.partitionBy(*keys, "t_id", "sel").orderBy(F.desc("p"), "s1_id")
    return df.withColumn("sel", F.col("sel") & (F.row_number().over(w) == 1))


def apply_policy(df: DataFrame, policy: dict) -> DataFrame:
    """df with sel by a policy of candidate_policies."""
    if policy["kind"] == "threshold":
        out = decode_threshold(df, policy["t_top"], policy["t_rest"])
    else:
        out = decode_expected_f(df, policy["alpha"], policy["empty_bias"])
    return enforce_exclusivity(out) if policy.get("exclusive") else out


def candidate_policies(exclusive: tuple[bool, ...] = (False, True)) -> list[dict]:
    """The grid: thresholds of 0.05 to 0.95 for the best and 0.2 to 0.95 for the others, at most 0.25 below; powers and
    biases of the expected F0.5. 308 for each of exclusive."""
    tops, rests = [round(0.05 * i, 3) for i in range(1, 20)], [round(0.05 * i, 3) for i in range(4, 20)]
    out = []
    for ex in exclusive:
        out += [{"kind": "threshold", "t_top": a, "t_rest": b, "exclusive": ex} for a, b in product(tops, rests) if b >= a - 0.25]
        out += [{"kind": "expected_f", "alpha": a, "empty_bias": b, "exclusive": ex} for a, b in product((0.7, 0.85, 1.0, 1.15, 1.3, 1.5), (0.4, 0.6, 0.8, 1.0, 1.2, 1.5, 2.0, 2.5, 3.0, 4.0))]
    return out


def score_policies(spark: SparkSession, scored: DataFrame, truth: DataFrame, universe: DataFrame, policies: list[dict]) -> DataFrame:
    """(policy_id and its parameters, macro_f05, macro_precision, macro_recall): all policies in one pass.

    Pairs are labelled once and sorted once by entity; a policy changes neither. What it selects follows from a few
    numbers of an entity, one set for each t_rest and each alpha of the list. Exclusive policies also need the targets:
    each pair goes to its target once with a bit for every policy that selects it. So no shuffle has a row for a pair
    and a policy. The policies, a list on the driver, are broadcast. policy_id is the place in the list.
    """
    rests = sorted({p["t_rest"] for p in policies if p["kind"] == "threshold"})
    alphas = sorted({p["alpha"] for p in policies if p["kind"] == "expected_f"})
    alone = [i for i, p in enumerate(policies) if p.get("exclusive")]
    rows = [
        (i, p["kind"], p.get("t_top"), p.get("t_rest"), p.get("alpha"), p.get("empty_bias"), bool(p.get("exclusive")), rests.index(p["t_rest"]) if p["kind"] == "threshold" else alphas.index(p["alpha"]), *(divmod(alone.index(i), BITS) if p.get("exclusive") else (None, None)))
        for i, p in enumerate(policies)
    ]
    grid = F.broadcast(spark.createDataFrame(rows, POLICY + ", of int, chunk int, bit int"))
    known = truth.select("s1_id", "t_id").distinct().withColumn("hit", F.lit(1))
    n_true = known.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_true"))
    ent = universe.select("s1_id").distinct().join(n_true, "s1_id", "left").fillna(0, ["n_true"])
    x = scored.select("s1_id", "t_id", "p").join(known, ["s1_id", "t_id"], "left").fillna(0, ["hit"])
    x = _expected_f(x.withColumn("__top", F.max("p").over(_by([])[0])), [F.lit(float(a)) for a in alphas])
    got = _plain_counts(x, ent, grid.where("not exclusive"), rests, alphas)
    if alone:
        got = got.unionByName(_exclusive_counts(x, ent, grid.where("exclusive"), [policies[i] for i in alone], alphas))
    # entities without a selected pair score 1 or 0 by their truth alone
    f = f05(F.col("tp"), F.col("n_pred"), F.col("n_true"))
    idle = F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)
    sums = got.groupBy("policy_id").agg(F.sum(f - idle).alias("df"), F.avg(F.col("tp") / F.col("n_pred")).alias("macro_precision"), F.sum(F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true"))).alias("r"))
    base = F.broadcast(ent.agg(F.count(F.lit(1)).alias("n"), F.sum(idle).alias("f0"), F.count_if(F.col("n_true") > 0).alias("nt")))
    out = grid.drop("of", "chunk", "bit").join(F.broadcast(sums), "policy_id", "left").crossJoin(base)
    return out.select(*grid.columns[:-3], ((F.col("f0") + F.coalesce("df", F.lit(0.0))) / F.col("n")).alias("macro_f05"), "macro_precision", (F.coalesce("r", F.lit(0.0)) / F.when(F.col("nt") > 0, F.col("nt"))).alias("macro_recall"))


#: Exclusive policies a long has bits for.
BITS = 60


def _plain_counts(x: DataFrame, ent: DataFrame, grid: DataFrame, rests: list[float], alphas: list[float]) -> DataFrame:
    """(policy_id, tp, n_pred, n_true) of entities with a selected pair, by policies that are not exclusive."""
    hits = lambda c: F.sum(F.when(c, F.col("hit")).otherwise(0))
    more = [(F.col("__k") > 1) & (F.col("p") >= b) for b in rests]
    sums = [F.max("__top").alias("top"), hits(F.col("__k") == 1).alias("first")]
    sums += [y for i, c in enumerate(more) for y in (F.count_if(c).alias(f"n{i}"), hits(c).alias(f"h{i}"))]
    sums += [y for i in range(len(alphas)) for y in (*(F.max(f"__{c}{i}").alias(f"{c}{i}") for c in ("none", "best", "cut")), hits(F.col("__k") <= F.col(f"__cut{i}")).alias(f"in{i}"))]
    lists = {"n": (rests, "bigint"), "h": (rests, "bigint"), "none": (alphas, "double"), "best": (alphas, "double"), "cut": (alphas, "bigint"), "in": (alphas, "bigint")}
    e = x.groupBy("s1_id").agg(*sums).select("s1_id", "top", "first", *[F.array(*[f"{c}{i}" for i in range(len(v))]).cast(f"array<{t}>").alias(f"{c}_") for c, (v, t) in lists.items()])
    at = lambda c: F.get(f"{c}_", F.col("of"))
    some, likely = F.col("top") >= F.col("t_top"), at("best") > F.col("empty_bias") * at("none")
    # an outer join, as an inner one would filter the pairs before their shuffle and the other counts could not share it
    y = e.join(ent, "s1_id", "left").crossJoin(grid)
    n_pred = F.when(F.col("n_true").isNull(), 0).when(F.col("kind") == "threshold", F.when(some, 1 + at("n"))).otherwise(F.when(likely, at("cut")))
    tp = F.when(F.col("kind") == "threshold", F.col("first") + at("h")).otherwise(at("in"))
    return y.select("policy_id", tp.alias("tp"), n_pred.cast("bigint").alias("n_pred"), "n_true").where("n_pred > 0")


def _exclusive_counts(x: DataFrame, ent: DataFrame, grid: DataFrame, policies: list[dict], alphas: list[float]) -> DataFrame:
    """The same by exclusive policies: a target goes to the first pair, in order of p, that a policy selects.

    In that order a pair's new bits are those that no pair before it has.
    """
    masks = []
    for c in range(0, len(policies), BITS):
        m = F.lit(0).cast("bigint")
        for b, p in enumerate(policies[c : c + BITS]):
            if p["kind"] == "threshold":
                sel = F.when(F.col("__k") == 1, F.col("p") >= p["t_top"]).otherwise((F.col("p") >= p["t_rest"]) & (F.col("__top") >= p["t_top"]))
            else:
                sel = _likely(alphas.index(p["alpha"]), F.lit(p["empty_bias"]))
            m = m.bitwiseOR(F.when(sel, F.lit(1 << b).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        masks.append(m.alias(f"m{c // BITS}"))
    each = range(len(masks))
    rows = x.select("s1_id", "t_id", "p", "hit", *masks).where(" or ".join(f"m{i} <> 0" for i in each))
    before = Window.partitionBy("t_id").orderBy(F.desc("p"), "s1_id").rowsBetween(Window.unboundedPreceding, -1)
    new = rows.withColumns({f"m{i}": F.col(f"m{i}").bitwiseAND(F.bitwise_not(F.coalesce(F.bit_or(f"m{i}").over(before), F.lit(0).cast("bigint")))) for i in each})
    won = new.where(" or ".join(f"m{i} <> 0" for i in each)).select("s1_id", "hit", F.array(*[f"m{i}" for i in each]).alias("m"))
    # pairs come to their entity before they are taken apart by policy
    y = won.repartition("s1_id").join(ent, "s1_id").join(grid, F.expr("getbit(get(m, chunk), bit) = 1"))
    return y.groupBy("s1_id", "policy_id", "n_true").agg(F.sum("hit").alias("tp"), F.count(F.lit(1)).alias("n_pred")).select("policy_id", "tp", "n_pred", "n_true")


def tune_policy(spark: SparkSession, scored: DataFrame, truth: DataFrame, universe: DataFrame, policies: list[dict] | None = None) -> tuple[dict, float, DataFrame]:
    """(best policy, its macro F0.5, table of all policies). The first best wins; a later one must be better by 1e-12."""
    policies = candidate_policies() if policies is None else policies
    table = score_policies(spark, scored, truth, universe, policies)
    best, most = None, -1.0
    for r in sorted(table.select("policy_id", "macro_f05").collect(), key=lambda r: r["policy_id"]):  # one row a policy
        if r["macro_f05"] is not None and r["macro_f05"] > most + 1e-12:
            best, most = policies[r["policy_id"]], r["macro_f05"]
    return best, most, table
