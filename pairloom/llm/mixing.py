"""Documents drawn by a budget that is handed down a tree: total, then level by level to the leaves, then documents."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.session import Workspace

#: Where the public vocabulary lies; a parameter of every operator here.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how texts are cut before byte pairs are merged, as published with that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokens(text: Column, path: str = TOKENIZER) -> Column:
    """Number of tokens of a text in the byte-pair vocabulary at path; 0 for null and empty texts."""

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        e = _encoding(path)
        return pd.Series([len(e.encode_ordinary(t)) if isinstance(t, str) else 0 for t in texts], dtype="int64")

    return count(text)


def fill(budget: float, children: list[tuple[float, float]]) -> list[float]:
    """Parts of budget for (weight, capacity) children: in proportion to weights; what one cannot take goes to the others."""
    parts, open_ = [0.0] * len(children), {i for i, (w, c) in enumerate(children) if w > 0 and c > 0}
    left = budget
    while open_ and left > 1e-9:
        total = sum(children[i][0] for i in open_)
        full = {i for i in open_ if children[i][1] - parts[i] <= left * children[i][0] / total}
        if not full:
            for i in open_:
                parts[i] += left * children[i][0] / total
            break
        for i in full:
            left -= children[i][1] - parts[i]
            parts[i] = children[i][1]
        open_ -= full
    return parts


def budgets(leaves: dict[tuple, tuple[float, float]], weights: dict[tuple, float], total: float) -> dict[tuple, float]:
    """Path of each leaf to its budget. leaves: path to (tokens held, capacity); weights: path of a node to its weight.

    A node without a weight weighs what it holds. Every node's capacity is that of its leaves, so a leaf that falls
    short is made good by its siblings as long as they can, then by the siblings of its parent, and so on upwards.
    """
    out: dict[tuple, float] = {}

    def down(path: tuple, budget: float) -> None:
        if path in leaves:
            out[path] = budget
            return
        below = sorted({p[: len(path) + 1] for p in leaves if p[: len(path)] == path}, key=str)
        held = [sum(h for p, (h, _) in leaves.items() if p[: len(b)] == b) for b in below]
        room = [sum(c for p, (_, c) in leaves.items() if p[: len(b)] == b) for b in below]
        for b, part in zip(below, fill(budget, [(weights.get(b, h), c) for b, h, c in zip(below, held, room)])):
            down(b, part)

    if leaves:
        down((), total)
    return out


def draw(
    spark: SparkSession, docs: DataFrame, doc_id: str, levels: list[str], text: str, targets: DataFrame, seed: int = 7, total: float | None = None,
    weights: dict[tuple, float] | None = None, tokenizer: str = TOKENIZER, bucket_rows: int = 1_000_000, most_leaves: int = 20_000,
) -> DataFrame:
    """(doc_id, the levels, n_tokens, repeats) of the documents used; repeats never exceeds max_repeats of the source.

    levels: columns from the top of the tree to its leaves, such as source, language, kernel. targets: (levels[0],
    target_share, max_repeats) for the nodes of the top level; weights: for nodes below it, by path; without one a node
    weighs the tokens it holds. total: tokens to draw; None for the most at which every target_share can be kept. Where
    total is more than that, shortages are made good by siblings first, then by the siblings of the parent.

    A leaf's part is dealt in seeded epochs: each epoch orders the leaf's documents anew; whole epochs take all of
    them, the last one those of its token prefix. Rounding to whole documents is made good by the one document of the
    top node whose length comes nearest to what is missing or too much. Running sums go over hash buckets, so that no
    leaf is ordered in one task. The driver sees one row a leaf, at most most_leaves (an error beyond); the levels are
    categories, whose number does not follow the rows.

    Documents of no target, without text or without tokens are not drawn; null levels below the top are a node of their
    own. The top level is compared without blanks at its ends. An empty table gives an empty result.
    """
    ws = Workspace(spark, "mix")
    top, weights = levels[0], dict(weights or {})
    names = [F.trim(f"`{top}`").alias(top), *[F.col(f"`{c}`").cast("string").alias(c) for c in levels[1:]]]
    aims = {r[top]: (r["target_share"], r["max_repeats"]) for r in targets.collect()}
    wanted = docs.where(F.trim(f"`{top}`").isin(list(aims)))
    sized = ws.write(wanted.select(F.col(f"`{doc_id}`").alias("doc_id"), *names, tokens(F.col(f"`{text}`"), tokenizer).alias("n_tokens")).where("n_tokens > 0"), "sized")
    held = sized.groupBy(*levels).agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n")).limit(most_leaves + 1).collect()
    if len(held) > most_leaves:
        raise ValueError(f"the tree has more than {most_leaves} leaves")
    path = lambda r: tuple(r[c] for c in levels)
    leaves = {path(r): (float(r["t"]), float(r["t"]) * aims[r[top]][1]) for r in held}
    weights |= {(s,): share for s, (share, _) in aims.items()}
    if total is None:
        room = {s: sum(c for p, (_, c) in leaves.items() if p[0] == s) for s in {p[0] for p in leaves}}
        total = min((room[s] / aims[s][0] for s in room if aims[s][0] > 0), default=0.0) * sum(aims[s][0] for s in room)
    plan = budgets(leaves, weights, total)
    rules, budget_of = [], {}
    for i, r in enumerate(held):
        budget, t, most = plan.get(path(r), 0.0), float(r["t"]), aims[r[top]][1]
        passes = min(int((budget + 1e-6) // t), most)
        rules.append((*path(r), i, passes, max(0.0, budget - passes * t), 4 * -(-r["n"] // bucket_rows), most))
        budget_of[r[top]] = budget_of.get(r[top], 0.0) + budget
    kinds = ", ".join(f"`{c}` string" for c in levels)
    rule = spark.createDataFrame(rules, f"{kinds}, leaf int, passes int, rest double, buckets int, most int")
    same = None
    for c in levels:
        e = sized[c].eqNullSafe(rule[c])
        same = e if same is None else same & e
    x = sized.join(F.broadcast(rule), same).select(sized["*"], "leaf", "passes", "rest", "buckets", "most")
    x = x.withColumn("h", F.xxhash64("doc_id", F.lit(seed), "passes")).withColumn("b", F.pmod(F.shiftright("h", 8), F.col("buckets")))
    per = x.groupBy("leaf", "b").agg(F.sum("n_tokens").alias("t"))
    before = Window.partitionBy("leaf").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("leaf", "b", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    w = Window.partitionBy("leaf", "b").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    run = x.join(base, ["leaf", "b"]).withColumn("upto", F.col("base") + F.sum("n_tokens").over(w))
    more = F.when(F.col("passes") < F.col("most"), (F.col("upto") - F.col("n_tokens") / 2 <= F.col("rest")).cast("int")).otherwise(0)
    dealt = ws.write(run.select("doc_id", *levels, "n_tokens", "passes", "most", more.alias("more")), "dealt")
    # what whole documents leave missing or too much at a top node
    got = dealt.groupBy(top).agg(F.sum((F.col("passes") + F.col("more")) * F.col("n_tokens")).alias("got"))
    aim = spark.createDataFrame(list(budget_of.items()), f"`{top}` string, budget double")
    gap = aim.join(got, top).select(top, (F.col("budget") - F.col("got")).alias("gap"))
    off = F.abs(F.col("n_tokens") - F.abs("gap"))
    able = F.when(F.col("gap") > 0, (F.col("more") == 0) & (F.col("passes") < F.col("most"))).otherwise(F.col("more") == 1)
    turned = dealt.join(F.broadcast(gap), top).where(able & (off < F.abs("gap"))).groupBy(top).agg(F.min(F.struct(off.alias("off"), "doc_id")).alias("k"))
    turned = turned.select(F.col(top), F.col("k.doc_id").alias("turned"))
    out = dealt.join(F.broadcast(turned), top, "left").withColumn("more", F.when(F.col("doc_id") == F.col("turned"), 1 - F.col("more")).otherwise(F.col("more")))
    return out.withColumn("repeats", F.col("passes") + F.col("more")).where("repeats > 0").select("doc_id", *levels, "n_tokens", "repeats")


def shares(drawn: DataFrame, targets: DataFrame, top: str = "source") -> DataFrame:
    """(top, target_share, n_documents, most_repeats, tokens, share): every node of targets, with what it contributes."""
    per = drawn.groupBy(top).agg(F.count(F.lit(1)).alias("n_documents"), F.max("repeats").alias("most_repeats"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"))
    out = targets.select(top, "target_share").join(F.broadcast(per), top, "left")
    all_ = F.sum(F.coalesce("tokens", F.lit(0))).over(Window.partitionBy())
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select(top, "target_share", zero("n_documents"), zero("most_repeats"), zero("tokens"), (F.coalesce("tokens", F.lit(0)) / F.nullif(all_, F.lit(0))).alias("share"))
