"""The whole flow: sources, views, candidates, pruner, features, two stages of models, decoder, result files."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from pairloom.functions.normalise import normalise
from pairloom.operators import blocking, decoders, features, metrics, model, profile
from pairloom.plans.config import Config
from pairloom.plans.tracking import Tracker
from pairloom.session import Workspace
from pairloom.sources import files

STAGE1 = [*features.BLOCK, "p0", *features.PAIR]
STAGE2 = [*STAGE1, *features.CONTEXT]


def load_split(spark: SparkSession, cfg: Config, split: str) -> tuple[DataFrame, DataFrame]:
    """(source 1, targets) normalised, one row an id, kept as Parquet in the work folder."""
    order = ["source", "business_name", "business_address", "country"]

    def make(ns: tuple[int, ...]) -> DataFrame:
        raw = files.read_source(spark, cfg.data_dir, split, ns[0])
        for n in ns[1:]:
            raw = raw.unionByName(files.read_source(spark, cfg.data_dir, split, n))
        return normalise(blocking.dedup_first(raw, "entity_id", order))

    return tuple(files.cached(spark, f"{cfg.work_dir}/{split}_{name}", lambda ns=ns: make(ns)) for name, ns in (("source1", (1,)), ("targets", (2, 3))))


def _candidates(cfg: Config, s1: DataFrame, t: DataFrame, scope: bool, k_max: int) -> DataFrame:
    c = blocking.generate_candidates(s1, t, "country" if scope else None, cfg.key_df_cap, cfg.k_wide, k_max)
    if cfg.rerank_margin is not None:
        best = F.max("rerank").over(Window.partitionBy("s1_id", "t_source"))
        c = c.withColumn("__best", best).where(F.col("rerank") >= F.col("__best") - cfg.rerank_margin).drop("__best")
    return c


def train(spark: SparkSession, cfg: Config, tracker: Tracker | None = None, policies: list[dict] | None = None) -> dict:
    """Fits everything on the train split; returns what predict needs and writes it to the work folder."""
    tr = tracker or Tracker()
    ws = Workspace(spark, "train")
    with tr.stage("load"):
        s1, t = load_split(spark, cfg, "train")
        lists = files.read_ground_truth(spark, cfg.data_dir)
        universe = ws.write(lists.select("s1_id").distinct().join(s1.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi"), "universe")
        listed = lists.where("t_id is not null").select("s1_id", "t_id")
        truth, unknown = metrics.known_truth(listed, universe, t.select(F.col("entity_id").alias("t_id")))
        truth = ws.write(truth, "truth")
        n_t = t.count()
    with tr.stage("profile"):
        row = profile.profile(s1, t, listed, lists.select("s1_id").distinct()).first().asDict()
        row["match_count_distribution"] = {r["n_matches"]: r["entities"] for r in profile.match_histogram(listed, lists).collect()}
        row["countries_source1"] = {r["country"]: r["count"] for r in s1.groupBy("country").count().orderBy(F.desc("count")).limit(50).collect()}
        tr.record("profile", row)
        tr.record("truth", unknown.first().asDict())
        choice = profile.decisions(row, cfg.exclusivity_max_violation)
        exclusive = {"on": (True,), "off": (False,)}.get(cfg.enforce_exclusivity, choice["exclusive"])
    with tr.stage("blocking"):
        cand = ws.write(_candidates(cfg, s1, t, choice["scope_country"], cfg.k_max), "candidates")
        curve = metrics.k_curve(cand, truth, universe, cfg.k_max, n_t)
        k = metrics.choose_k(curve, cfg.k_recall_tolerance).first()["k"] if cfg.k_final == "auto" else int(cfg.k_final)
        k = k or cfg.k_max
        tr.record("k_curve", [r.asDict() for r in curve.orderBy("k").collect()])
        tr.record("k", k)
        pairs = ws.write(metrics.labelled(features.finalise_candidates(cand, k), truth), "pairs")
        tr.record("blocking", metrics.blocking_stats(pairs, truth, universe, n_t).first().asDict())
    with tr.stage("pruner"):
        threshold, pruner = 0.0, None
        if cfg.use_pruner:
            scored, pruner, threshold, figures = model.fit_pruner(pairs, cfg.n_folds, cfg.pruner_rounds, 4, cfg.prune_tolerance, cfg.prune_max_threshold, cfg.seed, cfg.max_rows)
            pairs = ws.write(scored.where(F.col("p0") >= threshold), "pruned")
            tr.record("pruner", figures)
        else:
            pairs = pairs.withColumn("p0", F.lit(0.0))
    with tr.stage("features"):
        some = ws.write(model.competition_sample(pairs, cfg.train_seed_entities, cfg.train_max_entities, cfg.seed), "sample")
        quiet = universe.join(cand.select("s1_id").distinct(), "s1_id", "left_anti")
        scope = ws.write(some.join(universe, "s1_id", "left_semi").unionByName(quiet).distinct(), "scope")
        x1 = ws.write(features.pair_features(pairs.join(some, "s1_id", "left_semi"), s1, t), "features")
    with tr.stage("stage1"):
        oof1, m1, f1 = model.train_oof(x1, STAGE1, cfg.n_folds, cfg.rounds, cfg.depth, cfg.step, cfg.seed, cfg.max_rows, "p1")
        policies = decoders.candidate_policies(exclusive) if policies is None else [p for p in policies if p.get("exclusive", False) in exclusive]
        best1, score1, table1 = decoders.tune_policy(spark, oof1.withColumnRenamed("p1", "p"), truth, scope, policies)
    with tr.stage("stage2"):
        x2 = ws.write(features.add_context(oof1, t), "context")
        oof2, m2, f2 = model.train_oof(x2, STAGE2, cfg.n_folds, cfg.rounds, cfg.depth, cfg.step, cfg.seed + 7, cfg.max_rows, "p2")
        best2, score2, table2 = decoders.tune_policy(spark, oof2.withColumnRenamed("p2", "p"), truth, scope, policies)
    with tr.stage("report"):
        two = score2 >= score1
        best, oof = (best2, oof2.withColumn("p", F.col("p2"))) if two else (best1, oof1.withColumn("p", F.col("p1")))
        done = ws.write(decoders.apply_policy(oof, best), "decided")
        sel = done.where("sel")
        tr.record("oof", {"stage1": score1, "stage2": score2, "policy": best, "final": metrics.macro_f05(sel, truth, scope).first().asDict()})
        tr.record("errors", metrics.error_patterns(done).first().asDict())
        entities = s1.select(F.col("entity_id").alias("s1_id"), "country", "translit", "addr_missing").join(scope, "s1_id", "left_semi")
        tr.record("breakdown", [r.asDict() for r in metrics.error_breakdown(sel, truth, entities).collect()])
        tr.record("importance", model.importance(m2 if two else m1)[:15])
        files.write_tsv((table2 if two else table1).orderBy(F.desc("macro_f05"), "policy_id"), f"{cfg.work_dir}/policies", single=True)
        names = lambda df, key, pre: df.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"{pre}_name"), F.col("business_address").alias(f"{pre}_address"))
        examples = metrics.error_examples(done).join(names(s1, "s1_id", "s1"), "s1_id").join(names(t, "t_id", "cand"), "t_id")
        files.write_tsv(examples, f"{cfg.work_dir}/error_examples", single=True)
        for name, m in (("pruner", pruner), ("stage1", m1), ("stage2", m2)):
            if m is not None:
                m.write().overwrite().save(f"{cfg.work_dir}/model_{name}")
        artifacts = {"k": k, "scope_country": choice["scope_country"], "policy": best, "prune_threshold": threshold, "use_pruner": cfg.use_pruner, "use_stage2": two, "stage1_features": STAGE1, "stage2_features": STAGE2, "rounds": [f1, f2]}
        files.write_json(artifacts, f"{cfg.work_dir}/artifacts.json")
        files.write_json(cfg.as_dict(), f"{cfg.out_dir}/config.json")
    return artifacts


def predict(spark: SparkSession, cfg: Config, tracker: Tracker | None = None) -> DataFrame:
    """Writes candidates, scores and matches of the test split; returns the breaches found in them (none is right)."""
    tr = tracker or Tracker()
    a = files.read_json(f"{cfg.work_dir}/artifacts.json")
    load = lambda name: PipelineModel.load(f"{cfg.work_dir}/model_{name}")
    ws = Workspace(spark, "predict")
    with tr.stage("load test"):
        s1, t = load_split(spark, cfg, "test")
        ids = s1.select(F.col("entity_id").alias("s1_id"))
    with tr.stage("blocking test"):
        pairs = features.finalise_candidates(_candidates(cfg, s1, t, a["scope_country"], a["k"]), a["k"])
        pairs = ws.write(model.apply_pruner(load("pruner"), pairs, a["prune_threshold"]) if a["use_pruner"] else pairs.withColumn("p0", F.lit(0.0)), "pairs")
        files.write_tsv(files.id_lists(ids, pairs, "rerank", "candidate_entity_ids"), f"{cfg.out_dir}/candidate_pairs.tsv")
    with tr.stage("score test"):
        x = ws.write(model.predict(load("stage1"), features.pair_features(pairs, s1, t), "p1"), "stage1")
        x = model.predict(load("stage2"), features.add_context(x, t), "p") if a["use_stage2"] else x.withColumn("p", F.col("p1"))
        scored = ws.write(x.select("s1_id", "t_id", "p"), "scores")
        files.write_scores(scored, f"{cfg.out_dir}/scores")
    with tr.stage("decode test"):
        sel = decoders.apply_policy(scored, a["policy"]).where("sel")
        files.write_tsv(files.id_lists(ids, sel, "p", "matched_entity_ids"), f"{cfg.out_dir}/matching_results.tsv")
    with tr.stage("validate"):
        matches, cands = (files.read_tsv(spark, f"{cfg.out_dir}/{n}.tsv") for n in ("matching_results", "candidate_pairs"))
        return profile.validate(matches, cands, s1, t)


def report(log: dict) -> str:
    """The measured figures of a run as text; figures that were not measured read n/a."""
    num = lambda v, d=4: f"{v:.{d}f}" if isinstance(v, float) and v == v else str(v) if isinstance(v, int | str) else "n/a"
    m = log.get("metrics", {})
    lines = ["# Report", "", "| Stage | Seconds |", "|---|---|"] + [f"| {k} | {num(v['seconds'], 1)} |" for k, v in log.get("stages", {}).items()]
    for part in ("profile", "blocking", "pruner", "errors"):
        lines += ["", f"## {part}", "", *[f"- {k}: {num(v)}" for k, v in (m.get(part) or {}).items() if not isinstance(v, dict)]]
    if oof := m.get("oof"):
        lines += ["", "## Out of fold", "", f"- policy: {oof['policy']}", *[f"- {k}: {num(v)}" for k, v in oof["final"].items()]]
    if curve := m.get("k_curve"):
        lines += ["", "| K | recall | oracle F0.5 |", "|---|---|---|"] + [f"| {r['k']} | {num(r['pair_recall'])} | {num(r['oracle_macro_f05'])} |" for r in curve]
    if imp := m.get("importance"):
        total = sum(x[1] for x in imp) or 1.0
        lines += ["", "| Feature | share of the top |", "|---|---|"] + [f"| {n} | {num(g / total)} |" for n, g, _ in imp]
    if b := m.get("breakdown"):
        lines += ["", "| View | Value | Entities | F0.5 |", "|---|---|---|---|"] + [f"| {r['view']} | {r['value']} | {r['entities']} | {num(r['macro_f05'])} |" for r in b]
    return "\n".join(lines) + "\n"
