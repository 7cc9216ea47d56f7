from pairloom.operators import metrics
from pairloom.plans import pipeline, synthetic
from pairloom.plans.config import Config
from pairloom.plans.tracking import Tracker
from pairloom.sources import files
from pyspark.sql import functions as F

POLICIES = [{"kind": "threshold", "t_top": a, "t_rest": b, "exclusive": False} for a, b in ((0.4, 0.5), (0.5, 0.6))] + [{"kind": "expected_f", "alpha": 1.0, "empty_bias": b, "exclusive": x} for b in (0.8, 1.5) for x in (False, True)]


def test_train_predict_and_score(spark, tmp_path):
    synthetic.generate(spark, str(tmp_path / "data"), 300, "train")
    truth = synthetic.generate(spark, str(tmp_path / "data"), 200, "test", ["India", "US", "France"])
    cfg = Config(data_dir=str(tmp_path / "data"), out_dir=str(tmp_path / "out"), work_dir=str(tmp_path / "work"), k_max=6, k_wide=12, n_folds=2, rounds=4, pruner_rounds=2, depth=4)
    tracker = Tracker(str(tmp_path / "out" / "run_log.json"))
    made = pipeline.train(spark, cfg, tracker, POLICIES)
    assert 1 <= made["k"] <= 6
    assert pipeline.predict(spark, cfg, tracker).collect() == []
    got = files.read_lists(spark, f"{cfg.out_dir}/matching_results.tsv", "matched_entity_ids")
    score = metrics.macro_f05(got.select("s1_id", F.explode("ids").alias("t_id")), truth, got).first()
    assert score["n_entities"] == 200 and score["macro_f05"] > 0.85
    text = pipeline.report(files.read_json(str(tmp_path / "out" / "run_log.json")))
    assert "macro_f05" in text and "nan" not in text
