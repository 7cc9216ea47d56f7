import random
import re
from itertools import combinations

import pytest

from pairloom.functions import similarity as S
from pairloom.functions.normalise import VIEWS, normalise
from pairloom.operators import blocking, decoders, metrics, model, profile, ranking
from pairloom.queries import scoring
from pairloom.sources import files
from pyspark.sql import functions as F

GOLDEN = [
    (("Sharma Traders Pvt. Ltd.", "12 M.G. Rd, Bangalore 560001"), {"name_core": "sharma traders", "postal": "560001"}),
    (("Café Crème SARL", "5 av. Foch"), {"name_core": "cafe creme", "name_norm": "cafe creme sarl", "addr_norm": "5 avenue foch", "translit": 0}),
    (("शर्मा ट्रेडर्स प्राइवेट लिमिटेड", None), {"translit": 1, "addr_missing": 1}),
    (("X", "None"), {"addr_missing": 1, "addr_norm": ""}), ((None, "null"), {"name_norm": "", "name_core": "", "addr_missing": 1}), (("", ""), {"name_norm": "", "nums": ""}),
    (("A", "Plot-12, AF-0684, 007 Indiana"), {"nums": "0684 12 684 7".replace("0684 ", ""), "codes": "af0684"}),
    (("The", "1st Saint Lane"), {"name_core": "the", "addr_norm": "1 street lane"}),
]


def test_normalise_goldens(spark):
    df = spark.createDataFrame([(i, n, a, "clash") for i, ((n, a), _) in enumerate(GOLDEN)], "id int, business_name string, business_address string, nums string")
    rows = {r["id"]: r.asDict() for r in normalise(df).collect()}
    for i, (_, want) in enumerate(GOLDEN):
        assert {k: rows[i][k] for k in want} == want, GOLDEN[i]
    assert "limited" not in rows[2]["name_core"] and rows[2]["name_core"].isascii()
    assert "bengaluru" in rows[0]["addr_norm"] and "road" in rows[0]["addr_norm"]
    assert normalise(df.limit(0)).columns[-len(VIEWS):] and normalise(df.limit(0)).isEmpty()


def test_sounds_meet(spark):
    df = spark.createDataFrame([("lakshmi foods", ""), ("laxmi foods", ""), ("Acme Praivet Limitad", "")], "business_name string, business_address string")
    a, b, c = normalise(df).collect()
    assert a["name_phon"] == b["name_phon"] and c["name_core"] == "acme"


def _slow_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_similarities_against_brute_force():
    r = random.Random(5)
    texts = ["".join(r.choice("ab c") for _ in range(r.randrange(12))) for _ in range(60)] + [""]
    for a, b in combinations(texts, 2):
        assert S.lcs_length(a, b) == _slow_lcs(a, b)
        if a and b:
            short, long_ = sorted((a, b), key=len)
            n = len(short)
            stretches = {long_[max(0, i): i + n] for i in range(1 - n, len(long_))} - {""}
            if len(a) == len(b):
                want = max([S.ratio(short, x) for x in stretches] + [S.ratio(long_, short[max(0, i): i + n]) for i in range(1 - n, n)])
            else:
                want = max(S.ratio(short, x) for x in stretches)
            assert S.partial_ratio(a, b) == pytest.approx(want)
    assert S.token_set_ratio("a b", "b a c") == 100 and S.token_set_ratio("", "a") == 0 and S.token_sort_ratio("b a", "a b") == 100
    assert S.partial_token_set_ratio("x y", "y z") == 100 and S.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert S.ratio("", "") == 100 and S.jaro_winkler("", "a") == 0


def test_left_over_keeps_repeats(spark):
    got = spark.createDataFrame([(["a", "a", "b"], ["a"])], "x array<string>, y array<string>").select(S.left_over(F.col("x"), F.col("y")).alias("m"), S.left_over(F.col("y"), F.col("x")).alias("l")).first()
    assert got["m"] == ["a", "b"] and got["l"] == []


SCORED = [("a", "x", 0.9), ("a", "y", 0.8), ("a", "z", 0.1), ("b", "x", 0.3), ("b", "w", 0.2)]


def test_policies_share_one_sort_of_the_pairs(spark):
    pairs = [(a, t, ((7 * i) % 19) / 20) for i, (a, t) in enumerate((a, t) for a in range(12) for t in range(5))]
    df = spark.createDataFrame([*pairs, (3, 9, None), (None, 2, 0.9)], "s1_id int, t_id int, p double")
    truth = spark.createDataFrame([(a, a % 5) for a in range(9)], "s1_id int, t_id int")
    universe = spark.createDataFrame([(a,) for a in range(14)], "s1_id int")
    policies = decoders.candidate_policies()[::23]
    got = decoders.score_policies(spark, df, truth, universe, policies)
    rows = {r["policy_id"]: r for r in got.collect()}
    for i in (0, 9, 13, 17, 22, 26):
        one = metrics.macro_f05(decoders.apply_policy(df, policies[i]).where("sel"), truth, universe).first()
        assert all(rows[i][c] == pytest.approx(one[c]) for c in ("macro_f05", "macro_precision", "macro_recall"))
    assert len(rows) == len(policies)
    # no shuffle of a row for each pair and policy
    assert not re.search(r"hashpartitioning\(policy_id#\d+, [st]", got._jdf.queryExecution().executedPlan().toString())


def test_best_policy_of_equal_scores_is_the_first(spark, monkeypatch):
    grid = spark.createDataFrame([(4, 0.1 + 0.2), (2, 0.3), (1, 0.2)], "policy_id int, macro_f05 double")
    monkeypatch.setattr(scoring, "policy_grid", lambda spark, d: grid)
    assert [r["policy_id"] for r in scoring.best_policy(spark, "").collect()] == [2]


def test_decoders(spark):
    df = spark.createDataFrame(SCORED, "s1_id string, t_id string, p double")
    sel = lambda d: {(r["s1_id"], r["t_id"]) for r in d.where("sel").collect()}
    assert sel(decoders.decode_threshold(df, 0.5, 0.7)) == {("a", "x"), ("a", "y")}
    assert sel(decoders.decode_expected_f(df)) == {("a", "x"), ("a", "y")}
    assert sel(decoders.enforce_exclusivity(decoders.decode_threshold(df, 0.2, 0.2))) == {("a", "x"), ("a", "y"), ("b", "w")}
    assert len(decoders.candidate_policies()) == 616 and decoders.decode_expected_f(df.limit(0)).isEmpty()
    truth = spark.createDataFrame([("a", "x"), ("a", "y")], "s1_id string, t_id string")
    best, score, table = decoders.tune_policy(spark, df, truth, spark.createDataFrame([("a",), ("b",), ("c",)], "s1_id string"), decoders.candidate_policies()[::40])
    assert score == 1.0 and table.count() == 16 and best in decoders.candidate_policies()


def test_metrics(spark):
    f = lambda rows: spark.createDataFrame(rows, "s1_id string, t_id string")
    u = spark.createDataFrame([("a",), ("b",), ("c",)], "s1_id string")
    assert metrics.macro_f05(f([("a", "x"), ("a", "y"), ("a", "z")]), f([("a", "x"), ("a", "y")]), u.limit(1)).first()["macro_f05"] == pytest.approx(0.7142857, abs=1e-6)
    one = metrics.macro_f05(f([("b", "x"), ("b", "x")]), f([("a", "x"), ("a", "x")]), u).first()
    assert (one["macro_f05"], one["f05_singletons"], one["n_singletons"], one["n_pred_pairs"]) == (pytest.approx(1 / 3), 0.5, 2, 1)
    none = metrics.macro_f05(f([]), f([]), u.limit(0)).first()
    assert none["n_entities"] == 0 and none["macro_f05"] is None
    s = spark.createDataFrame([(i / 10, i % 2 == 0) for i in range(10)], "p double, hit boolean")
    assert metrics.prune_threshold(s, 0.3).first()["threshold"] == 0.2 and metrics.prune_threshold(s.limit(0), 0.3).first()["threshold"] == 0.0


def test_ranks_and_context_ties(spark):
    df = spark.createDataFrame([*SCORED, ("c", "x", 0.3), ("c", "q", None)], "s1_id string, t_id string, p double")
    got = {(r["s1_id"], r["t_id"]): r for r in ranking.competition(df, "p", "b").collect()}
    assert got["a", "x"]["b_t_margin"] == pytest.approx(0.6) and got["b", "x"]["b_t_rank"] == 1 and got["c", "x"]["b_t_rank"] == 2 and got["b", "w"]["b_t_margin"] == 1.0
    assert {(r["s1_id"], r["t_id"]): r["other_t"] for r in ranking.other_best(df, "p").collect()}["a", "x"] == "y"
    assert ranking.top_k(df, ["s1_id"], "p", 1).count() == 3


def test_candidates_and_caps(spark):
    rows = [(f"S2-{i}", "hot name", f"{i} long street", "X", 2) for i in range(30)] + [("S3-1", "rare thing", "500 oak road", "X", 3), ("S3-2", None, None, None, 3)]
    t = normalise(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, source int"))
    s1 = normalise(spark.createDataFrame([("S1-1", "rare thing", "500 oak rd", "X"), ("S1-2", "hot name", "", "X"), ("S1-3", "", None, None)], "entity_id string, business_name string, business_address string, country string"))
    c = blocking.generate_candidates(s1, t, df_cap=None, k_wide=50, k_max=3)
    assert {r["t_id"] for r in c.where("s1_id = 'S1-1' and t_source = 3").collect()} == {"S3-1"} and c.where("s1_id = 'S1-2'").count() == 3
    assert blocking.generate_candidates(s1, t, df_cap=10, k_wide=50, k_max=3).where("s1_id = 'S1-2'").isEmpty()
    assert blocking.generate_candidates(s1.limit(0), t).isEmpty()
    assert blocking.dedup_first(t.unionByName(t), "entity_id", ["source", "business_name"]).count() == 32


def test_lists_and_validation(spark, tmp_path):
    lists = spark.createDataFrame([("S1-1", "S2-1,S2-1, S3-1"), ("S1-1", None), ("S1-9", "X-1,S2-7,")], "source1_entity_id string, matched_entity_ids string")
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "entity_id string")
    got = sorted((r["rule"], r["source1_entity_id"], r["id"] or "") for r in profile.list_errors(lists, ids("S1-1", "S1-2"), ids("S2-1", "S3-1"), "matched_entity_ids").collect())
    assert got == sorted([("blank_id", "S1-1", " S3-1"), ("blank_id", "S1-9", ""), ("duplicate_id", "S1-1", "S2-1"), ("duplicate_row", "S1-1", ""), ("missing_source1", "S1-2", ""), ("unknown_source1", "S1-9", ""), ("unknown_target", "S1-9", "S2-7"), ("wrong_prefix", "S1-1", " S3-1"), ("wrong_prefix", "S1-9", ""), ("wrong_prefix", "S1-9", "X-1")])
    rows = [('S1-1', 'a "b" \\ c', " x ", "NA"), ("S1-2", "", "null", "")]
    files.write_tsv(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"), f"{tmp_path}/t/t_source1.tsv")
    assert sorted(tuple(r)[:4] for r in files.read_source(spark, str(tmp_path), "t", 1).collect()) == rows
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string")
    pairs = spark.createDataFrame([("S1-1", "S2-1", 0.2), ("S1-1", "S3-1", 0.7), ("S1-1", "S2-1", 0.9)], "s1_id string, t_id string, p double")
    assert sorted(map(tuple, files.id_lists(s1, pairs, "p", "l").collect())) == [("S1-1", "S2-1,S3-1"), ("S1-2", "")]
    truth = files.truth_pairs(spark.createDataFrame([("a", "x, y,", 1), ("a", "z", 2), ("b", None, 1)], "source1_entity_id string, matched_entity_ids string, n int"), "n")
    assert sorted(map(tuple, truth.collect())) == [("a", 0, "z"), ("b", None, None)]


def test_folds_and_samples(spark):
    df = spark.range(1000).select(F.concat(F.lit("e"), F.col("id") % 100).alias("s1_id"), F.col("id").cast("string").alias("t_id"))
    folds = df.select("s1_id", model.group_folds("s1_id", 4, 1).alias("f")).distinct()
    assert folds.count() == 100 and folds.select("f").distinct().count() == 4
    assert model.sample_ids(df, "s1_id", 10, 3).collect() == model.sample_ids(df.repartition(7), "s1_id", 10, 3).collect()
    assert model.competition_sample(df, 10, 20).count() == 10
