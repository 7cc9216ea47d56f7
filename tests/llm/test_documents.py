import pytest

from pairloom.llm import encoding, mixing, passages

ITEM = "Write a function that muted rudder prunes each crimson kiln until no spool remains unmatched today"


def test_p8_passages(spark):
    twelve = ITEM.split()[3:15]
    docs = [
        (1, "# Note\n# " + "\n# ".join(w.upper() + ("," if i % 2 else "") for i, w in enumerate(twelve))),
        (2, '{"cells": [{"source": ["' + '\\n", "# '.join(twelve) + '"]}]}'),
        (3, " ".join(f"<b>{w[:1]}</b>{w[1:]}" if i == 4 else w for i, w in enumerate(twelve))),
        (4, " ".join(twelve[:11]) + " other words"),
        (5, None),
    ]
    near = ITEM.split()[3:15]
    near[5] = "other"
    docs += [(6, " ".join(near + ITEM.split()[15:16])), (6, "")]
    items = spark.createDataFrame([(9, ITEM), (10, None), (11, "too short")], "item_id long, text string")
    got = passages.passages(spark, spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", items, "item_id", "text")
    assert sorted((r["doc_id"], r["item_id"], r["kind"]) for r in got.collect()) == [(1, 9, "exact"), (2, 9, "exact"), (3, 9, "exact"), (6, 9, "proximity")]


def test_p8_all_terms_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x " + ITEM, "clash")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    assert passages.passages(spark, docs, "doc_id", "text", items, "item_id", "text", most_terms=0).count() == 1
    assert passages.passages(spark, docs.limit(0), "doc_id", "text", items, "item_id", "text").isEmpty()
    assert passages.passages(spark, docs, "doc_id", "text", items.limit(0), "item_id", "text").isEmpty()


@pytest.mark.parametrize(("was", "read"), [("La señal añadió más", "cp1252"), ("Каждый датчик меняет", "cp1251"), ("naïve", "cp1252"), ("les étudiées", "mac_roman"), ("für Wärme", "cp437")])
def test_p10_utf8_read_as_another(was, read):
    assert encoding.repaired("x " + was.encode().decode(read)) == ("x " + was, True)


def test_p10_more():
    twice = "modèle étudié".encode().decode("cp1252").encode().decode("cp1252")
    assert encoding.repaired(twice) == ("modèle étudié", True)
    assert encoding.repaired("Каждый датчик объясняет число".encode("koi8_r").decode("cp1251"))[1]
    assert encoding.repaired("Ausrei�er ber�hrt")[1]


@pytest.mark.parametrize("text", ['accents = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖ"', "# Â e Ã no texto", "INTRODUÇÃO À ANÁLISE", "Старый столбец показывает НОВЫЕ ДАННЫЕ", "├────┬────┤ 12 µs ≈ 3 °C", "«СССР» Сёмин", "plain"])
def test_p10_sound_texts(text):
    assert encoding.repaired(text) == (text, False)


def test_p9_shares(spark):
    docs = spark.createDataFrame([(i, " a" if i % 4 else "b", "fr" if i % 3 else None, "w " * (5 + i % 7), i) for i in range(400)] + [(900, "c", "fr", "x", 1), (901, "a", "fr", None, 1), (902, None, "fr", "", 1)], "doc_id long, source string, lang string, text string, n_tokens int")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    drawn = mixing.draw(spark, docs, "doc_id", ["source", "lang"], "text", targets).cache()
    assert drawn.where("source = 'a' and repeats > 1 or repeats > 2 or doc_id >= 900").isEmpty()
    assert drawn.count() == drawn.select("doc_id").distinct().count()
    assert all(abs(r["share"] - 0.5) < 0.005 for r in mixing.shares(drawn, targets).collect())
    assert mixing.draw(spark, docs.limit(0), "doc_id", ["source", "lang"], "text", targets).isEmpty()


def test_p9_shortages_go_to_siblings_first():
    leaves = {("a", "x"): (10.0, 10.0), ("a", "y"): (30.0, 60.0), ("b", "x"): (100.0, 100.0)}
    got = mixing.budgets(leaves, {("a",): 0.5, ("b",): 0.5, ("a", "x"): 0.5, ("a", "y"): 0.5}, 80)
    assert got == {("a", "x"): 10.0, ("a", "y"): 30.0, ("b", "x"): 40.0}
    got = mixing.budgets(leaves, {("a",): 0.5, ("b",): 0.5}, 160)
    assert got == {("a", "x"): 10.0, ("a", "y"): 60.0, ("b", "x"): 90.0}


def test_p9_tokens_are_those_of_the_vocabulary(spark):
    got = spark.createDataFrame([("hello world",), ("",), (None,)], "t string").select(mixing.tokens(mixing.F.col("t")).alias("n")).collect()
    assert [r["n"] for r in got] == [2, 0, 0]


def test_p10_nulls_empty_long_and_clashes(spark):
    long_ = "x " * 100_000 + "La se\u00c3\u00b1al"
    df = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, "plain", "c"), (4, long_, "c"), (4, long_, "c")], "doc_id long, text string, garbled string")
    got = df.select("doc_id", encoding.repair(mixing.F.col("text")).alias("r")).select("doc_id", "r.garbled", "r.original").collect()
    assert sorted((r["doc_id"], r["garbled"]) for r in got) == [(1, False), (2, False), (3, False), (4, True), (4, True)]
    assert got[0]["original"] is None and next(r for r in got if r["doc_id"] == 4)["original"].endswith("La señal")
    assert df.limit(0).select(encoding.repair(mixing.F.col("text")).alias("r")).isEmpty()


def test_p10_cost_falls_with_each_repair():
    for was, read in (("señal", "cp1252"), ("Каждый", "cp1251"), ("naïve", "mac_roman")):
        assert encoding.garbling_cost(was) < encoding.garbling_cost(was.encode().decode(read))
