import pytest

from pairloom.operators import packed, salted
from pyspark.sql import functions as F


@pytest.mark.parametrize(("cell", "delimiters", "want"), [
    ('a,"b,c",d', ",", ["a", "b,c", "d"]), ("O'Brien, Smith", packed.DELIMITERS, ["O'Brien", "Smith"]), ("O'Brien, 'x y', D'Arc", ",", ["O'Brien", "x y", "D'Arc"]),
    ('"""a"",""b, 4"""', packed.DELIMITERS, ["a", "b, 4"]), ("['x', 'y|z']", packed.DELIMITERS, ["x", "y|z"]), ("a \ue0000\ue001 b", packed.DELIMITERS, ["a", "\ue0000\ue001", "b"]),
    (None, ",", []), ("", ",", []), (" , ,", ",", []), ("a,a", ",", ["a", "a"]), ("a" * 50000 + ",b", ",", ["a" * 50000, "b"]),
])
def test_p3_split_packed(spark, cell, delimiters, want):
    got = spark.createDataFrame([(cell,)], "c string").select(packed.split_packed(F.col("c"), delimiters).alias("v")).first()["v"]
    assert got == want


def test_p3_positions_and_clash(spark):
    df = spark.createDataFrame([(1, "x;none;y", "k")], "id long, c string, v string")
    got = packed.explode_packed(df, "c", "w", keep="^[xy]$", carry=["id"]).collect()
    assert sorted(map(tuple, got)) == [(1, 1, "x"), (1, 2, "y")]
    with pytest.raises(ValueError):
        packed.explode_packed(df, "c", "v")


def test_p2_salted_against_plain(spark):
    rows = [("hot" if i % 3 else None if i % 5 == 0 else f"k{i % 40}", i % 17 if i % 7 else None, float(i), "clash") for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, x double, n string")
    aggs = [salted.Agg("n", "count"), salted.Agg("d", "count_distinct", "v"), salted.Agg("e", "count_distinct", "x"), salted.Agg("s", "sum", "x"), salted.Agg("lo", "min", "v"), salted.Agg("hi", "max", "v"), salted.Agg("m", "avg", "v")]
    got = {r["k"]: tuple(r)[1:] for r in salted.salted_aggregate(df, ["k"], aggs, heavy_share=0.05, salts=8).collect()}
    want = {r["k"]: tuple(r)[1:] for r in df.groupBy("k").agg(F.count(F.lit(1)), F.count_distinct("v"), F.count_distinct("x"), F.sum("x"), F.min("v"), F.max("v"), F.avg("v")).collect()}
    assert got == want
    assert salted.salted_aggregate(df.limit(0), ["k"], aggs).isEmpty()
    assert salted.heavy_keys(df, ["k"], 0.3, fraction=0.5).collect() == [("hot",)]


def test_p2_top_k(spark):
    df = spark.createDataFrame([("a", i) for i in range(100)] + [("b", 1), (None, 5), (None, 4)], "k string, v int")
    got = salted.salted_top_k(df, ["k"], [F.asc("v")], 2).select("k", "v", "rank").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", 0, 1), ("a", 1, 2), ("b", 1, 1), (None, 4, 1), (None, 5, 2)], key=str)
