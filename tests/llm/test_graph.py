import random

import pytest

from pairloom.llm import graph


def _groups(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for x in list(up)}


def _frame(spark, edges):
    return spark.createDataFrame([(a, b, "clash") for a, b in edges], "a string, b string, group_id string")


def _random(seed, n, m):
    r = random.Random(seed)
    return [(f"v{r.randrange(n):04d}", f"v{r.randrange(n):04d}") for _ in range(m)]


HUB = [("hub", f"s{i:03d}") for i in range(150)] + [(f"s{i:03d}", f"t{i:03d}") for i in range(100)]
CASES = {"random": _random(1, 120, 90), "giant": HUB + _random(2, 60, 30), "none": [(None, "x"), ("y", "y"), ("z", None)]}


@pytest.mark.parametrize("case", CASES)
def test_p1_groups_against_brute_force(spark, case):
    edges = CASES[case]
    want = _groups([e for e in edges if None not in e and e[0] != e[1]])
    got = {r["record_id"]: r["group_id"] for r in graph.connected_groups(spark, _frame(spark, edges), "a", "b").collect()}
    assert got == want


def test_p1_chain_of_rising_ids_takes_few_rounds(spark):
    edges = [(f"c{i:05d}", f"c{i + 1:05d}") for i in range(1024)]
    stats = {}
    got = graph.connected_groups(spark, _frame(spark, edges), "a", "b", bfs_levels=2, stats=stats).collect()
    assert len(got) == 1025 and {r["group_id"] for r in got} == {"c00000"}
    assert stats["rounds"] <= 12


def test_p7_forest_and_splits(spark):
    edges = HUB + _random(3, 200, 150)
    forest, roots = graph.spanning_forest(spark, _frame(spark, edges), "a", "b")
    want = _groups([e for e in edges if e[0] != e[1]])
    trees = {}
    for r in roots.collect():
        trees.setdefault(r["root"], set()).add(r["v"])
    assert sorted(map(sorted, trees.values())) == sorted(sorted(x for x in want if want[x] == g) for g in set(want.values()))
    assert forest.count() == len(want) - len(trees)
    ids = sorted(want) + [f"lone{i}" for i in range(300)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(ids)] + [(1000, None), (None, None), (1001, "1000")], "gt_row long, e string")
    got = graph.group_splits(spark, rows, "gt_row", "e", roots, {"train": 0.5, "test": 0.5}).cache()
    assert got.count() == len(ids) + 3 and got.where("group_id is null or split_name is null").isEmpty()
    split = {r["e"]: r["split_name"] for r in got.collect()}
    assert all(len({split[v] for v in vs}) == 1 for vs in trees.values())
    assert got.where("gt_row in (1000, 1001)").select("group_id").distinct().count() == 2
    assert abs(got.where("split_name = 'train'").count() / got.count() - 0.5) < 0.01


def test_p7_no_edges_and_no_rows(spark):
    _, roots = graph.spanning_forest(spark, _frame(spark, []), "a", "b")
    rows = spark.createDataFrame([(1, "a")], "gt_row long, e string")
    assert graph.group_splits(spark, rows, "gt_row", "e", roots, {"train": 1.0}).count() == 1
    assert graph.group_splits(spark, rows.limit(0), "gt_row", "e", roots, {"train": 1.0}).isEmpty()
