"""Groups of records from pairwise matches, and splits that keep groups together.

Joins that follow a label (a hub, or the label of a large component) have one row a label on one side; the other side
may hold most rows under one label, and adaptive execution splits it (spark.sql.adaptive.skewJoin). Aggregates are
combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.session import Workspace


def _clean_edges(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Each undirected edge once, smaller id first; nulls and self-links left out."""
    e = edges.select(F.col(f"`{a}`").cast("string").alias("x"), F.col(f"`{b}`").cast("string").alias("y"))
    e = e.where(F.col("x").isNotNull() & F.col("y").isNotNull() & (F.col("x") != F.col("y")))
    return e.select(F.least("x", "y").alias("src"), F.greatest("x", "y").alias("dst")).distinct()


def _both_ways(e: DataFrame) -> DataFrame:
    """Each edge from either end; one pass over e."""
    ends = F.array(F.struct(F.col("src"), F.col("dst")), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return e.select(F.explode(ends).alias("x")).select("x.src", "x.dst")


def _flat(ws: Workspace, parent: DataFrame) -> DataFrame:
    """(v, p) with every p a root: pointers are doubled twice a pass until none moves, so passes are half the logarithm
    of the deepest tree."""
    while True:
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("q"))
        two = parent.join(up, "p").select("v", F.col("q").alias("p"))
        four = two.join(two.select(F.col("v").alias("p"), F.col("p").alias("q")), "p")
        nxt = ws.write(four.select("v", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")), "jump")
        still = nxt.where("moved").isEmpty()
        ws.drop(parent)
        parent = nxt.select("v", "p")
        if still:
            return parent


def connected_groups(spark: SparkSession, edges: DataFrame, a: str, b: str, bfs_levels: int = 24, stats: dict | None = None) -> DataFrame:
    """(record_id, group_id) for every id that has an edge; group_id is the smallest id of its component.

    The component of the vertex of highest degree is peeled off by breadth-first joins: only the frontier moves, and as
    the graph is undirected a new frontier need only be checked against the two levels before it. Its vertices leave by
    an anti-join, and minimum propagation labels the components that remain. A component deeper than bfs_levels would
    cost a pass over the edges for each level; of such a one the part reached becomes one vertex and the propagation,
    whose rounds follow the logarithm of the depth, ends the work. The result is the same, at any depth.

    Nulls and self-links are no edges; repeated edges count once; an empty table gives an empty result; other columns of
    edges are ignored. Ids compare byte by byte. Every level and round is a written table in the shared folder, deleted
    at the end; the driver sees one row (the start vertex). stats, if given, gets levels and rounds.
    """
    ws = Workspace(spark, "groups")
    stats = {} if stats is None else stats
    stats |= {"levels": 0, "rounds": 0}
    e = ws.write(_clean_edges(edges, a, b), "edges")
    near = ws.write(_both_ways(e), "adjacency")  # not shuffled by vertex: a hub may be on a third of the edges
    hub = near.groupBy("src").count().orderBy(F.desc("count"), "src").limit(1).collect()
    if not hub:
        return e.select(F.col("src").alias("record_id"), F.col("dst").alias("group_id"))
    start = hub[0]["src"]
    levels = [ws.write(spark.createDataFrame([(start,)], "v string"), "level")]
    deep = True
    for _ in range(bfs_levels):
        reached = near.join(levels[-1].withColumnRenamed("v", "src"), "src", "left_semi").select(F.col("dst").alias("v")).distinct()
        for seen in levels[-2:]:
            reached = reached.join(seen, "v", "left_anti")
        nxt = ws.write(reached, "level")
        if nxt.isEmpty():
            deep = False
            break
        levels.append(nxt)
    stats["levels"] = len(levels)
    giant = levels[0]
    for x in levels[1:]:
        giant = giant.unionByName(x)
    if not deep:  # no edge leaves the component, so one end tells
        labels = _propagate(ws, ws.write(e.join(giant.withColumnRenamed("v", "src"), "src", "left_anti"), "rest"), stats)
        label = giant.agg(F.min("v").alias("group_id"))
        peeled = giant.select(F.col("v").alias("record_id")).crossJoin(F.broadcast(label))
        return ws.finish(labels.select(F.col("v").alias("record_id"), F.col("label").alias("group_id")).unionByName(peeled))
    root = giant.agg(F.min("v")).first()[0]
    m1, m2 = giant.select(F.col("v").alias("m1")), giant.select(F.col("v").alias("m2"))
    j = e.join(m1, e.src == m1.m1, "left").join(m2, e.dst == m2.m2, "left")
    inside = lambda c, g: F.when(F.col(g).isNotNull(), F.lit(root)).otherwise(F.col(c))
    work = _clean_edges(j.select(inside("src", "m1").alias("s"), inside("dst", "m2").alias("d")), "s", "d")
    labels = ws.write(_propagate(ws, ws.write(work, "rest"), stats), "labels")
    named = labels.where(F.col("v") == root).first()
    final = min(root, named["label"] if named else root)
    out = labels.where(F.col("v") != root).select(F.col("v").alias("record_id"), F.col("label").alias("group_id"))
    return ws.finish(out.unionByName(giant.select(F.col("v").alias("record_id"), F.lit(final).alias("group_id"))))


def _propagate(ws: Workspace, e: DataFrame, stats: dict) -> DataFrame:
    """(v, label) of all vertices of e: label is the smallest id of the component.

    Each round a vertex points to the smallest id among itself and its neighbours, the pointers are followed to their
    ends, and the edges are rewritten to these ends; the edges that remain link local minima. A chain of rising ids is
    one tree of pointers and done in a single round. Every vertex that is no local minimum disappears in its round, and
    minima are never neighbours, so at least half of the vertices go.
    """
    assign = None
    while not e.isEmpty():
        stats["rounds"] += 1
        p = ws.write(_both_ways(e).groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("v"), F.least("src", "m").alias("p")), "parent")
        q = _flat(ws, p)
        # a label is the end of a pointer; those that are no vertex any more stay
        new = q.select("v", F.col("p").alias("label"))
        if assign is not None:
            new = assign.join(q.withColumnRenamed("v", "label"), "label", "left").select("v", F.coalesce("p", "label").alias("label"))
        new = ws.write(new, "assign")
        ends = e.join(q.select(F.col("v").alias("src"), F.col("p").alias("s2")), "src").join(q.select(F.col("v").alias("dst"), F.col("p").alias("d2")), "dst")
        nxt = ws.write(_clean_edges(ends, "s2", "d2"), "edges")
        for t in (q, e, *([assign] if assign is not None else [])):
            ws.drop(t)
        assign, e = new, nxt
    return assign if assign is not None else e.select(F.col("src").alias("v"), F.col("dst").alias("label"))


def spanning_forest(spark: SparkSession, edges: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    """(forest, roots): forest (src, dst, round) holds the edges of a spanning forest, roots (v, root) every vertex.

    Boruvka: edges are numbered, which is their total order without ties; each component picks its least edge, the
    picked edges join the forest, and components contract along them. The number of components at least halves each
    round. Picks of one round form trees whose only cycle is one mutual pick; the smaller id of that pair becomes the
    root, and pointer jumping flattens the trees. Picking is a minimum of numbers, so a hub is combined before the
    shuffle, and an edge is fetched by its number, which no other row shares. Both results are tables written in the
    shared folder; all others are deleted. Nulls and self-links are no edges; no edges give two empty tables.
    """
    ws = Workspace(spark, "forest")
    e = ws.write(_clean_edges(edges, a, b).withColumn("n", F.monotonically_increasing_id()).select("src", "dst", F.col("src").alias("cs"), F.col("dst").alias("cd"), "n"), "edges")
    roots, forest, rounds = None, [], 0
    while not e.isEmpty():
        rounds += 1
        half = e.select(F.explode(F.array("cs", "cd")).alias("v"), "n").groupBy("v").agg(F.min("n").alias("n"))
        pick = ws.write(half.join(e, "n").select("v", "n", "src", "dst", F.when(F.col("v") == F.col("cs"), F.col("cd")).otherwise(F.col("cs")).alias("to")), "pick")
        # two components that pick the same edge pick each other
        forest.append(ws.write(pick.groupBy("n").agg(F.first("src").alias("src"), F.first("dst").alias("dst"), F.count(F.lit(1)).alias("ends")).withColumn("round", F.lit(rounds)), "forest"))
        mutual = forest[-1].where("ends = 2").select("n", F.lit(True).alias("mutual"))
        parent = pick.join(mutual, "n", "left").select("v", F.when(F.col("mutual") & (F.col("v") < F.col("to")), F.col("v")).otherwise(F.col("to")).alias("p"))
        parent = _flat(ws, ws.write(parent, "parent"))
        new = parent.select("v", F.col("p").alias("root"))
        if roots is not None:
            new = roots.join(parent.withColumnRenamed("v", "root"), "root", "left").select("v", F.coalesce("p", "root").alias("root"))
        new = ws.write(new, "roots")
        ps, pd_ = parent.select(F.col("v").alias("cs"), F.col("p").alias("s2")), parent.select(F.col("v").alias("cd"), F.col("p").alias("d2"))
        e2 = e.join(ps, "cs").join(pd_, "cd").where("s2 <> d2")
        # of parallel edges between two components only the least can ever be picked
        least = e2.groupBy(F.least("s2", "d2").alias("cs"), F.greatest("s2", "d2").alias("cd")).agg(F.min("n").alias("n"))
        e2 = ws.write(least.join(e.select("src", "dst", "n"), "n").select("src", "dst", "cs", "cd", "n"), "edges")
        for t in (pick, parent, e, *([roots] if roots is not None else [])):
            ws.drop(t)
        roots, e = new, e2
    if roots is None:
        return e.select("src", "dst", F.lit(0).alias("round")), e.select(F.col("src").alias("v"), F.col("dst").alias("root"))
    out = forest[0]
    for f in forest[1:]:
        out = out.unionByName(f)
    return ws.finish(out.select("src", "dst", "round"), roots), roots


def _parts(n: int, open_: dict[str, float]) -> dict[str, int]:
    """n split in proportion to open_, whole numbers, largest remainders first."""
    total = sum(open_.values())
    if total <= 0:
        open_, total = {s: 1.0 for s in open_}, float(len(open_))
    exact = {s: n * v / total for s, v in open_.items()}
    got = {s: int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (got[s] - exact[s], s))[: n - sum(got.values())]:
        got[s] += 1
    return got


def group_splits(
    spark: SparkSession, rows: DataFrame, row_id: str, entity: str, roots: DataFrame, targets: dict[str, float],
    seed: int = 7, exact_sizes: int = 64, bucket_rows: int = 1_000_000, hot_share: float = 0.002,
) -> DataFrame:
    """rows with columns group_id and split_name: rows of one entity, and of entities linked by edges, share a split.

    roots: (v, root) of spanning_forest. Groups are its trees; group_id is "e:" and the root's id, or the entity where
    it has no edge, "r:" and the row id for a row without an entity, and "n:" for rows with neither. Groups are
    stratified by their number of rows: a band for each size up to exact_sizes, above it one for each power of two.
    Bands are dealt from the largest sizes to the smallest: within a band the groups stand in hash order, and each
    split gets its part of the ranks in proportion to what it still lacks, so each band makes good what the bands
    before it left. A group may be larger than a split's share; then that share cannot be kept.

    targets: split to share; shares are scaled to add up to 1. Ranks come from running counts over hash buckets, so no
    band is ordered in one task; the driver sees one row a band. Rows of groups with at least hot_share of all rows (at
    most 1/hot_share groups) are joined by broadcast, so that no such group comes into one task. Columns group_id and
    split_name must not exist in rows. An empty table gives an empty result.
    """
    if {"group_id", "split_name"} & set(rows.columns):
        raise ValueError("rows already has a column group_id or split_name")
    ws = Workspace(spark, "splits")
    ent = F.col(f"`{entity}`").cast("string")
    keyed = rows.withColumn("__e", F.coalesce(F.concat(F.lit("e:"), ent), F.concat(F.lit("r:"), F.col(f"`{row_id}`").cast("string")), F.lit("n:")))
    r = roots.select(F.concat(F.lit("e:"), F.col("v")).alias("__e"), F.concat(F.lit("e:"), F.col("root")).alias("__root"))
    keyed = ws.write(keyed.join(r, "__e", "left").withColumn("group_id", F.coalesce("__root", "__e")).drop("__e", "__root"), "keyed")
    groups = ws.write(keyed.groupBy("group_id").agg(F.count(F.lit(1)).alias("size")), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    names = sorted(targets, key=lambda s: (-targets[s], s))
    scale = sum(targets.values())
    lack = {s: targets[s] / scale * total for s in names}
    band = F.when(F.col("size") <= exact_sizes, F.col("size")).otherwise(F.lit(exact_sizes) + F.ceil(F.log2(F.col("size") / exact_sizes))).cast("int")
    buckets = max(4, -(-total // bucket_rows))
    g = groups.withColumn("band", band).withColumn("h", F.xxhash64("group_id", F.lit(seed))).withColumn("bucket", F.pmod(F.shiftright("h", 8), F.lit(buckets)).cast("int"))
    per = g.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("band").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("band", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    place = F.row_number().over(Window.partitionBy("band", "bucket").orderBy("h", "group_id")) - 1
    ranked = ws.write(g.join(base, ["band", "bucket"]).select("group_id", "size", "band", (F.col("base") + place).alias("rank")), "ranked")
    sizes = {x["band"]: x["n"] for x in ranked.groupBy("band").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a band
    cuts = []
    for bnd in sorted(sizes, reverse=True):
        got = _parts(sizes[bnd], {s: max(0.0, lack[s]) for s in names})
        at = 0
        mine = []
        for s in names:
            mine.append((bnd, at, at + got[s], s))
            at += got[s]
        cuts += mine
        if bnd <= exact_sizes:
            real = {s: got[s] * bnd for s in names}
        else:
            conds = [F.sum(F.when((F.col("rank") >= lo) & (F.col("rank") < hi), F.col("size"))).alias(s) for _, lo, hi, s in mine]
            real = {k: v or 0 for k, v in ranked.where(F.col("band") == bnd).agg(*conds).first().asDict().items()}
        for s in names:
            lack[s] -= real[s]
    table = spark.createDataFrame(cuts, "band int, lo long, hi long, split_name string")
    dealt = ws.write(ranked.join(F.broadcast(table), "band").where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))).select("group_id", "size", "split_name"), "dealt")
    hot = dealt.where(F.col("size") >= max(1.0, hot_share * total)).select("group_id", F.col("split_name").alias("__hot"))  # at most 1/hot_share rows
    marked = keyed.join(F.broadcast(hot), "group_id", "left")
    one = marked.where("__hot is not null").withColumnRenamed("__hot", "split_name")
    other = marked.where("__hot is null").drop("__hot").join(dealt.select("group_id", "split_name"), "group_id")
    cols = [*rows.columns, "group_id", "split_name"]
    return ws.finish(one.select(*[f"`{c}`" for c in cols]).unionByName(other.select(*[f"`{c}`" for c in cols])))
