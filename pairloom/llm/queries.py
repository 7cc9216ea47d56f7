"""Queries of the operators for training data, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.llm import addresses, confusables, encoding, graph, mixing, mixture, passages
from pairloom.operators.packed import explode_packed
from pairloom.queries.shape import SQL as SHAPE_SQL
from pairloom.queries.shape import TARGET_ID
from pairloom.queries.tables import TEST, TRAIN, all_rows, table
from pairloom.session import Workspace


def _match_links(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(rows, links) of train_matches: gt_row and the trimmed source 1 id; source 1 id and matched id."""
    rows = table(spark, d, "train_matches").select("gt_row", F.regexp_replace("source1_entity_id", "^[\\s\\u00a0]+|[\\s\\u00a0]+$", "").alias("s1"), "matched_entity_ids")
    links = explode_packed(rows, "matched_entity_ids", "matched_entity_id", keep=TARGET_ID, carry=["s1"]).select("s1", "matched_entity_id")
    return rows.drop("matched_entity_ids"), links


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    rows, links = _match_links(spark, d)
    links = Workspace(spark, "links").write(links)
    groups = graph.connected_groups(spark, links, "s1", "matched_entity_id")
    alone = rows.select(F.col("s1").alias("record_id")).unionByName(links.select(F.col("matched_entity_id").alias("record_id"))).where("record_id is not null").join(groups, "record_id", "left_anti").distinct()
    return groups.unionByName(alone.withColumn("group_id", F.col("record_id")))


def p7_splits(spark: SparkSession, d: str) -> DataFrame:
    rows, links = _match_links(spark, d)
    targets = {r["split_name"]: r["target_share"] for r in table(spark, d, "split_targets").collect()}
    _, roots = graph.spanning_forest(spark, links, "s1", "matched_entity_id")
    return graph.group_splits(spark, rows.withColumnRenamed("s1", "source1_entity_id"), "gt_row", "source1_entity_id", roots, targets)


def p7_forest(spark: SparkSession, d: str) -> DataFrame:
    """The spanning forest's size beside what any spanning forest of the links must have: vertices, edges, trees."""
    forest, roots = graph.spanning_forest(spark, _match_links(spark, d)[1], "s1", "matched_entity_id")
    return roots.agg(F.count(F.lit(1)).alias("n_vertices"), F.count_distinct("root").alias("n_trees")).crossJoin(F.broadcast(forest.agg(F.count(F.lit(1)).alias("n_edges"))))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """Per split the target, and whether the share reached is within one row in a thousand, or one row, of it."""
    n = p7_splits(spark, d).groupBy("split_name").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy())
    x = table(spark, d, "split_targets").join(F.broadcast(n), "split_name", "left").withColumn("all", total)
    off = F.abs(F.coalesce("n", F.lit(0)) - F.col("target_share") * F.col("all"))
    return x.select("split_name", "target_share", (off <= F.greatest(F.lit(1.0), F.col("all") / 1000)).alias("reached"))


def p7_violations(spark: SparkSession, d: str) -> DataFrame:
    """Entities and targets whose rows lie in several splits: none."""
    s = p7_splits(spark, d).select("gt_row", "split_name")
    rows = table(spark, d, "train_matches").join(s, "gt_row").select(F.regexp_replace("source1_entity_id", "^[\\s\\u00a0]+|[\\s\\u00a0]+$", "").alias("s1"), "matched_entity_ids", "split_name")
    ids = explode_packed(rows, "matched_entity_ids", "id", keep=TARGET_ID, carry=["split_name"]).select("id", "split_name").unionByName(rows.select(F.col("s1").alias("id"), "split_name"))
    return ids.where("id is not null").groupBy("id").agg(F.count_distinct("split_name").alias("n_splits")).where("n_splits > 1")


def _test_rows(spark: SparkSession, d: str) -> DataFrame:
    return all_rows(spark, d, TEST, ["entity_id", "business_name", "business_address", "country", "loaded_at"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    scored = mixture.match_records(spark, _test_rows(spark, d), table(spark, d, "place_names"))
    return scored.where("confidence > 0.5").select(F.col("s1").alias("source1_entity_id"), F.col("t").alias("target_entity_id"))


def p4_matches(spark: SparkSession, d: str) -> DataFrame:
    """All candidate pairs with the posterior of a match."""
    return mixture.match_records(spark, _test_rows(spark, d), table(spark, d, "place_names")).select(F.col("s1").alias("source1_entity_id"), F.col("t").alias("target_entity_id"), "confidence")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _test_rows(spark, d).select("entity_id", "business_address", "country").distinct()
    parsed = addresses.parsed_addresses(rows, "business_address", "country", table(spark, d, "place_names")).select("entity_id", "addr")
    return addresses.same_building(Workspace(spark, "addresses").write(parsed), "entity_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    fields = ["business_name", "business_address"]
    rows = all_rows(spark, d, TRAIN + TEST, ["entity_id", *fields]).select("entity_id", *fields).distinct()
    cells = Workspace(spark, "cells").write(confusables.confusable_forms(rows, ["entity_id"], fields))
    return confusables.altered_cells(cells, ["entity_id"]).select("entity_id", "field_name").distinct()


def p6_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every name and address of the six tables in its one consistent form."""
    fields = ["business_name", "business_address"]
    rows = all_rows(spark, d, TRAIN + TEST, ["entity_id", *fields]).select("entity_id", *fields).distinct()
    return confusables.confusable_forms(rows, ["entity_id"], fields).select("entity_id", "field_name", "text", "form", "altered")


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    """Texts of equal skeleton: rows, writings, altered rows, and the form most of them have."""
    rows = all_rows(spark, d, TRAIN + TEST, ["entity_id", "business_name", "business_address"])
    return confusables.skeleton_groups(confusables.confusable_forms(rows, ["entity_id"], ["business_name", "business_address"]))


def p8_passages(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the items they hold a passage of: exact or near, and how many words stand at their places."""
    return passages.passages(spark, table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_passages(spark, d).where("kind = 'exact'").select("doc_id", "item_id")


def p9_draw(spark: SparkSession, d: str) -> DataFrame:
    """Documents drawn, with how often each is used."""
    return mixing.draw(spark, table(spark, d, "documents"), "doc_id", ["source", "lang", "kernel"], "text", table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares reached by p9_draw beside the shares asked for."""
    return mixing.shares(p9_draw(spark, d), table(spark, d, "mix_targets"))


def p9_targets(spark: SparkSession, d: str) -> DataFrame:
    """Per source whether its share is within half a point of the target, and no document is used too often."""
    targets = table(spark, d, "mix_targets")
    s = p9_shares(spark, d).join(F.broadcast(targets.select("source", "max_repeats")), "source")
    return s.select("source", "target_share", (F.abs(F.col("share") - F.col("target_share")) < 0.005).alias("reached"), (F.col("most_repeats") <= F.col("max_repeats")).alias("within_repeats"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text rlike '[^\\\\x00-\\\\x7f]'")
    return docs.select("doc_id", encoding.repair(F.col("text")).alias("r")).where("r.garbled").select("doc_id").distinct()


def p10_repaired(spark: SparkSession, d: str) -> DataFrame:
    """The garbled documents with their text repaired where that is possible."""
    docs = table(spark, d, "documents").where("text rlike '[^\\\\x00-\\\\x7f]'")
    return docs.select("doc_id", encoding.repair(F.col("text")).alias("r")).where("r.garbled").select("doc_id", F.col("r.original").alias("original"))


QUERIES = {"p1_found": p1_found, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found, "p7_splits": p7_splits, "p7_shares": p7_shares, "p7_violations": p7_violations, "p7_forest": p7_forest, "p8_found": p8_found, "p8_passages": p8_passages, "p9_draw": p9_draw, "p9_shares": p9_shares, "p9_targets": p9_targets, "p10_found": p10_found, "p4_matches": p4_matches, "p6_forms": p6_forms, "p6_groups": p6_groups, "p10_repaired": p10_repaired}
_TRIM = "regexp_replace(source1_entity_id, '^[\\s\\x{00a0}]+|[\\s\\x{00a0}]+$', '', 'g')"
#: links of train_matches by the rule of p3_found, and the smallest id that each id reaches
_GROUPS = f"""p3 as ({SHAPE_SQL["p3_found"]}), rows as (select gt_row, {_TRIM} s1 from train_matches),
 links as (select distinct s1 a, matched_entity_id b from p3 join rows using (gt_row) where s1 is not null),
 near as (select a, b from links union select b, a from links),
 ids as (select s1 id from rows where s1 is not null union select b from links),
 reach(id, r) as (select id, id from ids union select reach.id, near.b from reach join near on near.a = reach.r),
 groups as (select id record_id, min(r) group_id from reach group by id)"""
SQL: dict[str, str] = {
    "p1_found": f"with recursive {_GROUPS} select record_id, group_id from groups",
    "p7_shares": "select split_name, target_share, true as reached from split_targets",
    "p7_violations": "select source1_entity_id as id, cast(2 as bigint) as n_splits from train_matches where false",
    "p7_forest": f"""with recursive {_GROUPS}, linked as (select * from groups where record_id in (select a from near))
 select count(*) n_vertices, count(distinct group_id) n_trees, count(*) - count(distinct group_id) n_edges from linked""",
    "p9_targets": "select source, target_share, true as reached, true as within_repeats from mix_targets",
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
