"""Queries p2 and p3: heavy keys and packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.packed import explode_packed
from pairloom.operators.salted import Agg, salted_aggregate, salted_top_k
from pairloom.queries.tables import TRAIN, all_rows, table
from pairloom.session import Workspace

#: What an id of a target looks like; a suffix after a delimiter belongs to it.
TARGET_ID = "^S[0-9]+-[0-9]"


def _field_values(spark: SparkSession, d: str) -> DataFrame:
    rows = all_rows(spark, d, TRAIN, ["entity_id", "business_name", "business_address", "country", "loaded_at"])
    pairs = F.array(*[F.struct(F.lit(c).alias("field_name"), F.regexp_replace(c, "^[\\s ]+|[\\s ]+$", "").alias("key_value")) for c in ("business_name", "country")])
    return rows.select("entity_id", "business_address", "loaded_at", F.explode(pairs).alias("f")).select("entity_id", "business_address", "loaded_at", "f.field_name", "f.key_value")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    values = _field_values(spark, d).select("field_name", "key_value")
    per_key = Workspace(spark, "per_key").write(salted_aggregate(values, ["field_name", "key_value"], [Agg("n", "count")]))
    total = per_key.groupBy("field_name").agg(F.sum("n").alias("total"))  # one row a field
    return (
        per_key.where(F.col("key_value").isNotNull() & (F.col("key_value") != ""))
        .join(F.broadcast(total), "field_name")
        .where(F.col("n") * 100 >= F.col("total") * 2)
        .select("field_name", "key_value")
    )


def p2_key_stats(spark: SparkSession, d: str) -> DataFrame:
    """Per name and per country: rows, distinct addresses, first and last loading time."""
    return salted_aggregate(
        _field_values(spark, d), ["field_name", "key_value"],
        [Agg("n_rows", "count"), Agg("n_addresses", "count_distinct", "business_address"), Agg("first_loaded", "min", "loaded_at"), Agg("last_loaded", "max", "loaded_at")],
    )


def p2_latest(spark: SparkSession, d: str) -> DataFrame:
    """The three entities loaded last of each name and country."""
    v = _field_values(spark, d).groupBy("field_name", "key_value", "entity_id").agg(F.max("loaded_at").alias("loaded_at"))
    return salted_top_k(v, ["field_name", "key_value"], [F.desc_nulls_last("loaded_at"), F.asc("entity_id")], 3)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return explode_packed(table(spark, d, "train_matches"), "matched_entity_ids", "matched_entity_id", keep=TARGET_ID, carry=["gt_row"])


_VALUES = """
 select entity_id, 'business_name' field_name, regexp_replace(business_name, '^[\\s ]+|[\\s ]+$', '', 'g') key_value, business_address, loaded_at from rows
 union all
 select entity_id, 'country', regexp_replace(country, '^[\\s ]+|[\\s ]+$', '', 'g'), business_address, loaded_at from rows"""
_ROWS = "rows as (" + " union all ".join(f"select entity_id, business_name, business_address, country, loaded_at from {t}" for t in TRAIN) + ")"

SQL = {
    "p2_found": f"""with {_ROWS}, v as ({_VALUES}), n as (select field_name, key_value, count(*) n from v group by all)
 select field_name, key_value from n where key_value is not null and key_value <> '' and n * 50 >= (select count(*) from rows)""",
    "p2_key_stats": f"""with {_ROWS}, v as ({_VALUES})
 select field_name, key_value, count(*) n_rows, count(distinct business_address) n_addresses, min(loaded_at) first_loaded, max(loaded_at) last_loaded from v group by all""",
    "p2_latest": f"""with {_ROWS}, v as ({_VALUES}), e as (select field_name, key_value, entity_id, max(loaded_at) loaded_at from v group by all)
 select *, cast(row_number() over (partition by field_name, key_value order by loaded_at desc nulls last, entity_id) as integer) as rank from e qualify row_number() over (partition by field_name, key_value order by loaded_at desc nulls last, entity_id) <= 3""",
    "p3_found": r"""with m as (select gt_row, unnest(regexp_extract_all(matched_entity_ids, 'S[0-9]+-[0-9]+(?:[;|/]? ?,? ?[A-Z0-9](?:["'']))?')) raw,
   generate_subscripts(regexp_extract_all(matched_entity_ids, 'S[0-9]+-[0-9]+(?:[;|/]? ?,? ?[A-Z0-9](?:["'']))?'), 1) pos from train_matches)
 select gt_row, cast(pos as integer) pos, rtrim(raw, '"''') matched_entity_id from m""",
}
QUERIES = {"p2_found": p2_found, "p2_key_stats": p2_key_stats, "p2_latest": p2_latest, "p3_found": p3_found}
