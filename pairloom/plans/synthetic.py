"""Made-up sources and truth, as Spark rows from seeded hashes: for tests and demonstrations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.sources.files import write_tsv

# What names and addresses are made of.
SYLLABLES = ["ka", "ri", "mo", "tel", "san", "vo", "lu", "ne", "par", "dis", "gol", "fen", "bru", "tam", "wex", "yor"]
TRADES = ["traders", "bakery", "pharmacy", "motors", "textiles", "foods", "electronics", "hardware", "stationers", "clinic"]
FORMS = ["pvt ltd", "llc", "inc", "co", "ltd", "sarl", "enterprises"]
LONG = {"pvt ltd": "Private Limited", "llc": "LLC", "inc": "Incorporated", "co": "Company", "ltd": "Limited", "sarl": "SARL", "enterprises": "Enterprises"}
STREETS = ["road", "street", "avenue", "lane", "nagar", "boulevard"]
SHORT = {"road": "Rd", "street": "St", "avenue": "Ave", "lane": "Ln", "nagar": "Ngr", "boulevard": "Blvd"}


def _n(seed: str, below: int) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(below))


def _chance(seed: str) -> Column:
    return _n(seed, 1_000_000) / 1_000_000.0


def _pick(values: list[str], seed: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (_n(seed, len(values)) + 1).cast("int"))


def _word(seed: str, syllables: int) -> Column:
    return F.concat(*[_pick(SYLLABLES, f"{seed}{i}") for i in range(syllables)])


def _look_up(table: dict[str, str], c: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)


def _typo(text: Column, seed: str) -> Column:
    at = (F.pmod(F.xxhash64("id", "copy", F.lit(seed)), F.greatest(F.length(text) - 2, F.lit(1))) + 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + 1, F.lit(1000)))


def businesses(spark: SparkSession, n: int, split: str, countries: list[str], seed: int = 7) -> DataFrame:
    """(id, name, form, number, street, kind, city, code, country), one row a business."""
    s = f"{split}{seed}"
    return spark.range(n).select(
        "id", F.concat_ws(" ", _word(f"{s}n", 2), _word(f"{s}m", 2), _pick(TRADES, f"{s}t")).alias("name"), _pick(FORMS, f"{s}f").alias("form"), (_n(f"{s}h", 900) + 1).alias("number"), _word(f"{s}s", 3).alias("street"),
        _pick(STREETS, f"{s}k").alias("kind"), F.concat(_word(f"{s}c", 1), F.lit("pur")).alias("city"), (_n(f"{s}p", 800000) + 100000).alias("code"), _pick(countries, f"{s}y").alias("country"),
    )


def _written(b: DataFrame, seed: str) -> DataFrame:
    """Noisy writings: rows of b with column copy to entity_id, name, address and country."""
    r = lambda k: F.pmod(F.xxhash64("id", "copy", F.lit(f"{seed}{k}")), F.lit(1000)) / 1000.0
    name = F.concat_ws(" ", F.initcap("name"), F.when(r("f") < 0.5, _look_up(LONG, F.col("form"))).otherwise(F.col("form")))
    name = F.when(r("t") < 0.25, _typo(name, seed)).otherwise(name)
    name = F.when(r("u") < 0.2, F.upper(name)).otherwise(name)
    kind = F.when(r("k") < 0.5, _look_up(SHORT, F.col("kind"))).otherwise(F.initcap("kind"))
    addr = F.concat(F.col("number").cast("string"), F.lit(" "), F.initcap("street"), F.lit(" "), kind, F.lit(", "), F.initcap("city"), F.when(r("z") < 0.12, "").otherwise(F.concat(F.lit(" "), F.col("code").cast("string"))))
    addr = F.when(r("d") < 0.15, _typo(addr, seed + "a")).otherwise(addr)
    addr = F.when(r("x") < 0.05, "None").otherwise(addr)
    return b.select("id", "copy", "entity_id", name.alias("business_name"), addr.alias("business_address"), "country")


def generate(spark: SparkSession, out: str, n: int, split: str, countries: list[str] | None = None, seed: int = 7) -> DataFrame:
    """Writes {out}/{split}/{split}_source1..3.tsv and, for train, its ground truth; returns the truth (s1_id, t_id).

    Matches per business: none for 6 %, else one to six, each in source 2 or 3. Among source 2 are neighbours of the
    same name at another number (15 %), among source 3 businesses that source 1 lacks (a third).
    """
    s = f"{split}{seed}"
    base = businesses(spark, n, split, countries or ["India", "US"], seed)
    s1 = base.withColumn("s1_id", F.format_string("S1-%06d", "id"))
    copies = F.when(_chance(f"{s}0") < 0.06, 0).otherwise(1 + _n(f"{s}1", 6)).cast("int")
    c = s1.withColumn("copies", copies).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    c = c.withColumn("side", 2 + F.pmod(F.xxhash64("id", "copy", F.lit(f"{s}2")), F.lit(2)))
    c = c.withColumn("entity_id", F.when(F.col("side") == 2, F.format_string("S2-%07d", F.col("id") * 10 + F.col("copy"))).otherwise(F.format_string("S3-%07d", F.col("id") * 10 + F.col("copy"))))
    near = s1.where(_chance(f"{s}3") < 0.15).withColumns({"number": F.col("number") + 1 + _n(f"{s}4", 40), "copy": F.lit(9), "side": F.lit(2), "entity_id": F.format_string("S2-%07d", F.col("id") * 10 + 9)})
    other = businesses(spark, n // 3, f"{split}-other", countries or ["India", "US"], seed).withColumns({"copy": F.lit(8), "side": F.lit(3), "entity_id": F.format_string("S3-9%06d", F.col("id"))})
    cols = ["id", "copy", "side", "entity_id", "name", "form", "number", "street", "kind", "city", "code", "country"]
    targets = c.select(*cols).unionByName(near.select(*cols)).unionByName(other.select(*cols))
    fields = ["entity_id", "business_name", "business_address", "country"]
    write_tsv(_written(s1.withColumns({"copy": F.lit(0), "entity_id": F.col("s1_id")}), f"{s}w1").select(*fields), f"{out}/{split}/{split}_source1.tsv")
    for k in (2, 3):
        write_tsv(_written(targets.where(F.col("side") == k), f"{s}w{k}").select(*fields), f"{out}/{split}/{split}_source{k}.tsv")
    truth = c.select("s1_id", F.col("entity_id").alias("t_id"))
    if split == "train":
        lists = truth.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_list("t_id")), ",").alias("l"))
        rows = s1.select("s1_id").join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("l", F.lit("")).alias("matched_entity_ids"))
        write_tsv(rows, f"{out}/train/train_ground_truth.tsv")
    return truth
