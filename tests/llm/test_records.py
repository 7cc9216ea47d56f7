from datetime import datetime

from pairloom.llm import addresses, mixture

PLACES = [(1, "India", "Natanagar", None, "Sushala", "SL", "144"), (2, "US", "Wickham Springs", "Old Springs", "Tolwickash", "TS", "788")]
COLS = ["place_id", "country", "place_name", "alt_name", "region_name", "region_code", "postal_prefix"]
ROWS = [
    ("S1-1", "Zefiro Mart", "614 Holthomarmer Drive, Wickham Springs, TS 78877", "US"),
    ("S2-1", "ZefiroMart Inc.", "#0614 Holthomarmer Drv - Suite 8 - Old Springs", "US"),
    ("S1-2", "Zefiro Mart", "615 Holthomarmer Drive, Wickham Springs, TS 78877", "US"),
    ("S3-1", "Karvio Express", "Wickham Springs 78877, Holthomamer Drive 614", None),
    ("S1-3", "Loha Richa Tyres", "161, Rotaripa Lane, Natanagar 144756", "India"),
    ("S2-2", "LOHA RICHA TYRES & SONS", "161 रोतारीपा लेन नातानगर", "India"),
    ("S2-3", "Loha Richa Tyres", "None", "India"),
    ("S3-2", "Zefiro Mart", "TS", "US"),
]


def _frames(spark):
    rows = spark.createDataFrame([(*r, datetime(2024, 1, 1)) for r in ROWS], "entity_id string, business_name string, business_address string, country string, loaded_at timestamp")
    return rows, spark.createDataFrame(PLACES, "place_id int, country string, place_name string, alt_name string, region_name string, region_code string, postal_prefix string")


def test_p5_same_building(spark):
    rows, places = _frames(spark)
    got = addresses.same_building(addresses.parsed_addresses(rows, "business_address", "country", places).select("entity_id", "addr"), "entity_id")
    assert sorted(map(tuple, got.collect())) == [("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-3", "S2-2"), ("S2-1", "S3-1")]


def test_p4_branches_and_neighbours_are_no_match(spark):
    rows, places = _frames(spark)
    got = mixture.match_records(spark, rows, places).where("confidence > 0.5").select("s1", "t")
    pairs = set(map(tuple, got.collect()))
    assert ("S1-1", "S2-1") in pairs and ("S1-3", "S2-2") in pairs
    assert not pairs & {("S1-2", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S3-1"), ("S1-1", "S3-2"), ("S1-2", "S3-2")}


def test_p4_p5_are_registered():
    import __spark_entry__

    assert {"p4_found", "p5_found"} <= set(__spark_entry__.queries())


def test_p5_nulls_repeats_clashes_and_empty(spark):
    rows, places = _frames(spark)
    odd = [(None, None, ROWS[0][2], "US"), ("S2-9", None, None, None), ("S2-8", "", "", ""), ("S3-7", "x", "614 " + "Zzyxmar " * 3000 + "Drive, Wickham Springs 78877", "US"), ROWS[0], ROWS[0]]
    more = spark.createDataFrame([(*r, datetime(2024, 1, 1)) for r in odd], rows.schema).unionByName(rows)
    clash = more.withColumn("h", mixture.F.lit("x")).withColumn("ka", mixture.F.lit(1)).withColumn("addr", mixture.F.lit("y"))
    parsed = addresses.parsed_addresses(clash, "business_address", "country", places)
    got = addresses.same_building(parsed, "entity_id")
    assert sorted(map(tuple, got.collect())) == [("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-3", "S2-2"), ("S2-1", "S3-1")]
    assert addresses.same_building(parsed.limit(0), "entity_id").isEmpty()


def test_p4_nulls_repeats_clashes_and_empty(spark):
    rows, places = _frames(spark)
    odd = [(None, "Zefiro Mart", ROWS[0][2], "US"), ("S2-9", None, None, None), ("S1-9", "", "", None), ("S3-8", "Zefiro " * 3000, None, "US"), ROWS[1], ROWS[1]]
    more = spark.createDataFrame([(*r, datetime(2024, 1, 1)) for r in odd], rows.schema).unionByName(rows)
    clash = more.withColumn("id", mixture.F.lit("x")).withColumn("core", mixture.F.lit("y")).withColumn("s1", mixture.F.lit("z"))
    got = mixture.match_records(spark, clash, places)
    pairs = set(map(tuple, got.where("confidence > 0.5").select("s1", "t").collect()))
    assert {("S1-1", "S2-1"), ("S1-3", "S2-2")} <= pairs and got.count() == got.select("s1", "t").distinct().count()
    assert got.where("confidence < 0 or confidence > 1 or confidence is null").isEmpty()
    assert mixture.match_records(spark, rows.limit(0), places).isEmpty()


def test_p4_no_table_of_records_is_broadcast(spark):
    rows, places = _frames(spark)
    records = mixture.latest_records(spark, rows, places)
    for df in (pairs := mixture.candidate_pairs(records), mixture.pair_features(pairs, records)):
        df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_p5_kinds_and_placeholders(spark):
    _, places = _frames(spark)
    df = spark.createDataFrame([("12 Dimova Gali, Natanagar", "India"), ("12, Dimova Lane, Natanagar", "India"), ("unknown", None), ("N/A", "US")], "a string, c string")
    x, y, z, w = [r["addr"] for r in addresses.parsed_addresses(df, "a", "c", places).collect()]
    assert x["kind"] == y["kind"] == "lane" and x["number"] == "12" and z["street"] is None and w["street"] is None
