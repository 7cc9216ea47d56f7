import os

import duckdb
import pytest

import __spark_entry__

DIR = "/root/testdata/sf0.001"
#: One query of each kind against its SQL; the driver compares all of them.
CHECKED = ["norm_records", "block_topk", "decode_expected_f", "macro_f05", "p3_found", "truth_lists", "split_profile"]


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")
def test_entry_gives_rows(spark):
    assert __spark_entry__.entry(spark).columns == ["field_name", "key_value"]


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")
@pytest.mark.parametrize("name", CHECKED)
def test_query_against_sql(spark, name):
    db = duckdb.connect()
    for f in os.listdir(DIR):
        db.sql(f"create view {f.removesuffix('.parquet')} as select * from '{DIR}/{f}'")
    cell = lambda v: round(v, 6) if isinstance(v, float) else v
    want = db.sql(__spark_entry__.oracle_sql()[name])
    cols = sorted(want.columns)
    got = __spark_entry__.queries()[name](spark, DIR)
    assert sorted(got.columns) == cols
    order = [want.columns.index(c) for c in cols]
    left = sorted(repr(tuple(cell(r[c]) for c in cols)) for r in got.collect())
    assert left == sorted(repr(tuple(cell(r[i]) for i in order)) for r in want.fetchall())
