"""The driver contract: names match, and a few queries equal their SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from notemill.plans.queries import QUERIES
from tools.check_oracle import table

SF = "/root/testdata/sf0.001"
SAMPLE = ("note_3_merge_chords", "den_note_densities", "cdc_8_change_summary", "prj_11_clean_playlist", "rel_16_reliability_scores")


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(SF):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    df = contract.queries()[name](spark, SF)
    cursor = db.execute(contract.oracle_sql()[name])
    want = table([d[0] for d in cursor.description], cursor.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == want
