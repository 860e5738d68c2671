import glob
import os

import duckdb
import pytest

from sanadflow.llm import queries

FOLDER = "/root/testdata/sf0.001"
FOUND = {
    "p2_found": ["row_id", "topic"], "p3_found": ["nr", "scholar_indx"], "p4_found": ["entry_id_a", "entry_id_b"], "p5_found": ["nr_a", "nr_b"],
    "p6_found": ["tab", "id_a", "id_b"], "p7_found": ["doc_id", "item_id"], "p9_found": ["doc_id", "lang"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    rows = queries.QUERIES[name](spark, FOLDER)
    if name in FOUND:
        assert rows.columns == FOUND[name]
        got = rows.collect()
        assert len(got) == len(set(got))
    else:
        assert rows.count() >= 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    rows = queries.QUERIES[name](spark, FOLDER)
    assert sorted(map(tuple, rows.collect())) == sorted(db.sql(f"SELECT {', '.join(rows.columns)} FROM ({queries.SQL[name]})").fetchall())
