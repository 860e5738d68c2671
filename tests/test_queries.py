import glob
import itertools
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from sanadflow.plans import registry

FOLDER = "/root/testdata/sf0.001"


def shown(frame):
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(cell(v) for v in r) for r in frame.itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def db():
    found = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        found.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return found


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    frame = registry.QUERIES[name](spark, FOLDER).toPandas()
    if name in registry.SQL:
        expected = db.sql(registry.SQL[name]).df()
        assert sorted(frame.columns) == sorted(expected.columns)
        assert shown(frame) == shown(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def unlike_rare_words(n=2):
    """Records of ``n`` works; the second has most words of the first, but none of its six rarest."""
    words = ["".join(w) for w in itertools.product("بتجحدرسش", repeat=4)]
    said = "سمعت زيدا يقول قال رسول الله"
    return [f"{said} {' '.join(words[:20])} {' '.join(words[100 * (i + 1) : 100 * (i + 1) + 7])}" for i in range(n)]


def test_collection_funnel_merges_records_whose_rarest_words_differ(spark, tmp_path):
    path = f"{tmp_path}/openiti.parquet"
    spark.createDataFrame([(i, "c", i, x) for i, x in enumerate(unlike_rare_words(3))], "entry_id long, collection string, n int, ar string").write.parquet(path)
    got = [tuple(r) for r in registry.QUERIES["collection_funnel"](spark, str(tmp_path)).collect()]
    assert got == [("c", 3, 3, 1, 0)]
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW openiti AS SELECT * FROM '{path}/*.parquet'")
        assert con.sql(registry.SQL["collection_funnel"]).fetchall() == got
