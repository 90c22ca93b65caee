import duckdb
import pytest

import __spark_entry__ as entry
from lensgraph import catalogue

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SOME = ["l1_by_region_code", "l2_features", "sample_round_robin", "edits_detected", "quantile_table", "knn_topk", "pair_scores", "cluster_summary", "review_queue"]


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL)


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{SMALL}/{t}.parquet'")
    df = entry.queries()[name](spark, SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(rel.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    text = lambda row: tuple(repr(round(x, 9) if isinstance(x, float) else x) for x in row)
    assert sorted(text(r[c] for c in columns) for r in df.collect()) == sorted(text(r[i] for i in order) for r in rel.fetchall())
