import math

import duckdb
import pytest

import __spark_entry__ as E
from verbscope.plans.bindings import TABLES
from verbscope.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["lang", "n_docs", "n_que", "que_rate"]
    assert df.count() >= 0


def test_every_query_has_oracle():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing == set()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _sorted_rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", ["que_rate_by_lang", "verb_distance", "verb_runs", "page_batches",
                                  "merge_pull", "query_match", "mark_heads",
                                  "sample_fraction", "sample_n", "filter_known_verbs", "anti_join_tables",
                                  "containment_join", "distance_table", "merge_tables_first", "page_batches_all"])
def test_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == _sorted_rows(d_cols, res.fetchall())


def test_assign_ids_wide(spark):
    """At sf0.01, where the order key tells all rows apart (at sf0.001 it doesn't)."""
    con = duckdb.connect()
    con.execute("CREATE VIEW lineitem AS SELECT * FROM '/root/testdata/sf0.01/lineitem.parquet'")
    df = E.queries()["assign_ids_wide"](spark, "/root/testdata/sf0.01").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "id")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({E.oracle_sql()['assign_ids_wide']})").fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)
