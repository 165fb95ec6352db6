"""A spread of registered queries against their SQL on the smallest tables; tools/check.py runs them all."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
KEYS = ["comparison_table", "colour_verdict", "coverage_status", "runner_up_support", "classify_lines", "size_bands", "template_match",
        "ring_measures", "edge_table", "label_to_polygon", "close_pairs", "side_checks", "walk_faces", "conform_targets", "stream_latest_verdict"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("key", KEYS)
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    df = entry.queries()[key](spark, SF)
    cols = sorted(df.columns)

    def plain(rows):
        return sorted(tuple((v is None, str(0.0 if v == 0 else v)) for v in r) for r in rows)
    cur = con.execute(entry.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = [tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()]
    assert plain(tuple(r[c] for c in cols) for r in df.collect()) == plain(want)


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
