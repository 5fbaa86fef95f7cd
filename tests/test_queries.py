"""Every query of the document engine against its SQL, at the smallest scale."""

import glob
import os

import pytest

from quire.plans.report_queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(rows):
    return sorted((tuple(None if v is None or v != v else round(float(v), 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    if name not in ORACLE_SQL:
        assert got.count() > 0
        return
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{SF_DIR}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    names = sorted(got.columns)
    want = con.sql(f"select {', '.join(names)} from ({ORACLE_SQL[name]})").fetchall()
    assert plain(tuple(r) for r in got.select(*names).collect()) == plain(want)
