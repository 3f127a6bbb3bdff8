import glob
import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def oracle(spark):
    """Compare a query with its SQL over the smallest tables."""
    import duckdb

    def same(query, sql, sf=SF):
        con = duckdb.connect()
        for path in glob.glob(f"{sf}/*.parquet"):
            con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
        want = con.execute(sql)
        names = [d[0] for d in want.description]
        df = query(spark, sf)
        assert sorted(names) == sorted(df.columns)
        rows = [tuple(r) for r in df.select(*names).collect()]
        assert sorted(rows, key=str) == sorted(want.fetchall(), key=str)

    return same
