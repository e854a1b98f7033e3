"""Every query on odd and empty tables; against SQL where there is SQL."""

import glob

import duckdb
import pytest

from nightgrid.llm.catalog import QUERIES, SQL
from tests.oracle import canonical

ONE_ROW_EACH = {
    k: "pages" if k in ("op3_warc", "op8_url_filters") else "documents" for k in QUERIES if not k.startswith(("op10", "op11", "op12"))
}


def connect(path):
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        found = f"{path}/{name}.parquet"
        files = glob.glob(f"{found}/*.parquet") or [found]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet({files})")
    return con


@pytest.mark.parametrize("key", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    result = connect(sf_dir).execute(SQL[key])
    names = [d[0] for d in result.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, result.fetchall())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_odd_tables_give_a_row_for_each(spark, odd_dir, key):
    n = QUERIES[key](spark, odd_dir).count()
    if key in ONE_ROW_EACH:
        assert n == spark.read.parquet(f"{odd_dir}/{ONE_ROW_EACH[key]}.parquet").count()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, key):
    assert QUERIES[key](spark, empty_dir).count() == 0
