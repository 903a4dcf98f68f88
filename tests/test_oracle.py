"""Every registered query against its SQL on DuckDB (the driver's check), at sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    if name in E.oracle_sql():
        assert res["match"], res
    else:
        assert res["rows"] >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["file_name", "y_coord", "x_coord", "forecast", "time", "measure_name", "measure_value"]
