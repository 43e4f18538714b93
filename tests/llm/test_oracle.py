"""The operators that SQL can express against their DuckDB SQL."""

import os

import pytest

from lakestrata.llm.sql import ORACLE
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF, duck(SF))
    assert r["status"] in ("exact", "close") and "type_diff" not in r, r
