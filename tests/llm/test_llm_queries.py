"""Every query of the subpackage against its SQL; queries without SQL have to give rows."""

import pytest
from conftest import same

from tessella.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, data, duck, name):
    df = queries.QUERIES[name](spark, data)
    if name in queries.SQL:
        same(df, duck, queries.SQL[name])
    else:
        assert df.count() > 0
