"""Every core query against its SQL; queries without SQL have to give rows."""

import pytest
from conftest import same

from tessella.plans import catalogue

ALL = {n: f for m in catalogue.MODULES for n, f in m.QUERIES.items()}
SQL = {n: s for m in catalogue.MODULES for n, s in m.SQL.items()}


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, data, duck, name):
    df = ALL[name](spark, data)
    if name in SQL:
        same(df, duck, SQL[name])
    else:
        assert df.count() > 0


def test_flagship(spark, data):
    assert catalogue.flagship(spark, data).count() > 0
