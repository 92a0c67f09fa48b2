"""Every registered query of the library against its SQL on the smallest tables."""

import decimal
import math

import pytest

from tests.conftest import SF
from tidewell.plans import catalogue


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in catalogue.oracle_sql():
        assert rows
        return
    cursor = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert rows == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


def test_every_key_of_the_oracle_is_a_query():
    assert catalogue.oracle_sql().keys() <= catalogue.queries().keys()
