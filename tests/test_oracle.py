"""Every query of the library's own operators against its SQL."""

import pytest
from oracle import differences

from crestline import catalog

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    df = catalog.queries()[name](spark, SF)
    if name in catalog.oracle_sql():
        assert not differences(df, catalog.oracle_sql()[name], SF)
    else:
        assert df.count() > 0
