"""Every oracle-checked query equals its DuckDB SQL on the small tables."""

import math

import pytest

from oracle_compare import duck, norm, rows
from shelfcast.plans.registry import ORACLE, QUERIES

from conftest import SF_SMALL

# Queries compared with a relative tolerance instead of bit for bit (none:
# z-scores use exact moments, money exact decimal sums).
NEAR: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    ddf = con.execute(ORACLE[name]).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert len(sdf) == len(ddf)
    if name in NEAR:
        cols = sorted(sdf.columns)
        a = sdf[cols].sort_values(cols[-4:]).reset_index(drop=True)
        b = ddf[cols].sort_values(cols[-4:]).reset_index(drop=True)
        for c in cols:
            for x, y in zip(a[c], b[c]):
                x, y = norm(x), norm(y)
                if isinstance(x, float):
                    assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12)
                else:
                    assert x == y
        return
    assert rows(sdf) == rows(ddf)
