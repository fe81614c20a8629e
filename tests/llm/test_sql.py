"""Queries against their SQL, at two scales."""

from __future__ import annotations

import pytest

from tests.compare import connection, differences
from tillsight.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name, scale):
    folder = f"/root/testdata/{scale}"
    only_spark, only_sql, count = differences(QUERIES[name](spark, folder), connection(folder), SQL[name])
    assert not only_spark and not only_sql, (only_spark[:3], only_sql[:3])
    assert count > 0
