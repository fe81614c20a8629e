from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillsight.sources.session import configure

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_SMALL).exists():
        pytest.skip("benchmark tables not present")
    return SF_SMALL


def rows(df, *order):
    """Rows as tuples, sorted, nulls first."""
    out = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))
