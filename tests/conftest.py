import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vintara.plans.medallion import RECOMMENDED  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]")
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.driver.memory": "4g",
    }
    for name, value in {**RECOMMENDED, **local}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path):
    """A catalogue schema of its own for one test."""
    from vintara.sources.tables import ensure_schema

    name = f"t_{abs(hash(str(tmp_path))):x}"
    ensure_schema(spark, name, str(tmp_path / "tables"))
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def as_tuples(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    return as_tuples
