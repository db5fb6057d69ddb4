import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# Whole-catalog comparisons, the bench and streams: ``pytest -m "not slow"`` is the inner loop.
SLOW_MODULES = ("test_io_oracle", "test_bench_contract", "test_streaming_schemas", "test_windows_property", "test_layers")


def pytest_configure(config):
    config.addinivalue_line("markers", "slow: whole-catalog, bench, streaming and layer tests")


def pytest_collection_modifyitems(items):
    for item in items:
        if item.path.stem in SLOW_MODULES or item.path.parent.name == "llm":
            item.add_marker(pytest.mark.slow)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidemark.session import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[4]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidemark-test-wh-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidemark-test-")


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when none given)."""
    cols = cols or tuple(df.columns)
    data = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(data, key=lambda t: tuple((v is not None, v) for v in t))
