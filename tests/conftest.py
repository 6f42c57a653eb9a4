import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from lakeops.session import build_session  # noqa: E402
from lakeops.tables import Tables  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        spark_sql_shuffle_partitions="4", spark_driver_memory="8g", spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false", spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def t(spark):
    return Tables(spark, FOLDER)


def rows(df, *columns):
    """Sorted tuples of a small frame."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
