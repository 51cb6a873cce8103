import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master(f"local[{min(4, os.cpu_count())}]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", str(home / "shared")).config("spark.sql.warehouse.dir", str(home / "warehouse")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
