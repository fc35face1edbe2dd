from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from episodica.session import session

    out = session("local[4]", spark_sql_shuffle_partitions="4", spark_driver_memory="4g", spark_ui_enabled="false")
    out.sparkContext.setLogLevel("ERROR")
    out.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield out
    out.stop()
