import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import SF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    found = SparkSession.getActiveSession()
    if found is not None:
        yield found
        return
    session = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="llm-")).config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="llm-")).getOrCreate())
    yield session
    session.stop()


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text) of the small table."""
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return [(r["doc_id"], r["text"]) for r in rows]
