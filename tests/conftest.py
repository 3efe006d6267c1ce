import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TESTDATA = Path("/root/testdata")
TABLES = ["customer", "nation", "events"]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidepool-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def damaged_dir(tmp_path_factory):
    """sf0.001 with the defects real drops have, and one user and one id far too frequent."""
    folder = tmp_path_factory.mktemp("damaged")
    con = duckdb.connect()
    for name in ("customer", "nation"):
        con.execute(f"COPY (FROM '{TESTDATA}/sf0.001/{name}.parquet') TO '{folder}/{name}.parquet'")
    con.execute(
        f"""
        CREATE TABLE e AS FROM '{TESTDATA}/sf0.001/events.parquet';
        COPY (
          FROM e
          -- copies of events: later, or of another type, or by nobody
          UNION ALL SELECT event_id, ts + INTERVAL 1 HOUR, user_id, event_type, value, props FROM e WHERE event_id < 200
          UNION ALL SELECT event_id, ts, user_id, 'error', value, props FROM e WHERE event_id BETWEEN 100 AND 250
          UNION ALL SELECT event_id, ts - INTERVAL 1 HOUR, NULL, event_type, value, props FROM e WHERE event_id BETWEEN 300 AND 330
          -- defects of their own
          UNION ALL SELECT NULL, ts, user_id, event_type, value, props FROM e WHERE event_id < 40
          UNION ALL SELECT 10000 + event_id, ts, NULL, event_type, value, props FROM e WHERE event_id < 50
          UNION ALL SELECT 20000 + event_id, NULL, user_id, event_type, value, props FROM e WHERE event_id < 30
          UNION ALL SELECT 30000 + event_id, ts + INTERVAL 60 DAY, user_id, event_type, value, props FROM e WHERE event_id < 30
          UNION ALL SELECT 40000 + event_id, ts, 10000000, event_type, value, props FROM e WHERE event_id < 30
          UNION ALL SELECT 50000 + event_id, ts, user_id, event_type, value, NULL FROM e WHERE event_id < 30
          -- a third of all rows each: one user, one event id
          UNION ALL SELECT 60000 + event_id, ts, 3, event_type, value, props FROM e
          UNION ALL SELECT 99999, ts, user_id, event_type, value, props FROM e
        ) TO '{folder}/events.parquet'
        """
    )
    return str(folder)
