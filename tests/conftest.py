from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pageflow.session import get_session

    extra = {}
    if not os.environ.get("PAGEFLOW_KEEP_CHECKPOINT_DIR"):
        # tests use their own scratch root (only where the setting would be unset on a cluster)
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="pageflow-tests-")
    session = get_session("local[4]", 8, "pageflow-tests", extra)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EVENT_DDL = ("domain string, page_id long, page_title string, user_id long, user_name string, "
             "is_bot boolean, created_at string, title_length int")


def make_events(spark, rows):
    """Canonical events from tuples (domain, page_id, title, user_id, user_name, is_bot, created_at[, length]).

    created_at is 'YYYY-MM-DD HH:MM:SS[.ffffff]' UTC wall clock -> TIMESTAMP_NTZ.
    A missing length is computed from the title.
    """
    from pyspark.sql import functions as F

    full = []
    for r in rows:
        r = tuple(r)
        if len(r) == 7:
            r = r + ((len(r[2]) if r[2] is not None else None),)
        full.append(r)
    df = spark.createDataFrame(full, EVENT_DDL)
    return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
