"""Session helpers: UTC pinning and the shared checkpoint root."""

from __future__ import annotations

from pageflow.session import checkpoint_root, scratch_path, use_utc


def test_use_utc_pins_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    use_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_checkpoint_root_comes_from_session(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/pageflow/x/")
