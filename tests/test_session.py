"""Tables in the shared folder: read back, removed on demand and when the driver ends."""

import os
import subprocess
import sys

from linefold import session


def test_written_tables_can_be_removed(spark):
    df, path = session.written_at(spark.range(10).toDF("x"), "some")
    local = path.removeprefix("file://")
    assert df.count() == 10 and os.path.isdir(local)
    session.remove(spark, path)
    assert not os.path.exists(local) and path not in session._LEFT


def test_a_driver_that_ends_leaves_no_tables(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from linefold.session import written
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}").getOrCreate()
assert written(spark.range(3).toDF("x"), "left").count() == 3
import os
assert [x for x in os.listdir("{tmp_path}") if x.startswith("left-")]
spark.stop()
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, env=os.environ | {"PYTHONPATH": root}, timeout=120)
    assert not [x for x in os.listdir(tmp_path) if x.startswith("left-")]
