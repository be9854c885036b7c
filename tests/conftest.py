import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from fareseg.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


def raw_frame(spark, lines):
    """(trip_id, line) from a list of strings."""
    return spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "trip_id long, line string")


GOOD = ("m1,h1,2013-01-07 08:15:00,2013-01-07 08:30:00,900,2.5,-73.98,40.75,-73.95,40.77,CSH,"
        "10.5,0.5,0.5,2.0,0,13.5")


def line_with(pos, value, base=GOOD):
    p = base.split(",")
    p[pos] = value
    return ",".join(p)
