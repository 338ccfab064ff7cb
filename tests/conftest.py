import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from centrix.session import get_spark
    s = get_spark(master="local[4]", app="centrix-tests", shuffle_partitions=4, driver_memory="4g")
    yield s
    s.stop()


def pts(spark, rows, dtype="bigint"):
    return spark.createDataFrame([(i + 1, [v for v in r]) for i, r in enumerate(rows)],
                                 f"point_id BIGINT, coord ARRAY<{dtype.upper()}>")


def cents(spark, rows):
    return spark.createDataFrame([(i + 1, [float(v) for v in r]) for i, r in enumerate(rows)],
                                 "cluster_id INT, coord ARRAY<DOUBLE>")
