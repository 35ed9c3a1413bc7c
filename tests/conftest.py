import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from terracheck.session import local_session

    s = local_session("*", shuffle_partitions=8, app="terracheck-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def assets_small(spark):
    from terracheck.sources.assets import load_assets

    return load_assets(spark, SF_SMALL).cache()


@pytest.fixture(scope="session")
def edges_small(spark):
    from terracheck.sources.assets import read_table
    from terracheck.sources.polygons import grid_country_edges

    return grid_country_edges(read_table(spark, SF_SMALL, "nation")).cache()
