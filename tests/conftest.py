import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salescast.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_sales(spark):
    from salescast.sources import star
    from salescast.staging import materialize

    return materialize(star.sales(spark, SF), "test-sales")


@pytest.fixture(scope="session")
def processed(raw_sales):
    from salescast.operators.daily import daily_brand_summary
    from salescast.sources import star

    return daily_brand_summary(raw_sales, star.TIE_BREAK)


@pytest.fixture(scope="session")
def processed_series(processed):
    from salescast import schema as S
    from salescast.operators.series import brand_series
    from salescast.staging import materialize

    return materialize(brand_series(processed, S.DECOMPOSABLE_REGRESSORS), "test-series")
