import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from basketry.session import local_session
    s = local_session(cores=int(os.environ.get("TEST_CPUS", "4")), shuffle_partitions=4, app="basketry-tests")
    yield s


@pytest.fixture(scope="session")
def small_inputs(spark):
    from basketry.sources.testdata import test_inputs
    return test_inputs(spark, SF_SMALL)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


CUST_SCHEMA = ("customer_id string, signup_date timestamp, cohort string, gender string, "
               "age_group string, acquisition_channel string, loyalty_status string")
ORDER_SCHEMA = ("order_id string, customer_id string, order_date timestamp, "
                "order_amount decimal(18,2), discount_amount decimal(18,2), "
                "order_status string, payment_method string")
ITEM_SCHEMA = "order_item_id string, order_id string, product_id string, quantity bigint, price decimal(18,2)"
