import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketlens.session import build_session  # noqa: E402

ORDER = ("order_id long, user_id long, eval_set string, order_number long, order_dow int, "
         "order_hour_of_day int, days_since_prior_order double")
LINE = ("order_id long, product_id long, add_to_cart_order int, reordered int, user_id long, "
        "order_number long, eval_set string")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def lines(spark):
    """Baskets {1,2,3}, {1,2}, {2,3} of prior orders."""
    rows = [(10, 1, 1, 0, 100, 1, "prior"), (10, 2, 2, 0, 100, 1, "prior"),
            (10, 3, 3, 0, 100, 1, "prior"), (11, 1, 1, 1, 100, 2, "prior"),
            (11, 2, 2, 1, 100, 2, "prior"), (12, 2, 1, 0, 200, 1, "prior"),
            (12, 3, 2, 0, 200, 1, "prior")]
    return spark.createDataFrame(rows, LINE)


@pytest.fixture
def products(spark):
    rows = [(1, "A", 101, 1), (2, "B", 101, 1), (3, "C", 201, 2), (4, "Unseen", 201, 2)]
    return spark.createDataFrame(
        rows, "product_id long, product_name string, aisle_id long, department_id long")


@pytest.fixture
def aisles(spark):
    return spark.createDataFrame([(101, "x"), (201, "y")], "aisle_id long, aisle string")


@pytest.fixture
def departments(spark):
    return spark.createDataFrame([(1, "d1"), (2, "d2")],
                                 "department_id long, department string")


def rows(df, *columns):
    """Sorted tuples of a frame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
