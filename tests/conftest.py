from datetime import date

import pytest
from pyspark.sql import SparkSession

SALES = "chain_id long, store_id long, product_id long, sale_date date, qty double"
WEEKLY = "chain_id long, store_id long, product_id long, week_start date, weekly_total double"
ROWS = (
    "chain_id long, store_id long, product_id long, week_start date, "
    "actual double, pred_model double, pred_base double, forecast double"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def weekly(spark):
    """Build a weekly panel from ``{sku: {week: total}}``."""

    def build(totals):
        rows = [(*sku, week, float(x)) for sku, weeks in totals.items() for week, x in weeks.items()]
        return spark.createDataFrame(rows, WEEKLY)

    return build


@pytest.fixture
def forecast_rows(spark):
    def build(rows):
        return spark.createDataFrame(rows, ROWS)

    return build


def monday(n: int) -> date:
    """n-th Monday of a fixed calendar, from 2000-01-03."""
    return date.fromordinal(date(2000, 1, 3).toordinal() + 7 * n)
