from datetime import date

import pytest
from pyspark.sql import functions as F

from demandcast.sources.sinks import (
    append_bias_log,
    final_output,
    jdbc_write_options,
    model_path,
    replace_window,
    upload_projection,
    write_bias_table,
    write_forecast,
    write_replace_window,
)
from tests.conftest import monday


def test_rounding_is_half_even_and_never_negative(spark, forecast_rows):
    values = [0.5, 1.5, 2.5, -0.5, None, -3.0]
    rows = forecast_rows([(1, 1, i, monday(0), v, 0.0, 0.0, v) for i, v in enumerate(values)])
    out = final_output(rows, monday(0), monday(0)).orderBy("product_id").collect()
    assert [r.forecast for r in out] == [0, 2, 2, 0, 0, 0]
    assert [r.actual for r in out] == [0, 2, 2, 0, 0, 0]


def test_output_window_order_and_integer_dates(forecast_rows):
    rows = forecast_rows([(c, 1, 1, monday(w), 1.0, 1.0, 1.0, 1.0) for c in (2, 1) for w in (2, 1, 0)])
    out = final_output(rows, monday(1), monday(2), date_as_int=True).collect()
    assert [(r.week_start, r.chain_id) for r in out] == [(20000110, 1), (20000110, 2), (20000117, 1), (20000117, 2)]


def test_upload_projection_normalises(spark):
    rows = spark.createDataFrame(
        [("20250901", "1", 2, 3, None), ("2025-09-08", "x", 2, 3, 1.5), ("soon", "1", 2, 3, 2.0)],
        "week_start string, chain_id string, store_id int, product_id int, forecast double",
    )
    got = [tuple(r) for r in upload_projection(rows).collect()]
    assert got == [(20250901, 1, 2, 3, 0.0), (20250908, 0, 2, 3, 1.5), (0, 1, 2, 3, 2.0)]
    assert upload_projection(rows, algo_id=7).columns[-2:] == ["algo_id", "supplier_id"]
    with pytest.raises(ValueError, match="forecast"):
        upload_projection(rows.drop("forecast"))


def _upload(spark, rows):
    return spark.createDataFrame(rows, "date_key int, chain_id long, store_id long, product_id long, forecast double, algo_id int")


def test_replace_window_keeps_other_algorithms(spark, tmp_path):
    old = _upload(spark, [(1, 1, 1, 1, 1.0, 1), (2, 1, 1, 1, 1.0, 1), (1, 1, 1, 1, 1.0, 2), (1, 1, 1, 2, 1.0, 1)])
    new = _upload(spark, [(1, 1, 1, 1, 9.0, 1)])
    expected = [(1, 9.0, 1), (1, 1.0, 2), (2, 1.0, 1)]
    got = replace_window(old, new).select("date_key", "forecast", "algo_id").collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    path = str(tmp_path / "target")
    write_replace_window(old, path)
    write_replace_window(new, path)
    stored = spark.read.parquet(path).select("date_key", "forecast", "algo_id").collect()
    assert sorted(map(tuple, stored)) == sorted(expected)


def test_forecast_and_bias_files(spark, tmp_path, forecast_rows):
    rows = final_output(forecast_rows([(1, 1, 1, monday(0), 1.0, 1.0, 1.0, 1.0)]), monday(0), monday(0))
    write_forecast(rows, str(tmp_path / "f"))
    write_forecast(rows, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).count() == 1
    write_forecast(rows, str(tmp_path / "c"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == rows.columns
    bias = spark.createDataFrame([(1, 9, 1.05)], "chain_id long, month_num int, bias_factor double")
    write_bias_table(bias, str(tmp_path / "b"))
    for day in (1, 2):
        append_bias_log(bias, date(2025, 9, day), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1
    assert spark.read.parquet(str(tmp_path / "log")).select(F.count_distinct("run_date")).first()[0] == 2


def test_options_and_paths():
    assert jdbc_write_options("jdbc:x", "u", "p", "t")["batchsize"] == "500"
    with pytest.raises(ValueError, match="table"):
        jdbc_write_options("jdbc:x", "u", "p", "")
    assert model_path("m", date(2025, 9, 1)) == "m/model_202508"
    assert model_path("m", date(2025, 1, 1)) == "m/model_202412"
