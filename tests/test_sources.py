from datetime import date

import pytest
from pyspark.sql import functions as F

from demandcast.operators.panel import clean_sales
from demandcast.sources.history import (
    FORECAST_SCHEMA,
    append_history,
    empty_forecast,
    read_forecasts_csv,
    read_history,
    write_history_upsert,
)
from demandcast.sources.sales import (
    fact_query,
    jdbc_read_options,
    norm_columns,
    quantity_column,
    read_sales_csv,
    read_sales_parquet,
    require_columns,
    typed_sales,
)


def test_messy_csv(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(
        " Date,Cadena , Tienda,Producto,Qty\n"
        "20250901,1,2,3,5\n"
        "2025-09-01,1,2,3,4.5\n"
        "x,1,2,3,1\n"
        "2025-09-02,1,2,3,-7\n"
        "2025-09-03,1,2,3,many\n"
        "2025-09-04,1,2,3,\n"
        "2025-09-05,,2,3,1\n"
        "2025-02-30,1,2,3,1\n"
    )
    rows = [tuple(r) for r in read_sales_csv(spark, str(path)).orderBy("sale_date", "qty").collect()]
    assert rows == [
        (1, 2, 3, date(2025, 9, 1), 4.5),
        (1, 2, 3, date(2025, 9, 1), 5.0),
        (1, 2, 3, date(2025, 9, 2), 0.0),
        (1, 2, 3, date(2025, 9, 3), 0.0),
        (1, 2, 3, date(2025, 9, 4), 0.0),
    ]


def test_csv_without_ids_or_quantity_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date,Cadena,Tienda,Qty\n")
    (tmp_path / "b.csv").write_text("Date,Cadena,Tienda,Producto,Amount\n")
    with pytest.raises(ValueError, match="Producto"):
        read_sales_csv(spark, str(tmp_path / "a.csv"))
    with pytest.raises(ValueError, match="quantity"):
        read_sales_csv(spark, str(tmp_path / "b.csv"))


def test_quantity_column_preference():
    assert quantity_column(["Actual", "Qty"]) == "Qty"
    assert quantity_column(["Actual", "Cantidad"]) == "Cantidad"
    assert quantity_column(["Actual"]) == "Actual"


def test_fact_columns_are_renamed(spark, tmp_path):
    fact = spark.createDataFrame(
        [(20250901, 1, 2, 3, 4.0)],
        "DateKey int, RIDIM_29107KEY int, RIDIM_29038KEY int, RIDIM_29039KEY int, IND_29018 double",
    )
    assert [tuple(r) for r in typed_sales(fact).collect()] == [(1, 2, 3, date(2025, 9, 1), 4.0)]
    fact.write.parquet(str(tmp_path / "fact"))
    assert read_sales_parquet(spark, str(tmp_path / "fact")).count() == 1
    kept = norm_columns(fact.withColumnRenamed("IND_29018", "other"))
    assert "other" in kept.columns


def test_missing_columns_fail_before_any_job(spark):
    with pytest.raises(ValueError, match="qty"):
        require_columns(spark.range(1), ["id", "qty"])


def test_cleaning_keeps_dates_and_drops_bad_ids(spark):
    raw = spark.createDataFrame(
        [("1", "2", "3", "20250901", "NaN"), ("a", "2", "3", "20250901", "1"), ("1", "2", "3", "20251301", "1")],
        "chain_id string, store_id string, product_id string, sale_date string, qty string",
    )
    assert [tuple(r) for r in clean_sales(raw).collect()] == [(1, 2, 3, date(2025, 9, 1), 0.0)]


def test_jdbc_options():
    plain = jdbc_read_options("jdbc:x", "u", "p", "SELECT 1")
    assert plain["query"] == "SELECT 1" and plain["connectTimeout"] == "15000" and "dbtable" not in plain
    split = jdbc_read_options("jdbc:x", "u", "p", fact_query("sales"), 20240101, 20251231, 64)
    assert split["dbtable"].startswith("(SELECT DateKey") and split["numPartitions"] == "64"
    assert split["partitionColumn"] == "DateKey" and "query" not in split
    with pytest.raises(ValueError, match="password"):
        jdbc_read_options("jdbc:x", "u", "", "SELECT 1")
    with pytest.raises(ValueError, match="together"):
        jdbc_read_options("jdbc:x", "u", "p", "SELECT 1", first_key=1)


def _run(spark, *weeks):
    return spark.createDataFrame([(w, 1, 1, 1, 0, 7, 1.0, 2.0) for w in weeks], FORECAST_SCHEMA)


def test_history_append_and_read(spark, tmp_path):
    path = str(tmp_path / "history")
    assert read_history(spark, path, date(2025, 9, 10)).count() == 0
    append_history(_run(spark, date(2025, 9, 1)), date(2025, 9, 1), path)
    append_history(_run(spark, date(2025, 9, 8)), date(2025, 9, 8), path)
    assert read_history(spark, path, date(2025, 9, 8)).count() == 1
    assert read_history(spark, path, date(2025, 9, 9)).count() == 2


def test_history_upsert_replaces_overlap_and_survives_a_second_run(spark, tmp_path):
    path, run_day = str(tmp_path / "history"), date(2025, 9, 9)
    weeks = [date(2025, 9, d) for d in (1, 8, 15, 22)]
    write_history_upsert(_run(spark, *weeks), date(2025, 9, 1), path)
    untouched = [f.name for f in (tmp_path / "history" / "week_start=2025-09-01").iterdir()]
    for _ in range(2):
        # what is written may come from the history itself; the week that the new run lacks goes
        new = read_history(spark, path, date(2025, 9, 30)).drop("forecast_run_date").where(F.col("week_start").isin(weeks[1:3]))
        write_history_upsert(new.select(*FORECAST_SCHEMA.names), run_day, path)
        rows = read_history(spark, path, date(2025, 9, 30)).orderBy("week_start").select("week_start", "forecast_run_date")
        assert [tuple(r) for r in rows.collect()] == [(weeks[0], date(2025, 9, 1)), (weeks[1], run_day), (weeks[2], run_day)]
    assert untouched == [f.name for f in (tmp_path / "history" / "week_start=2025-09-01").iterdir()]
    write_history_upsert(_run(spark), run_day, path)
    assert read_history(spark, path, date(2025, 9, 30)).count() == 3


def test_empty_forecast_has_the_output_columns(spark):
    assert empty_forecast(spark).schema == FORECAST_SCHEMA


def test_forecast_files_in_csv_form(spark, tmp_path):
    path = str(tmp_path / "history.csv")
    with open(path, "w") as out:
        out.write("Date,Cadena,Tienda,Producto,Actual,Forecast,forecast_run_date\n")
        out.write("2025-09-01,1,2,3,4,5,2025-08-25\n20250908,1,2,3,,x,2025-09-08\nsoon,1,2,3,4,5,2025-08-25\n")
    rows = read_history(spark, path, date(2025, 9, 8), "csv").collect()
    assert [(r.week_start, r.forecast) for r in rows] == [(date(2025, 9, 1), 5.0), (None, 5.0)]
    typed = [tuple(r) for r in read_forecasts_csv(spark, path).collect()]
    assert typed == [(date(2025, 9, 1), 1, 2, 3, 5.0), (date(2025, 9, 8), 1, 2, 3, 0.0)]
