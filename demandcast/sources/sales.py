"""Raw sales readers: database, CSV and stored tables, all to the same typed columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.operators.panel import clean_sales

SALES_SCHEMA = T.StructType(
    [
        T.StructField("chain_id", T.LongType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("qty", T.DoubleType()),
    ]
)

# fixed values: column names of sales sources and the names used here
SOURCE_NAMES = {
    "DateKey": "sale_date",
    "Date": "sale_date",
    "Cadena": "chain_id",
    "Tienda": "store_id",
    "Producto": "product_id",
    "Cantidad": "qty",
    "IND_29018": "qty",
    "RIDIM_29107KEY": "chain_id",
    "RIDIM_29038KEY": "store_id",
    "RIDIM_29039KEY": "product_id",
}

# fixed values: quantity columns of a CSV in order of preference
QUANTITY_NAMES = ("Cantidad", "Quantity", "Qty", "Actual")

# fixed values: source columns of the sales fact table
FACT_COLUMNS = ("DateKey", "RIDIM_29107KEY", "RIDIM_29038KEY", "RIDIM_29039KEY", "IND_29018")


def require_columns(rows: DataFrame, names: Iterable[str]) -> None:
    """Fail before any job runs if columns are missing."""
    missing = sorted(set(names) - set(rows.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; found {rows.columns}")


def norm_columns(rows: DataFrame, names: Mapping[str, str] = SOURCE_NAMES) -> DataFrame:
    """Rename source columns; names that are absent are ignored, unknown columns kept."""
    return rows.withColumnsRenamed({k: v for k, v in names.items() if k in rows.columns})


def quantity_column(columns: Iterable[str], candidates: Iterable[str] = QUANTITY_NAMES) -> str:
    """First candidate that is present."""
    present = set(columns)
    for name in candidates:
        if name in present:
            return name
    raise ValueError(f"no quantity column, expected one of {list(candidates)}; found {sorted(present)}")


def typed_sales(rows: DataFrame) -> DataFrame:
    """Source rows with any of the known column names to clean, typed sales."""
    named = norm_columns(rows)
    require_columns(named, SALES_SCHEMA.names)
    return clean_sales(named.select(*SALES_SCHEMA.names))


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header. Headers may be padded; rows with a bad date or id are dropped."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    require_columns(raw, ["Date", "Cadena", "Tienda", "Producto"])
    quantity = quantity_column(raw.columns)
    return typed_sales(raw.select("Date", "Cadena", "Tienda", "Producto", F.col(quantity).alias("qty")))


def read_sales_parquet(spark: SparkSession, path: str) -> DataFrame:
    return typed_sales(spark.read.parquet(path))


def jdbc_read_options(
    url: str,
    user: str,
    password: str,
    query: str,
    first_key: int | None = None,
    last_key: int | None = None,
    partitions: int | None = None,
    date_column: str = "DateKey",
    fetch_size: int = 10_000,
    connect_timeout_seconds: int = 15,
) -> dict[str, str]:
    """Options of a JDBC read. With key bounds the read is split by date key into parallel queries."""
    given = {"url": url, "user": user, "password": password, "query": query}
    absent = sorted(k for k, v in given.items() if not v)
    if absent:
        raise ValueError(f"missing parameters {absent}")
    options = {
        "url": url,
        "user": user,
        "password": password,
        "fetchsize": str(fetch_size),
        "connectTimeout": str(connect_timeout_seconds * 1000),
    }
    split = (first_key, last_key, partitions)
    if all(v is None for v in split):
        return {**options, "query": query}
    if any(v is None for v in split):
        raise ValueError("first_key, last_key and partitions go together")
    # a partitioned read takes a table, so the query becomes a derived table
    return {
        **options,
        "dbtable": f"({query}) AS sales",
        "partitionColumn": date_column,
        "lowerBound": str(first_key),
        "upperBound": str(last_key),
        "numPartitions": str(partitions),
    }


def fact_query(table: str) -> str:
    """Query of the sales fact table."""
    return f"SELECT {', '.join(FACT_COLUMNS)} FROM {table}"


def read_sales_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Sales from a database; a failing connection raises."""
    return typed_sales(spark.read.format("jdbc").options(**options).load())
