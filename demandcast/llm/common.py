"""What the corpus operators share: columns, words, row identity and per-task helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.sources.storage import Storage

# words are runs of anything but space, tab, newline, vertical tab, form feed and carriage return
WHITE_SPACE = "[\\x20\\x09-\\x0D]+"
#: What ``bytes.split()`` splits on is exactly that set; this table lower-cases A-Z and nothing else.
LOWER_ASCII = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh_name(rows: DataFrame, wanted: str) -> str:
    """A column name that ``rows`` has not, whatever the case."""
    taken = {c.lower() for c in rows.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_row_id(rows: DataFrame, name: str) -> DataFrame:
    """Number rows by partition and position, so that repeated rows stay apart.

    The numbers are the same each time a stored table is read; give the operators stored tables.
    """
    return rows.withColumn(name, F.monotonically_increasing_id())


def is_scan(rows: DataFrame) -> bool:
    """Whether ``rows`` are those of one Parquet scan, with columns chosen or computed at most."""
    plan = rows._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "SubqueryAlias", "View") and plan.children().size() == 1:
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation" and "parquet" in plan.toString().lower()


def with_stable_row_id(rows: DataFrame, name: str, store: Storage) -> DataFrame:
    """Number rows so that each keeps its number however a later scan is split.

    A number is the place of the row's Parquet file among the sorted names and the row's place in the
    file. Rows that are not just a scan of Parquet files are stored with their numbers.
    """
    if not is_scan(rows):
        return own_store(store).table("numbered", with_row_id(rows, name))
    meta = rows.metadataColumn("_metadata")
    path, index = fresh_name(rows, "file_path"), meta.getField("row_index")
    files = sorted(r[0] for r in rows.select(meta.getField("file_path")).distinct().collect())
    if len(files) <= 1:
        return rows.withColumn(name, index)
    places = rows.sparkSession.createDataFrame(list(enumerate(files)), f"place_ long, {path} string")
    held = rows.select("*", meta.getField("file_path").alias(path), index.alias(name))
    numbered = held.join(F.broadcast(places), path)
    return numbered.withColumn(name, F.shiftleft("place_", 40) + F.col(name)).select(*rows.columns, name)


def numbered(docs: DataFrame, row: str | None, *columns: Column | str) -> DataFrame:
    """``row`` and these columns of ``docs``; numbers come from its column ``row``, else from this scan."""
    if row is None:
        return with_row_id(docs.select(*columns), "row")
    return docs.select(F.col(row).alias("row"), *columns)


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(folds)).cast("int")


def lower_words(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8").translate(LOWER_ASCII).split()


def slices(items: list, size: int) -> Iterable[list]:
    for at in range(0, len(items), size):
        yield items[at : at + size]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def own_store(store: Storage) -> Storage:
    """A place below ``store`` for the tables of one operator call; it goes when ``store`` is dropped."""
    return Storage(store.spark, store.folder)
