"""Exact duplicates by deterministic block naming.

A text is cut into blocks of ``block_bytes`` bytes. Equal blocks get equal integer names: their
place in the sorted order of all distinct blocks. Then adjacent pairs of names are named the same
way, again and again, until each document has one name. Names stand for content without
collisions: two documents get the same name exactly if their texts are equal.

Sorting moves each distinct block once. Blocks are sorted by a 64-bit digest first and by content
within a digest; where a digest has one content (it practically always has), rows need only the
digest to find the name, else they are matched by content as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import fresh_name, numbered, own_store, whole_text, with_stable_row_id
from demandcast.sources.storage import Storage

BLOCK_BYTES = 4096


def _number(distinct: DataFrame, *order: str) -> DataFrame:
    """Integer names in sorted order: partition of the sort and place within it."""
    return distinct.orderBy(*order).withColumn("name", F.monotonically_increasing_id())


def _blocks(body: Column, block_bytes: int) -> Column:
    last = F.greatest(F.ceil(F.octet_length(body) / block_bytes), F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.substring(body, i.cast("int") * block_bytes + 1, block_bytes))


def name_documents(
    docs: DataFrame,
    store: Storage,
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    digest: Callable[[Column], Column] = F.xxhash64,
    row: str | None = None,
) -> DataFrame:
    """(row, doc_id, text_sha256, level, name): rows are equal in text exactly if (level, name) are.

    ``row`` numbers the rows of ``docs``; the argument names a column that has the numbers. A null text counts as empty, and an empty text is one
    empty block. An empty table gives no rows. ``digest`` may collide: that costs time only.
    """
    store = own_store(store)
    body = F.encode(whole_text(text), "UTF-8")
    base = numbered(docs, row, "doc_id", body.alias("body"))
    heads = store.table(
        "heads",
        base.select(
            "row",
            "doc_id",
            F.sha2("body", 256).alias("text_sha256"),
            F.transform(_blocks(F.col("body"), block_bytes), lambda b: digest(b)).alias("digests"),
        ),
    )
    contents = (
        base.select(F.explode(_blocks(F.col("body"), block_bytes)).alias("block"))
        .select(digest(F.col("block")).alias("digest"), "block")
        .distinct()
    )
    versions = store.table("versions", contents.groupBy("digest").agg(F.count("*").alias("versions")))
    clashing = versions.where("versions > 1").select("digest")
    placed = heads.select(
        "row", F.size("digests").cast("long").alias("blocks"), F.posexplode("digests").alias("at", "digest")
    ).withColumn("at", F.col("at").cast("long"))
    if clashing.isEmpty():
        placed = placed.withColumn("version", F.lit(1))
    else:
        ordered = contents.join(clashing, "digest", "left_semi").withColumn(
            "version", F.row_number().over(Window.partitionBy("digest").orderBy("block"))
        )
        found = (
            base.select("row", F.posexplode(_blocks(F.col("body"), block_bytes)).alias("at", "block"))
            .withColumn("digest", digest(F.col("block")))
            .join(ordered, ["digest", "block"])
            .select("row", F.col("at").cast("long").alias("at"), F.col("version").alias("found"))
        )
        placed = placed.join(found, ["row", "at"], "left").withColumn("version", F.coalesce("found", F.lit(1))).drop("found")
    names = _number(
        versions.select("digest", F.explode(F.sequence(F.lit(1), F.col("versions").cast("int"))).alias("version")),
        "digest",
        "version",
    )
    current = store.table(
        "level0", placed.join(store.table("names0", names), ["digest", "version"]).select("row", "blocks", "at", "name")
    )
    level, done = 0, []
    longest = current.agg(F.max("blocks")).first()[0] or 1
    while True:
        done.append(current.where("blocks = 1").select("row", F.lit(level).alias("level"), "name"))
        if longest <= 1:
            break
        level, longest = level + 1, (longest + 1) // 2
        even = F.col("at") % 2 == 0
        pairs = store.table(
            f"pairs{level}",
            current.where("blocks > 1")
            .groupBy("row", F.expr("at div 2").alias("at"), F.expr("(blocks + 1) div 2").alias("blocks"))
            .agg(
                F.max(F.when(even, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("right"),
            ),
        )
        names = store.table(f"names{level}", _number(pairs.select("left", "right").distinct(), "left", "right"))
        current = store.table(
            f"level{level}", pairs.join(names, ["left", "right"]).select("row", "blocks", "at", "name")
        )
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return heads.select("row", "doc_id", "text_sha256").join(named, "row")


def exact_groups(docs: DataFrame, store: Storage, **options) -> DataFrame:
    """Every row of ``docs`` with its group of equal texts: the row with the largest doc_id is kept.

    Returns row, doc_id, keep_id, group_size, kept, text_sha256. Of rows that share the largest
    doc_id one is kept; a null doc_id is the smallest. A group of any size costs one row in each
    task before the shuffle. Columns of ``docs`` other than doc_id and the text are ignored.
    """
    store = own_store(store)
    named = store.table("named", name_documents(docs, store, **options))
    groups = store.table(
        "groups",
        named.groupBy("level", "name").agg(
            F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")
        ),
    )
    return named.join(groups, ["level", "name"]).select(
        "row",
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, store: Storage, **options) -> DataFrame:
    """The kept rows of ``docs``, all columns. ``docs`` has to be a stored table: it is read again."""
    row = fresh_name(docs, "row")
    rows = with_stable_row_id(docs, row, store)
    kept = exact_groups(rows, store, row=row, **options).where("kept").select(F.col("row").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)
