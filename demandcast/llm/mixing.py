"""Mixing sources to target weights by hash thresholds.

Each document has a 60-bit hash of its id. Per source, sizes are summed by the top bits of the
hash; running sums over these few buckets show in which bucket the source's budget ends. Only the
documents of that bucket are summed again by the next bits, and so on, until the threshold is
exact. A document is then taken by comparing its hash with its source's threshold, so nothing is
sorted, and a smaller budget takes a subset of what a larger one takes.

A budget above a source's size takes every document once and repeats the documents below the
threshold of the remainder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import WHITE_SPACE, fresh_name, numbered, own_store, whole_text, with_stable_row_id
from demandcast.operators.joins import lookup_join
from demandcast.sources.storage import Storage

HASH_BITS = 60
STEP_BITS = 12
#: Most times a document is taken.
REPEATS = 2


def word_count(text: str = "text") -> Column:
    words = F.split(whole_text(text), WHITE_SPACE)
    edge = F.when(F.element_at(words, 1) == "", 1).otherwise(0) + F.when(
        (F.size(words) > 1) & (F.element_at(words, -1) == ""), 1
    ).otherwise(0)
    return (F.size(words) - edge).cast("long")


def hash_of(doc_id: str = "doc_id") -> Column:
    """60 bits of the md5 of the id as text; a null id counts as the empty text."""
    digest = F.md5(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sources: DataFrame, store: Storage, share: float) -> DataFrame:
    """Budgets of (source, source_size, weight): add ``target``.

    ``share`` times all sizes is dealt by weight. A target stops at ``REPEATS`` times its source's
    size, and the excess is dealt again to the others by weight, until none is above. A null
    weight counts as 0; such sources, and all if the weights sum to nothing, get 0.
    """
    rows = sources.withColumn("weight", F.coalesce("weight", F.lit(0)).cast("double"))
    rows = rows.withColumns({"cap": REPEATS * F.col("source_size").cast("double"), "full": F.col("weight") < 0})
    rows = store.table("shares0", rows)
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * share
    round_ = 0
    while True:
        state = rows.agg(
            F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).alias("spent"),
            F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).alias("weight"),
        ).first()
        left, weight = total - (state["spent"] or 0.0), state["weight"] or 0.0
        fair = F.col("weight") * left / weight if weight else F.lit(0.0)
        over = ~F.col("full") & (fair > F.col("cap"))
        if not weight or rows.where(over).isEmpty():
            return rows.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(fair)).drop("cap", "full")
        round_ += 1
        rows = store.table(f"shares{round_}", rows.withColumn("full", F.col("full") | over))


def _thresholds(sized: DataFrame, budgets: DataFrame, store: Storage) -> DataFrame:
    """Per source: ``below``, the number of hashes taken from 0 on, for a sum nearest to ``budget``.

    ``budgets`` has skey, budget (0 to the source's size). Documents of one hash go together.
    """
    state = store.table(
        "open0", budgets.withColumns({"prefix": F.lit(0).cast("long"), "spent": F.lit(0).cast("long"), "final": F.lit(False)})
    )
    for step in range(1, HASH_BITS // STEP_BITS + 1):
        shift = HASH_BITS - step * STEP_BITS
        bucket = F.shiftright("hash", shift)
        if step == 1:
            inside = sized
        else:
            open_ = state.where("not final").select("skey", F.col("prefix").alias("open_prefix"))
            inside = lookup_join(sized, open_, ["skey"], ["row"], how="inner").where(
                F.shiftright("hash", shift + STEP_BITS) == F.col("open_prefix")
            )
        sums = inside.groupBy("skey", bucket.alias("bucket")).agg(
            F.sum("size").alias("size"), (F.min("hash") == F.max("hash")).alias("single")
        )
        running = Window.partitionBy("skey").orderBy("bucket")
        ahead = sums.withColumn("before", F.sum("size").over(running) - F.col("size")).join(
            state.where("not final").select("skey", "budget", "spent"), "skey"
        )
        crossing = (F.col("spent") + F.col("before") <= F.col("budget")) & (
            F.col("spent") + F.col("before") + F.col("size") > F.col("budget")
        )
        found = ahead.where(crossing).select(
            "skey",
            F.col("bucket").alias("new_prefix"),
            (F.col("spent") + F.col("before")).alias("new_spent"),
            F.col("size").alias("bucket_size"),
            "single",
        )
        joined = state.join(found, "skey", "left")
        whole = F.col("new_prefix").isNull() & ~F.col("final")  # nothing left to cross: all of it is taken
        single = F.coalesce("single", F.lit(False))
        nearer = F.col("budget") - F.col("new_spent") > F.col("new_spent") + F.col("bucket_size") - F.col("budget")
        # a bucket with one hash is taken or left as a whole, whichever comes nearer
        limit = F.shiftleft(F.col("new_prefix") + F.when(nearer, 1).otherwise(0), shift)
        state = store.table(
            f"open{step}",
            joined.select(
                "skey",
                "budget",
                F.when(F.col("final"), F.col("prefix"))
                .when(whole, F.lit(1 << HASH_BITS).cast("long"))
                .when(single, limit)
                .otherwise(F.col("new_prefix"))
                .alias("prefix"),
                F.coalesce("new_spent", "spent").alias("spent"),
                (F.col("final") | whole | single).alias("final"),
            ),
        )
        if state.where("not final").isEmpty():
            break
    return state.select("skey", F.col("prefix").alias("below"))


def take_shares(docs: DataFrame, weights: DataFrame, store: Storage, share: float = 1.5, row: str | None = None) -> DataFrame:
    """Every row of ``docs`` with how often it is taken.

    ``weights`` has source, weight: one row per source, null for a source that is null. Returns
    row, doc_id, source, size, source_size, target, times, taken. Sizes are words of whole texts,
    a null text has none. Rows of one doc_id go together. An empty table gives no rows; sources
    without words are taken no time. The sums per source come within one document of the target.
    """
    store = own_store(store)
    sized = store.table(
        "sized",
        numbered(docs, row, "doc_id", F.col("source").cast("string").alias("source"), "text").select(
            "row", "doc_id", "source", skey(F.col("source")).alias("skey"), word_count().alias("size"), hash_of().alias("hash")
        ),
    )
    totals = sized.groupBy("skey").agg(F.sum("size").alias("source_size"))
    given = weights.select(skey(F.col("source")).alias("skey"), F.col("weight"))
    targets = store.table("targets", source_targets(totals.join(given, "skey", "left"), store, share))
    once = F.col("target") >= F.col("source_size")
    rest = F.when(once, F.col("target") - F.col("source_size")).otherwise(F.col("target"))
    limits = _thresholds(sized, targets.select("skey", rest.alias("budget")), store)
    terms = store.table("terms", targets.join(limits, "skey").withColumn("once", once.cast("int")))
    known = terms.count()
    chosen = lookup_join(
        sized, terms.select("skey", "source_size", "target", "once", "below"), ["skey"], ["row"], how="inner", max_rows=known
    )
    times = F.when(F.col("size") == 0, F.col("once")).otherwise(
        F.col("once") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)
    )
    return chosen.withColumn("times", F.least(times, F.lit(REPEATS))).select(
        "row", "doc_id", "source", "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken")
    )


def skey(source: Column) -> Column:
    """A join key for a source that may be null."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source))


def repeating_weights(docs: DataFrame, weights: list[int]) -> DataFrame:
    """(source, weight): the sources in code point order, null last, given ``weights`` in turn.

    The order is found by ranges of the distinct sources, not in one task.
    """
    sources = docs.select(F.col("source").cast("string").alias("source")).distinct()
    order = [F.col("source").isNull(), F.col("source")]
    ranged = sources.orderBy(*order).withColumn("place", F.monotonically_increasing_id())
    part = F.shiftright("place", 33)
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    counts = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.col("offset") + F.col("within")
    turn = F.pmod(rank, F.lit(len(weights))).cast("int")
    return (
        ranged.select("source", part.alias("part"), within.alias("within"))
        .join(offsets, "part")
        .select("source", F.get(F.array(*[F.lit(w) for w in weights]), turn).alias("weight"))
    )


def mix_sources(docs: DataFrame, weights: DataFrame, store: Storage, share: float = 1.5) -> DataFrame:
    """The rows of ``docs`` that the mix takes, repeated as often as it takes them; all columns.

    ``docs`` has to be a stored table: it is read again.
    """
    row = fresh_name(docs, "row")
    times = fresh_name(docs, "times")
    rows = with_stable_row_id(docs, row, store)
    chosen = take_shares(rows, weights, store, share, row).where("times > 0")
    chosen = chosen.select(F.col("row").alias(row), F.col("times").alias(times))
    joined = rows.join(chosen, row)
    nth = fresh_name(docs, "nth")
    return joined.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
