"""Document fingerprints by one-permutation MinHash.

Each shingle of a text is hashed once. The top bits of the hash choose one of ``bins`` bins, the
smallest hash of a bin is its value. An empty bin takes the value of another bin: it looks at the
bins in an order of its own, given by a hash, and copies the first that is not empty (optimal
densification). Of each value the ``bits`` lowest bits are kept, packed into 64-bit integers.

Two texts agree in a bin with probability J + (1 - J) / 2^bits, J being the Jaccard similarity of
their shingle sets; ``likeness`` corrects for the second term.

All of it is column expressions within one row: nothing is exploded or shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandcast.llm.common import WHITE_SPACE, partitions, whole_text

SHINGLE = 5
BINS = 256
BITS = 4
#: Bins an empty bin looks at one by one before it ranks all of them.
PROBES = 16


def _log2(n: int) -> int:
    if n < 2 or n & (n - 1):
        raise ValueError(f"{n} is not a power of two")
    return n.bit_length() - 1


def _bin(value: Column, bins: int) -> Column:
    """0 .. bins-1 from the top bits, ascending with the signed value."""
    return (F.shiftright(value, 64 - _log2(bins)) + bins // 2).cast("int")


def _highest(bins: int) -> Column:
    """The largest value of each bin, in order. It marks a bin as empty."""
    width = 64 - _log2(bins)
    return F.array(*[F.lit(((i - bins // 2) << width) + (1 << width) - 1).cast("long") for i in range(bins)])


def _shingles(words: Column, length: int) -> Column:
    """Hashes of runs of ``length`` words; of all words if there are fewer; none without words."""
    hashes = F.get(words, F.lit(0))
    runs = F.transform(
        F.sequence(F.lit(0), F.size(words) - length),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(length)]),
    )
    none = F.array().cast("array<bigint>")
    return (
        F.when(hashes.isNull(), none)
        .when(F.size(words) < length, F.array(F.xxhash64(words)))
        .otherwise(runs)
    )


def with_fingerprint(
    rows: DataFrame, text: str, name: str, shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS
) -> DataFrame:
    """Add column ``name``: array<bigint> of ``bins * bits / 64`` packed integers, empty for a text without words.

    Words are runs of non-space characters in lower case. Equal texts have equal fingerprints.
    Null texts count as empty.
    """
    if 64 % bits or bins * bits % 64:
        raise ValueError("bits has to divide 64, and the bins have to fill 64-bit integers")
    per, width = 64 // bits, 64 - _log2(bins)
    words, held, full = f"{name}__words", f"{name}__held", f"{name}__full"
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WHITE_SPACE), lambda w: w != "")
    rows = rows.withColumn(words, F.transform(tokens, lambda w: F.xxhash64(w)))
    ordered = F.sort_array(F.concat(_shingles(F.col(words), shingle), _highest(bins)))
    rows = rows.withColumn(full, ordered)
    first = F.filter(
        F.col(full), lambda x, i: (i == 0) | (_bin(x, bins) != _bin(F.get(F.col(full), i - 1), bins))
    )
    low = F.lit((1 << width) - 1).cast("long")
    # the smallest value of each bin, null where it is empty
    rows = rows.withColumn(held, F.transform(first, lambda v: F.when(v.bitwiseAND(low) != low, v)))

    def probe(i: Column, t: int) -> Column:
        return F.get(F.col(held), F.pmod(F.xxhash64(i, F.lit(t)), F.lit(bins)).cast("int"))

    def last_resort(i: Column) -> Column:
        """Of the bins that are not empty, the one that comes first in an order of this bin's own."""
        ranked = F.transform(
            F.filter(F.col(held), lambda v: v.isNotNull()),
            lambda v: F.struct(F.xxhash64(i, _bin(v, bins), F.lit(-1)).alias("rank"), v.alias("value")),
        )
        return F.array_min(ranked)["value"]

    dense = F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)),
        lambda i: F.coalesce(F.get(F.col(held), i), *[probe(i, t) for t in range(PROBES)], last_resort(i)),
    )
    dense_name = f"{name}__dense"
    rows = rows.withColumn(dense_name, dense)
    keep = F.lit((1 << bits) - 1).cast("long")
    # a column that is named once only may be computed anew for each element, so it is named for each field
    packed = F.transform(
        F.sequence(F.lit(0), F.lit(bins // per - 1)),
        lambda w: reduce(
            Column.bitwiseOR,
            [F.shiftleft(F.get(F.col(dense_name), w * per + k).bitwiseAND(keep), bits * (per - 1 - k)) for k in range(per)],
        ),
    )
    empty = F.size(words) == 0
    return rows.withColumn(name, F.when(empty, F.array().cast("array<bigint>")).otherwise(packed)).drop(
        words, full, held, dense_name
    )


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity, 0 to 1. Two texts without words are alike, one is like no other text."""
    mask = sum(1 << (bits * i) for i in range(64 // bits))
    mask = mask - (1 << 64) if mask >= 1 << 63 else mask

    def differing(x: Column, y: Column) -> Column:
        odd, step = x.bitwiseXOR(y), 1
        while step < bits:
            odd, step = odd.bitwiseOR(F.shiftrightunsigned(odd, step)), step * 2
        return F.bit_count(odd.bitwiseAND(F.lit(mask).cast("long")))

    unequal = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda n, x: n + x)
    chance = 1.0 / (1 << bits)
    found = (F.lit(1.0) - unequal / float(bins) - chance) / (1.0 - chance)
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(F.greatest(found, F.lit(0.0)))
    )


def as_hex(fingerprint: Column) -> Column:
    """A fingerprint as lower-case hexadecimal digits."""
    return F.array_join(F.transform(fingerprint, lambda w: F.lower(F.lpad(F.hex(w), 16, "0"))), "")


def with_next(docs: DataFrame, columns: list[str], buckets: int | None = None) -> DataFrame:
    """Attach to each row, as ``next_<column>``, the columns of the row with the next larger doc_id; the last gets the first's.

    Rows are dealt to ranges of doc_id by its quantiles, and the first row of each range is also
    sent to the range before it, so no task sees more than a range. Null ids come first, rows of
    one id are ordered by the columns. A single row is its own next row. ``docs`` must be cheap to
    read for its ids alone: they are read twice beforehand.
    """
    spark: SparkSession = docs.sparkSession
    wanted = buckets or 2 * partitions(spark)
    share = [i / wanted for i in range(1, wanted)]
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    limits = sorted(set(ids.agg(F.percentile_approx("doc_id", share, 10_000)).first()[0] or [])) if share else []
    edges = F.array(*[F.lit(x) for x in limits]).cast("array<bigint>")
    step = max(1, round(len(limits) ** 0.5))
    coarse = F.array(*[F.lit(x) for x in limits[step - 1 :: step]]).cast("array<bigint>")
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long"))

    def bucket(doc_id: Column) -> Column:
        """How many limits lie below the id: first by every ``step``-th limit, then within one step."""
        whole = F.size(F.filter(coarse, lambda x: x < doc_id)) * step
        rest = F.size(F.filter(F.slice(edges, whole + 1, step), lambda x: x < doc_id))
        return F.when(doc_id.isNull(), F.lit(0)).otherwise(whole + rest)

    present = (
        ids.groupBy(bucket(F.col("doc_id")).alias("bucket"))
        .agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("has_null"))
        .orderBy("bucket")
        .collect()  # one row for each range
    )
    if not present:
        return rows.withColumns({f"next_{c}": F.col(c) for c in columns})
    before = {b["bucket"]: present[n - 1]["bucket"] for n, b in enumerate(present)}
    # nulls come first, so a first range that has some starts with them
    firsts = F.map_from_arrays(
        F.array(*[F.lit(b["bucket"]) for b in present]),
        F.array(*[F.lit(None if b["has_null"] else b["first"]).cast("long") for b in present]),
    )
    back = F.map_from_arrays(
        F.array(*[F.lit(b) for b in before]), F.array(*[F.lit(b) for b in before.values()])
    )
    placed = rows.withColumn("bucket", bucket(F.col("doc_id")))
    is_first = F.col("doc_id").eqNullSafe(F.element_at(firsts, F.col("bucket")))
    copies = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("border")))
    border = F.array(F.struct(F.element_at(back, F.col("bucket")).alias("bucket"), F.lit(True).alias("border")))
    sent = placed.withColumn("to", F.explode(F.when(is_first, F.concat(copies, border)).otherwise(copies)))
    sent = sent.select(*rows.columns, "to.bucket", "to.border")
    order = Window.partitionBy("bucket").orderBy("border", "doc_id", *columns)
    ahead = sent.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return ahead.where(~F.col("border")).drop("bucket", "border")


def edited_fingerprints(docs: DataFrame, **options) -> DataFrame:
    """Fingerprints of all texts and of edited ones, and how alike they are.

    The edited text has its last floor(n/2) code points replaced by the first as many (or all) of
    the next document. Returns doc_id, n_chars, text, edited_text, fingerprint,
    edited_fingerprint (arrays), near_edited, near_next.
    """
    like = {k: v for k, v in options.items() if k != "shingle"}
    rows = docs.select("doc_id", whole_text().alias("text"))
    known = with_fingerprint(rows, "text", "fingerprint", **options)
    ahead = with_next(known, ["text", "fingerprint"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    ahead = ahead.withColumns({"n_chars": n.cast("long"), "edited_text": edited})
    both = with_fingerprint(ahead, "edited_text", "edited_fingerprint", **options)
    return both.select(
        "doc_id",
        "n_chars",
        "text",
        "edited_text",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), **like).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), **like).alias("near_next"),
    )

