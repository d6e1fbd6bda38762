"""Joins of many rows to a lookup frame whose keys may be badly skewed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast only if its row count is known and at most this (a few MB of numeric rows).
BROADCAST_MAX_ROWS = 100_000

# Copies of a lookup in the salted join. A lookup with few distinct keys (a chain may hold a third
# of all rows) is copied once per shuffle partition within these limits, a lookup that is itself
# large only a few times.
SPREAD_COARSE = (8, 512)
SPREAD_FINE = 8


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    max_rows: int | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup`` on ``on`` without letting one key value fill one task.

    With ``max_rows``, a proven upper bound of the lookup's row count, a small lookup is
    broadcast. Otherwise rows of one key are dealt to ``spread`` buckets by a hash of
    ``spread_by``, and each lookup row is copied to every bucket, so the join is an ordinary
    shuffled equi-join that AQE may still turn into a broadcast. The result is the same.
    ``spread`` defaults to the number of shuffle partitions.
    """
    on = list(on)
    if max_rows is not None and max_rows <= BROADCAST_MAX_ROWS:
        return rows.join(F.broadcast(lookup), on, how)
    if spread is None:
        low, high = SPREAD_COARSE
        spread = min(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), low), high)
    bucket = F.pmod(F.xxhash64(*spread_by), F.lit(spread)).cast("int")
    dealt = rows.withColumn("_bucket", bucket)
    copied = lookup.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return dealt.join(copied, [*on, "_bucket"], how).drop("_bucket")


def attach_one_row(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate, which always has exactly one row."""
    return rows.crossJoin(F.broadcast(one_row))
