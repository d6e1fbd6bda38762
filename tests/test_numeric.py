from pyspark.sql import functions as F

from demandcast.functions.numeric import clip_or_default


def test_clip_or_default(spark):
    one = spark.range(1).select(
        clip_or_default(F.lit(float("nan"))), clip_or_default(F.lit(3.0), 0.0, 2.0), clip_or_default(F.lit(-3.0))
    )
    assert list(one.first()) == [1.0, 2.0, 0.0]
