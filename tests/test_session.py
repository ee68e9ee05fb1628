from pyspark.sql import functions as F

from strataframe.session import broadcast_if_small


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_broadcast_needs_few_rows_and_few_bytes(spark):
    few = spark.range(10).withColumn("names", F.array(F.lit("x" * 1000)))
    assert hinted(broadcast_if_small(few))
    assert not hinted(broadcast_if_small(few, limit=9))
    assert not hinted(broadcast_if_small(few, n_bytes=5000))
    assert hinted(broadcast_if_small(few.limit(0)))
