from pyspark.sql import functions as F

from ledgerlens.operators.skew import spread_join


def frames(spark):
    rows = [(i, None if i % 3 == 0 else f"n{i % 5}", i % 4 if i % 7 else None) for i in range(200)]
    left = spark.createDataFrame(rows, "id long, name string, code long")
    right = spark.createDataFrame([("n1", 1), ("n1", 2), ("n2", 3), (None, 4), ("x", 5)], "named string, v int")
    codes = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (None, "d")], "of long, w string")
    return left, right, codes


def test_as_a_plain_left_join(spark):
    left, right, codes = frames(spark)
    for salts in (1, 5):
        got = spread_join(spread_join(left, right, "name", "named", ["id"], salts), codes, "code", "of", ["id"], salts)
        want = left.join(right, left.name == right.named, "left").join(codes, left.code == codes.of, "left")
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_missing_and_common_keys_are_dealt_out(spark):
    """Most names are missing or the same; after the join's shuffle no partition has a large share of the rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        left = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "one").otherwise(F.col("id").cast("string")).alias("name"))
        right = spark.createDataFrame([("one", 1)], "named string, v int")
        out = spread_join(left, right, "name", "named", ["id"], 32)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 1000 and out.where("v = 1").count() == 1333
    finally:
        for name, value in (("autoBroadcastJoinThreshold", "10MB"), ("adaptive.enabled", "true"), ("shuffle.partitions", "4")):
            spark.conf.set(f"spark.sql.{name}", value)
