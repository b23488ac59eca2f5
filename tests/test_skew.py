from graphs import rows
from pyspark.sql import functions as F

from kinfold import skew
from kinfold.skew import checked_broadcast, hot_keys, salted_join

HOWS = ("inner", "left", "left_semi", "left_anti")


def sides(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("a")
    )
    right = spark.range(0, 80).select((F.col("id") % 40).alias("k"), F.col("id").alias("b"))
    return left, right


def test_salted_join_equals_plain(spark):
    left, right = sides(spark)
    hot = spark.createDataFrame([(0,), (7,), (45,)], "k bigint")
    for how in HOWS:
        assert rows(salted_join(left, right, ["k"], how, hot=hot)) == rows(left.join(right, "k", how)), how


def test_hot_rows_are_dealt_out(spark):
    left, right = sides(spark)
    hot = spark.createDataFrame([(0,)], "k bigint")
    plan = salted_join(left, right, ["k"], hot=hot)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        busy = salted_join(left, right, ["k"], hot=hot).filter("k = 0").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert busy > 1 and "_salt" not in plan.columns


def test_hot_keys(spark):
    left, _ = sides(spark)
    assert hot_keys(left, ["k"]) is None
    spark.conf.set("kinfold.hotRows", "500")
    assert rows(hot_keys(left, ["k"])) == [(0,)]
    # A limit above a thousand counts a sample.
    spark.conf.set("kinfold.hotRows", "4000")
    many = spark.range(20000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    found = rows(hot_keys(many, ["k"]))
    spark.conf.unset("kinfold.hotRows")
    assert found == [(-1,)]


def test_checked_broadcast(spark):
    small = spark.range(10)
    assert "BroadcastHashJoin" in small.join(checked_broadcast(small), "id")._jdf.queryExecution().toString()
    assert "rightHint=(strategy=broadcast)" not in small.join(
        checked_broadcast(small, max_rows=5), "id"
    )._jdf.queryExecution().optimizedPlan().toString()


def test_salts_come_from_maps_too(spark):
    """1,000 parallel edges differ in their properties alone; they still use most salts, and every salt is a function of the row."""
    left = spark.range(1000).select(
        F.lit(1).alias("k"), F.array(F.lit("A")).alias("labels"), F.create_map(F.lit("p"), F.array(F.col("id").cast("string"))).alias("props")
    )
    marked = left.withColumn("_hot", F.lit(True))
    salts = marked.select(skew._salt(left, ["k"]).alias("s"), "props").collect()
    assert len({row.s for row in salts}) >= 32 and all(0 <= row.s < skew.SALTS for row in salts)
    again = marked.repartition(3).select(skew._salt(left, ["k"]).alias("s"), "props").collect()
    assert {(row.s, str(row.props)) for row in again} == {(row.s, str(row.props)) for row in salts}
    bare = spark.range(0, 640, 1, 4).select(F.lit(1).alias("k")).withColumn("_hot", F.lit(True))
    assert bare.select(skew._salt(bare.select("k"), ["k"]).alias("s")).distinct().count() >= 32
    cold = left.withColumn("_hot", F.lit(None).cast("boolean"))
    assert cold.select(skew._salt(left, ["k"]).alias("s")).distinct().collect() == [(0,)]
