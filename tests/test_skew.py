from pyspark.sql import functions as F

from sluice.operators import skew


def test_lookup_is_a_left_join(spark):
    left = spark.range(4000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('k', id % 500) end as k", "id % 2 as `a.b`")
    right = spark.range(-1, 300).selectExpr("if(id < 0, 'hot', concat('k', id)) as k", "id as fact").withColumn("other", F.lit("x"))
    for base, rows, small in ((None, None, 0), (left, 4000, 0), (None, None, 200), (None, None, 1000)):
        got = skew.lookup(left, right, ["k"], "id", base, rows, small)
        assert got.columns == ["id", "k", "a.b", "fact", "other"]
        assert sorted(map(tuple, got.fillna(-9).collect())) == sorted(map(tuple, left.join(right, "k", "left").select("id", "k", "`a.b`", "fact", "other").fillna(-9).collect()), key=lambda r: r[0])
    assert skew.lookup(left.limit(0), right, ["k"], "id", small=0).count() == 0 and skew.lookup(left, right.limit(0), ["k"], "id").where("fact is null").count() == 4000


def test_a_hot_key_is_cut_into_pieces(spark):
    left = spark.range(20_000).selectExpr("id", "if(id % 10 < 4, 1, id) as k", "if(id % 10 < 8, null, 5) as q")
    right = spark.range(100).selectExpr("id as k", "id * 2 as fact")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for keys, facts in ((["k"], right), (["q"], right.withColumnRenamed("k", "q"))):
            sizes = [r["n"] for r in skew.lookup(left, facts, keys, "id", small=0).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
            assert sum(sizes) == 20_000 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
