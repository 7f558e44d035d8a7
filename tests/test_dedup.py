from pyspark.sql import functions as F

from lakemeter.operators.dedup import flag_latest, latest_rows


def test_latest_rows_and_flags(spark):
    df = spark.createDataFrame(
        [(1, "a", 10, "b1"), (1, "a", 12, "b0"), (1, "a", None, "b9"), (2, "a", 5, "b1"),
         (None, "a", 1, "x"), (None, "a", 2, "y")], "k int, g string, ts int, batch string")
    best = {(r.k, r.g): r.ts for r in latest_rows(df, ["k", "g"], ["ts", "batch"]).collect()}
    assert best == {(1, "a"): 12, (2, "a"): 5, (None, "a"): 2}
    flags = flag_latest(df, ["k", "g"], ["ts", "batch"]).collect()
    assert len(flags) == 6
    assert {(r.k, r.ts) for r in flags if r.is_latest} == {(1, 12), (2, 5), (None, 2)}
    # NULL order value ranks lowest (DESC NULLS LAST)
    assert [r.is_latest for r in flags if r.ts is None] == [False]


def test_flag_latest_on_one_hot_key(spark):
    hot = spark.range(0, 20000).select(F.lit(7).alias("k"), F.col("id").alias("seq"))
    cold = spark.range(0, 100).select(F.col("id").alias("k"), F.col("id").alias("seq"))
    out = flag_latest(hot.unionByName(cold), ["k"], ["seq"])
    winners = out.where("is_latest").collect()
    assert len(winners) == 100  # key 7 appears in both parts: one winner
    assert [r.seq for r in winners if r.k == 7] == [19999]
