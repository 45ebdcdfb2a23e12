from pyspark.sql import functions as F

from creditloom.functions import aggregates as A


def test_sums_and_distinct_with_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, "a"), (2, 3.0, "a"), (2, 4.0, "a")], "k int, x double, s string")
    rows = {
        r.k: r for r in df.groupBy("k").agg(
            A.sum_or_zero("x").alias("s"), A.distinct_with_null("s").alias("d"),
            A.count_where(F.col("x") > 3).alias("c"), A.sum_where(F.col("s") == "a", "x").alias("sa"),
            A.max_where(F.col("x") > 9, "x").alias("m"), A.share_where(F.col("x") > 3).alias("h"),
            A.ratio_of_sums("x", "x").alias("r"),
        ).collect()
    }
    assert (rows[1].s, rows[1].d, rows[1].c, rows[1].sa, rows[1].m, rows[1].h, rows[1].r) == (0.0, 2, 0, 0.0, None, 0.0, 0.0)
    assert (rows[2].s, rows[2].d, rows[2].c, rows[2].sa, rows[2].m, rows[2].h) == (7.0, 1, 1, 7.0, None, 0.5)
    assert rows[2].r == 7.0 / (7.0 + 1e-5)


def test_empty_table_gives_zero(spark):
    row = spark.createDataFrame([], "x double").agg(A.sum_or_zero("x").alias("s"), A.count_where(F.col("x") > 0).alias("c")).first()
    assert (row.s, row.c) == (0.0, 0)


def test_latest_keeps_null_and_breaks_ties_by_id(spark):
    rows = [
        (1, -2, 10, 5.0), (1, -1, 11, None),             # newest value is null and stays null
        (2, -1, -9 * 10**18, 1.0), (2, -1, 9 * 10**18, 2.0),  # same month, far apart ids
        (3, None, 99, 7.0), (3, -40, 1, 8.0),             # no month sorts first
        (4, None, 5, 6.0),
        (5, -2, 9 * 10**18, 1.0), (5, -1, -9 * 10**18, 2.0),  # month outranks any id
    ]
    df = spark.createDataFrame(rows, "k int, m int, id long, x double")
    got = {r.k: r.x for r in df.groupBy("k").agg(A.latest("x", A.recency("m", "id")).alias("x")).collect()}
    assert got == {1: None, 2: 2.0, 3: 8.0, 4: 6.0, 5: 2.0}
