import pytest
from pyspark.sql import functions as F

from markbook.operators import joins, merges, picks


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some of them exact copies, and many missing keys."""
    rows = [(i, "hot", i % 3) for i in range(300)] + [(0, "hot", 0)] * 50
    rows += [(i, None, 1) for i in range(200)] + [(i, f"k{i % 40}", 2) for i in range(400)]
    rows += [(i, "hot but unknown", 3) for i in range(100)]
    return spark.createDataFrame(rows, "id int, k string, v int").repartition(6)


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("hot", 1, "a"), *[(f"k{i}", i, None) for i in range(30)]], "k string, n int, t string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_scattered_join_equals_plain_join(rows, skewed, lookup, how):
    want = skewed.join(lookup, "k", how)
    got = joins.scattered_join(skewed, lookup, ["k"], how, hot_rows=50, limit=4)
    assert got.columns == want.columns if how in ("left", "inner") else set(got.columns) == set(want.columns)
    assert rows(got, *want.columns) == rows(want)
    small = joins.lookup_join(skewed, lookup, ["k"], how)
    large = joins.lookup_join(skewed, lookup, ["k"], how, max_bytes=0, hot_rows=50)
    assert rows(small, *want.columns) == rows(large, *want.columns) == rows(want)


@pytest.fixture
def shuffled(spark):
    """Small tables joined the way large ones are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def tasks_per_key(df):
    spread = df.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.countDistinct("p").alias("n"))
    return {r[0]: r[1] for r in spread.collect()}


def test_scatter_spreads_hot_and_missing_keys(skewed, lookup, shuffled):
    tasks = tasks_per_key(joins.scattered_join(skewed, lookup, ["k"], "left", hot_rows=50, limit=4))
    assert tasks["hot"] > 1 and tasks[None] > 1 and tasks["hot but unknown"] > 1
    assert tasks["k1"] == 1


def test_merge_scatters_rows_without_key(spark, shuffled):
    target = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 1)], "k int, v int").repartition(4)
    source = spark.createDataFrame([(None, i) for i in range(50)] + [(2, 2)], "k int, v int").repartition(4)
    assert tasks_per_key(merges.merge_frames(target, source, ["k"], {"v": merges.COALESCE}))[None] > 1


def test_hot_keys_are_bounded(skewed):
    assert [r[0] for r in joins.hot_keys(skewed, ["k"], 50, 1).collect()] == ["hot"]
    assert {r[0] for r in joins.hot_keys(skewed, ["k"], 50, 10).collect()} == {"hot", "hot but unknown"}


def test_exists_by_equality_and_null_safe(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "a int, b string")
    right = spark.createDataFrame([(1, "a"), (2, None)], "a int, b string")
    assert rows(joins.anti_join(left, right, ["a", "b"])) == [(None, None), (2, None)]
    assert rows(joins.anti_join(left, right, ["a", "b"], null_safe=True)) == [(None, None)]
    assert rows(joins.semi_join(left, right, ["a", "b"])) == [(1, "a")]
    assert rows(joins.semi_join(left, right, ["a", "b"], null_safe=True)) == [(1, "a"), (2, None)]


def test_null_safe_join_by_shuffle(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "a int, b string")
    keyed = left.withColumn("k", F.struct("a", "b")).select("k", "a")
    found = spark.createDataFrame([(2, None)], "a int, b string").select(F.struct("a", "b").alias("k"))
    got = joins.scattered_join(keyed, found, ["k"], "left_semi", hot_rows=1)
    assert rows(got, "a") == [(2,)]


def test_fits_broadcast(spark):
    df = spark.range(1000)
    assert joins.fits_broadcast(df) and not joins.fits_broadcast(df, 100)
    assert joins.fits_broadcast(df.limit(0), 0)


def test_first_and_last_win(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 5, None), ("b", 4, "w")], "k string, seq int, v string")
    assert rows(picks.first_per_key(df, ["k"], ["seq"]), "k", "v") == [("a", "x"), ("b", "w")]
    assert rows(picks.last_per_key(df, ["k"], ["seq"]), "k", "v") == [("a", "z"), ("b", None)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_picks_limit_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(picks.first_per_key(df, ["k"], ["id"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan and plan.count("Exchange") == 1


def test_latest_per_assessment_tie(spark, rows):
    df = spark.createDataFrame([(1, 7, "2024-01-02"), (1, 5, "2024-01-02"), (1, 1, "2024-01-01"), (2, None, "2024-01-09")], "AssessmentID int, SchoolID int, DateCompleted string")
    assert rows(picks.latest_per_assessment(df), "AssessmentID", "SchoolID") == [(1, 5)]
