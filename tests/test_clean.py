"""Cleaning: text, equal rows, missing measures."""

import math

from podium.operators.clean import drop_duplicate_rows, drop_missing, normalize_text


def test_text_is_lowered_and_loses_outer_spaces_only(spark):
    df = spark.createDataFrame(
        [(" A\t", 1, True), (None, 2, None), ("  ", 3, False), (" X ", 4, True)],
        "`the.name` string, n int, flag boolean",
    )
    got = normalize_text(df)
    assert got.schema == df.schema
    assert [tuple(r) for r in got.collect()] == [
        ("a\t", 1, True),
        (None, 2, None),
        ("", 3, False),
        (" x", 4, True),
    ]


def test_normalizing_is_one_projection(spark):
    df = spark.createDataFrame([("A", "B", "C")], "a string, b string, c string")
    plan = normalize_text(df)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_equal_rows_nulls_nans_and_zeros(spark):
    rows = [("a", x) for x in (None, None, math.nan, math.nan, 0.0, -0.0)]
    got = drop_duplicate_rows(spark.createDataFrame(rows, "k string, x double")).collect()
    assert sorted(str(r.x) for r in got) == ["0.0", "None", "nan"]


def test_rows_differing_in_one_column_stay(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 1)], "k string, x int")
    assert sorted(drop_duplicate_rows(df).collect()) == [("a", 1), ("a", 2)]


def test_copies_of_one_row_collapse_before_the_shuffle(spark):
    copies = spark.range(0, 30_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) as k"
    )
    assert drop_duplicate_rows(copies).count() == 20_001
    plan = drop_duplicate_rows(copies)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "HashAggregate" in below


def test_missing_measures(spark):
    nan = math.nan
    rows = [(1, 1.0, 1.0), (2, None, 1.0), (3, 1.0, None), (4, nan, 1.0), (5, 1.0, nan)]
    df = spark.createDataFrame(rows, "athlete_id int, height double, weight double")
    assert [r.athlete_id for r in drop_missing(df).collect()] == [1]


def test_text_that_is_no_number_is_missing(spark):
    df = spark.createDataFrame(
        [(1, "180", "70"), (2, "na", "70")], "athlete_id int, height string, weight string"
    )
    assert [r.athlete_id for r in drop_missing(df).collect()] == [1]


def test_not_null_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "bio")
    spark.createDataFrame([(1, 2.0, 3.0)], "id int, height double, weight double").write.parquet(path)
    plan = drop_missing(spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "IsNotNull(height)" in plan and "IsNotNull(weight)" in plan
