"""Averages: the two meanings of the country, missing values, both joins."""

import math
import random
import uuid
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from podium import shared
from podium.operators import enrich
from podium.operators.enrich import avg_stats, hot_keys, measured_bytes

RES = "athlete_id int, sport string, medal string, country_noc string"
BIO = "athlete_id int, sex string, country_noc string, height double, weight double"
JOINS = ["broadcast", "shuffle"]


@pytest.fixture(params=[True, False], ids=["spark-broadcasts", "sort-merge"])
def threshold(spark, request):
    """Also with Spark's own broadcast off, as it is on large tables."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    if not request.param:
        spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def stats(spark, results, bio, **options):
    df = avg_stats(
        spark.createDataFrame(results, RES), spark.createDataFrame(bio, BIO), **options
    )
    return {
        (r.sport, r.medal, r.sex, r.country_noc): (r.avg_height, r.avg_weight)
        for r in df.collect()
    }


def expected(results, bio, country_from, drop_missing):
    """Straight from the definition: pair, group, average what is not null."""
    groups = defaultdict(lambda: ([], []))
    for athlete, sport, medal, country in results:
        for bio_id, sex, bio_country, height, weight in bio:
            if athlete is None or athlete != bio_id:
                continue
            missing = any(x is None or math.isnan(x) for x in (height, weight))
            if drop_missing and missing:
                continue
            group = (sport, medal, sex, country if country_from == "event" else bio_country)
            groups[group][0].append(height)
            groups[group][1].append(weight)

    def average(values):
        known = [v for v in values if v is not None]
        return sum(known) / len(known) if known else None

    return {g: (average(h), average(w)) for g, (h, w) in groups.items()}


def same(a, b):
    return str(a) == str(b)


@pytest.mark.parametrize("join", JOINS)
def test_averages_are_over_result_rows(spark, join):
    results = [(1, "golf", "Gold", "A")] * 3 + [(2, "golf", "Gold", "A")]
    bio = [(1, "M", "X", 100.0, 50.0), (2, "M", "Y", 200.0, 90.0)]
    got = stats(spark, results, bio, join=join)
    assert got == {("golf", "Gold", "M", "A"): (125.0, 60.0)}


def test_country_of_the_event_or_of_the_biography(spark):
    results, bio = [(1, "golf", None, "A")], [(1, "M", "X", 100.0, 50.0)]
    assert list(stats(spark, results, bio, country_from="event")) == [("golf", None, "M", "A")]
    assert list(stats(spark, results, bio, country_from="bio")) == [("golf", None, "M", "X")]


@pytest.mark.parametrize("join", JOINS)
def test_one_nan_makes_its_group_nan_unless_dropped(spark, join):
    results = [(1, "golf", "Gold", "A"), (2, "golf", "Gold", "A"), (3, "golf", "Gold", "A")]
    bio = [(1, "M", "X", math.nan, 1.0), (2, "M", "X", 0.0, 3.0), (3, "M", "X", None, 5.0)]
    kept = stats(spark, results, bio, join=join)[("golf", "Gold", "M", "A")]
    assert math.isnan(kept[0]) and kept[1] == 3.0
    dropped = stats(spark, results, bio, join=join, drop_missing=True)
    assert dropped == {("golf", "Gold", "M", "A"): (0.0, 3.0)}


@pytest.mark.parametrize("join", JOINS)
def test_group_without_measures_has_null_averages(spark, join):
    got = stats(spark, [(1, "golf", "Gold", "A")], [(1, "M", "X", None, None)], join=join)
    assert got == {("golf", "Gold", "M", "A"): (None, None)}


@pytest.mark.parametrize("join", JOINS)
def test_null_keys_never_match(spark, join):
    got = stats(spark, [(None, "golf", "Gold", "A")], [(None, "M", "X", 1.0, 1.0)], join=join)
    assert got == {}


@pytest.mark.parametrize("join", JOINS)
def test_text_measures(spark, join):
    results = spark.createDataFrame([(1, "g", "Gold", "A"), (2, "g", "Gold", "A")], RES)
    bio = spark.createDataFrame(
        [(1, "M", "X", "180", "70"), (2, "M", "X", "na", "80")],
        "athlete_id int, sex string, country_noc string, height string, weight string",
    )
    row = avg_stats(results, bio, join=join).first()
    assert (row.avg_height, row.avg_weight) == (180.0, 75.0)


@pytest.mark.parametrize("join", JOINS)
@pytest.mark.parametrize("text_side", ["results", "bio"])
def test_ids_left_as_text_on_one_side(spark, join, text_side):
    ids = {"results": "athlete_id int", "bio": "athlete_id long", text_side: "athlete_id string"}
    keys = ["1", "na"] if text_side == "results" else [1, 2]
    results = spark.createDataFrame(
        [(k, "g", "Gold", "A") for k in keys], f"{ids['results']}, sport string, medal string, country_noc string"
    )
    keys = ["1", "na"] if text_side == "bio" else [1, 2]
    bio = spark.createDataFrame(
        [(k, "M", "X", 180.0, 70.0) for k in keys],
        f"{ids['bio']}, sex string, country_noc string, height double, weight double",
    )
    rows = avg_stats(results, bio, join=join).drop("timestamp").collect()
    assert rows == [("g", "Gold", "M", "A", 180.0, 70.0)]


@pytest.mark.parametrize("join", JOINS)
def test_cents_are_summed_exactly(spark, join):
    results = [(i % 7, "golf", "Gold", "A") for i in range(999)]
    bio = [(i, "M", "X", i + 0.07, i + 0.01) for i in range(7)]
    cents = sum(100 * (i % 7) + 7 for i in range(999))
    got = stats(spark, results, bio, join=join, scale=2)
    assert got[("golf", "Gold", "M", "A")][0] == (cents / 100) / 999


@pytest.mark.parametrize("join", JOINS)
def test_scale_loses_no_measure(spark, join):
    results = [(1, "golf", "Gold", "A"), (2, "golf", "Gold", "A"), (3, "golf", "Gold", "A")]
    fine = [(1, "M", "X", 1.00000001, 1.0), (2, "M", "X", 1.00000001, math.nan)]
    got = stats(spark, results, fine, join=join, scale=8)
    assert got[("golf", "Gold", "M", "A")] == (1.00000001, 1.0)
    large = [(1, "M", "X", 1e16, 1.0), (2, "M", "X", 10.0, 1.0)]
    got = stats(spark, results, large, join=join, scale=2)
    assert got[("golf", "Gold", "M", "A")][0] == (1e16 + 10) / 2
    for value in (1e17, 1e300, math.inf):
        bio = [(1, "M", "X", value, 1.0), (2, "M", "X", 10.0, 1.0)]
        with pytest.raises(Exception, match="more digits"):
            stats(spark, results, bio, join=join, scale=2)


@pytest.mark.parametrize("scale", [-1, 19])
def test_scales_that_would_round_sums_are_refused(spark, scale):
    with pytest.raises(ValueError, match="scale"):
        stats(spark, [], [], scale=scale)


@pytest.mark.parametrize("join", JOINS)
def test_names_of_any_case(spark, join):
    results = spark.createDataFrame([(1, "g", "Gold", "A")], RES).withColumnsRenamed(
        {"athlete_id": "Athlete_ID", "medal": "MEDAL"}
    )
    bio = spark.createDataFrame([(1, "M", "X", 180.0, 70.0)], BIO).withColumnsRenamed(
        {"height": "Height", "athlete_id": "ATHLETE_id"}
    )
    got = avg_stats(results, bio, drop_missing=True, join=join)
    assert got.columns[:4] == ["sport", "medal", "sex", "country_noc"]
    assert tuple(got.drop("timestamp").first()) == ("g", "Gold", "M", "A", 180.0, 70.0)
    with pytest.raises(ValueError, match="no column 'height'"):
        avg_stats(results, bio.drop("Height"), join=join)


@pytest.mark.parametrize("join", JOINS)
@pytest.mark.parametrize("drop_missing", [True, False])
@pytest.mark.parametrize("country_from", ["event", "bio"])
def test_hot_athlete_and_repeated_biographies(
    spark, threshold, join, drop_missing, country_from
):
    """A third of the results and a third of the biographies are one athlete."""
    rng = random.Random(7)
    measures = [None, math.nan, *[float(x) for x in range(150, 160)]]

    def athlete(i):
        return 0 if i % 3 == 0 else rng.choice([None, *range(1, 40)])

    results = [
        (athlete(i), rng.choice("ab"), rng.choice(["Gold", None]), rng.choice("XY"))
        for i in range(900)
    ]
    bio = [
        (athlete(i), rng.choice("MF"), rng.choice("XYZ"), rng.choice(measures), rng.choice(measures))
        for i in range(90)
    ]
    got = stats(
        spark, results, bio, join=join, drop_missing=drop_missing, country_from=country_from
    )
    want = expected(results, bio, country_from, drop_missing)
    assert got.keys() == want.keys()
    for group, averages in want.items():
        assert all(same(a, b) for a, b in zip(got[group], averages)), group


def test_join_follows_the_measured_size(spark):
    results = spark.createDataFrame([(1, "g", "Gold", "A")], RES)
    bio = spark.createDataFrame([(1, "M", "X", 1.0, 1.0)], BIO)

    def plan(**options):
        return avg_stats(results, bio, **options)._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan()
    assert "strategy=broadcast" not in plan(broadcast_bytes=10)


def test_results_of_hot_athletes_are_not_shuffled(spark):
    def results(share):
        hot = f"if(id % {share} = 0, -1, id)" if share else "id"
        return spark.range(0, 30_000, 1, 4).selectExpr(
            f"{hot} as athlete_id", "'g' as sport", "'Gold' as medal", "'A' as country_noc"
        )

    assert hot_keys(results(3)) == [-1]
    assert hot_keys(results(None)) == []
    bio = spark.range(-1, 30_000).selectExpr(
        "id as athlete_id", "'M' as sex", "'X' as country_noc",
        "if(id < 0, 200D, 100D) as height", "1D as weight",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        skewed = avg_stats(results(3), bio, join="shuffle")
        plan = skewed._jdf.queryExecution().executedPlan().toString()
        small = avg_stats(results(3), bio, join="shuffle", broadcast_bytes=10)
        wide = small._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("BroadcastHashJoin") == plan.count("SortMergeJoin") == 1
    assert plan.count("Exchange hashpartitioning") <= 5
    assert "BroadcastHashJoin" not in wide and small.first().avg_height == skewed.first().avg_height
    assert skewed.first().avg_height == (10_000 * 200 + 20_000 * 100) / 30_000
    even = avg_stats(results(None), bio, join="shuffle")
    assert "Union" not in even._jdf.queryExecution().optimizedPlan().toString()
    assert even.first().avg_height == 100.0


def test_the_share_follows_the_shuffle_partitions(spark):
    assert enrich.hot_share(8) == enrich.hot_share(1000) == enrich.HOT_SHARE
    assert enrich.hot_share(4000) == 1 / 4000
    assert enrich.hot_share(10**6) == enrich.LEAST_HOT_SHARE
    # Just below a thousandth, which is hot for thousands of partitions.
    ids = spark.range(0, 100_000, 1, 4).selectExpr("if(id % 1100 = 0, -1, id) as athlete_id")
    assert hot_keys(ids) == []
    assert hot_keys(ids, enrich.hot_share(4000)) == [-1]


def test_hot_keys_of_text_and_of_nothing(spark):
    ids = spark.createDataFrame([("a",)] * 3 + [("b",)], "athlete_id string")
    assert sorted(hot_keys(ids)) == ["a", "b"]
    assert hot_keys(ids, share=0.5) == ["a"]
    assert hot_keys(ids.limit(0)) == []
    assert hot_keys(spark.createDataFrame([(None,), ("a",)], "athlete_id string")) == ["a"]


def test_hot_keys_among_many_are_found_wherever_they_lie(spark):
    """Spread over all tasks, in one task only, and just below the share."""
    spread = spark.range(0, 400_000, 1, 40).selectExpr("if(id % 50 = 0, -1, id) as athlete_id")
    packed = spark.range(0, 4_000, 1, 1).selectExpr("-2L as athlete_id")
    rare = spark.range(0, 100, 1, 1).selectExpr("-3L as athlete_id")
    assert sorted(hot_keys(spread.union(packed).union(rare))) == [-2, -1]


def test_one_athlete_has_all_results(spark):
    one = spark.range(0, 10_000, 1, 4).selectExpr("7 as athlete_id")
    assert hot_keys(one) == [7]


def test_broadcast_of_large_biographies_is_refused(spark):
    results = spark.createDataFrame([(1, "g", "Gold", "A")], RES)
    bio = spark.createDataFrame([(1, "M", "X", 1.0, 1.0)], BIO)
    with pytest.raises(ValueError, match="too large"):
        avg_stats(results, bio, join="broadcast", broadcast_bytes=10)


@pytest.mark.parametrize("held", [10, 1000, 200_000])
@pytest.mark.parametrize("ids", ["if(id % 3 = 0, -1, id % 2000)", "id", "id % 5", "null"])
def test_tasks_count_equal_rows(spark, monkeypatch, held, ids):
    monkeypatch.setattr(enrich, "HELD_ROWS", held)
    rows = spark.range(0, 45_000, 1, 2).selectExpr(
        f"cast({ids} as int) as athlete_id", "if(id % 2 = 0, 'g', null) as sport"
    )
    counted = enrich._count_in_tasks(rows)
    total = counted.groupBy("athlete_id", "sport").agg(F.sum("n").alias("n"))
    assert sorted(map(str, total.collect())) == sorted(
        map(str, rows.groupBy("athlete_id", "sport").agg(F.count("*").alias("n")).collect())
    )
    if held == 200_000 and ids != "id":
        assert counted.count() <= 2 * rows.distinct().count()


def test_measured_size_counts_text_of_any_length(spark):
    short = spark.createDataFrame([(1, "M", "X", 1.0, 1.0)] * 10, BIO)
    long = spark.createDataFrame([(1, "M" * 1000, "X", 1.0, 1.0)] * 10, BIO)
    columns = ["athlete_id", "sex"]
    assert measured_bytes(long, columns) - measured_bytes(short, columns) == 9990
    assert measured_bytes(short.limit(0), columns) == 0


@pytest.mark.parametrize("options", [{"country_from": "x"}, {"join": "x"}])
def test_unknown_options_are_refused(spark, options):
    frame = spark.createDataFrame([], RES)
    with pytest.raises(ValueError):
        avg_stats(frame, frame, **options)


def test_what_a_join_has_written_is_removed_in_the_end(spark, tmp_path, monkeypatch):
    ends = []
    monkeypatch.setattr(shared.atexit, "register", lambda *call: ends.append(call))
    rows = [(0 if i % 2 else i, "s", "Gold", "X") for i in range(4000)]
    results = spark.createDataFrame(rows, "athlete_id int, sport string, medal string, country_noc string")
    bio = spark.createDataFrame(
        [(i, "F", "X", 170.0, 60.0) for i in range(4000)],
        "athlete_id int, sex string, country_noc string, height double, weight double",
    )
    stats = enrich.avg_stats(results, bio, join="shuffle")
    assert stats.count() == 1
    ((function, *given),) = ends
    path = Path(given[1])
    assert path.exists()
    table = f"left_{uuid.uuid4().hex}"
    spark.sql(f"create table {table} (a int) using parquet location '{path}/t'")
    function(given[0], given[1], table)
    assert not path.exists() and not spark.catalog.tableExists(table)
