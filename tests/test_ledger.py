"""Counts, the ledger and its freshness."""

import datetime as dt
import time
import uuid

import pytest
from pyspark.sql import functions as F

from podium.operators.ledger import (
    ROTATED_PAIRS,
    append_count,
    count_pairs,
    count_where,
    create_ledger,
    is_fresh,
    recent_entry,
)
from podium.plans import record_medal_count
from podium.schemas import LEDGER


@pytest.fixture
def results(spark):
    medals = ["Gold"] * 5 + ["Silver"] * 3 + ["Bronze"] * 2 + ["gold", None]
    return spark.createDataFrame([(m,) for m in medals], "medal string")


def test_count_matches_case(results):
    assert count_where(results, "medal", "Gold").first()[0] == 5
    assert count_where(results, "medal", "Tin").first()[0] == 0


def test_labels_and_medals_are_apart(results):
    counts = {r.medal_type: r["count"] for r in count_pairs(results, "medal", ROTATED_PAIRS).collect()}
    assert counts == {"Bronze": 5, "Silver": 2, "Gold": 3}
    none = count_pairs(results, "medal", [("x", "Tin"), ("y", "Gold")])
    assert {tuple(r) for r in none.collect()} == {("x", 0), ("y", 5)}


def test_filter_reaches_the_scan(spark, results, tmp_path):
    results.write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    assert "EqualTo(medal,Gold)" in count_where(stored, "medal", "Gold")._jdf.queryExecution().toString()
    plan = count_pairs(stored, "medal", ROTATED_PAIRS)._jdf.queryExecution().executedPlan().toString()
    assert "In(medal" in plan and plan.count("FileScan") == 1


def test_entries_are_appended_with_their_time(spark, results, tmp_path):
    path = str(tmp_path / "ledger")
    assert record_medal_count(results, [("Bronze", "Gold")], path=path) is True
    assert record_medal_count(results, ROTATED_PAIRS, path=path) is True
    ledger = spark.read.parquet(path)
    assert ledger.schema == LEDGER
    assert ledger.count() == 4
    assert ledger.filter("created_at is null").count() == 0


def test_time_is_taken_after_the_count(spark, results, tmp_path):
    path = str(tmp_path / "ledger")

    def slowly(batches):
        for batch in batches:
            time.sleep(4)
            yield batch

    slow = results.coalesce(1).mapInArrow(slowly, results.schema)
    began = dt.datetime.now(dt.UTC)
    counted = append_count(count_pairs(slow, "medal", ROTATED_PAIRS), path)
    assert (counted - began).total_seconds() >= 4
    assert is_fresh(spark.read.parquet(path), 3)
    times = spark.read.parquet(path).select(
        (F.col("created_at") >= F.lit(counted)).alias("after")
    )
    assert {r.after for r in times.collect()} == {True}
    assert is_fresh(spark.read.parquet(path)) is True


def test_names_of_any_case(results):
    upper = results.withColumnRenamed("medal", "MEDAL")
    assert count_where(upper, "medal", "Gold").first()[0] == 5
    assert count_pairs(upper, "Medal", [("x", "Gold")]).first()["count"] == 5


def test_append_makes_the_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    append_count(spark.createDataFrame([("x", 3_000_000_000)], "medal_type string, count long"), path)
    assert spark.read.parquet(path).first()["count"] == 3_000_000_000


def ledger_aged(spark, *ages):
    now = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [("x", i, now - dt.timedelta(seconds=age)) for i, age in enumerate(ages)]
    return spark.createDataFrame(rows, LEDGER), F.lit(now)


def test_fresh_within_the_limit_only(spark):
    ledger, now = ledger_aged(spark, 500, 29, 10)
    assert is_fresh(ledger, 30, now)
    assert not is_fresh(ledger, 10, now)
    assert recent_entry(ledger, 30, now).first().created_at == dt.datetime(2024, 1, 1, 11, 59, 50)
    assert recent_entry(ledger, 30, now).count() == 1


def test_clock_and_empty_ledger(spark):
    ledger, _ = ledger_aged(spark, 1)
    assert not is_fresh(ledger)
    assert not is_fresh(ledger.limit(0))


def test_latest_row_is_chosen_without_a_full_sort(spark):
    ledger, now = ledger_aged(spark, 1, 2)
    plan = recent_entry(ledger, 30, now)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


# --- a ledger of the catalog ----------------------------------------------


@pytest.fixture
def name(spark):
    name = f"ledger_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"drop table if exists {name}")


def test_the_table_puts_in_the_time(spark, tmp_path, name, results):
    path = str(tmp_path / "ledger")
    create_ledger(spark, name, path)
    create_ledger(spark, name, path)
    before = dt.datetime.now(dt.UTC)
    counted = append_count(count_pairs(results, "medal", ROTATED_PAIRS), table=name)
    entries = spark.table(name)
    assert entries.columns == ["medal_type", "count", "created_at"]
    after = entries.filter(F.col("created_at") >= F.lit(counted))
    assert after.count() == 3 and counted >= before
    assert sorted((r.medal_type, r["count"]) for r in entries.collect()) == sorted(
        (r.medal_type, r["count"]) for r in count_pairs(results, "medal", ROTATED_PAIRS).collect()
    )
    assert is_fresh(entries, 600)


def test_each_insert_has_a_time_of_its_own(spark, tmp_path, name):
    counts = spark.createDataFrame([("x", 1)], "medal_type string, count long")
    for _ in range(2):
        append_count(counts, table=name, path=str(tmp_path / "ledger"))
    times = [r[0] for r in spark.table(name).select("created_at").collect()]
    assert len(times) == 2 and None not in times and times[0] != times[1]


def test_a_ledger_over_files_has_their_rows(spark, tmp_path, name):
    path, other = str(tmp_path / "ledger"), f"{name}_2"
    append_count(spark.createDataFrame([("x", 1)], "medal_type string, count long"), path)
    create_ledger(spark, name, path)
    assert spark.table(name).first()["count"] == 1
    spark.sql(f"drop table {name}")
    create_ledger(spark, other, path)
    assert spark.table(other).first()["count"] == 1
    spark.sql(f"drop table {other}")


def test_labels_have_a_greatest_width(spark, tmp_path, name):
    long = spark.createDataFrame([("x" * 11, 1)], "medal_type string, count long")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        append_count(long, table=name, path=str(tmp_path / "ledger"))


@pytest.mark.parametrize(
    "columns",
    ["medal_type string", "medal_type string, count bigint, created_at timestamp", "a int, created_at timestamp default current_timestamp()"],
)
def test_another_table_of_the_name_is_refused(spark, tmp_path, name, columns):
    spark.sql(f"create table {name} ({columns}) using parquet location '{tmp_path / 'other'}'")
    with pytest.raises(ValueError, match="not a ledger"):
        create_ledger(spark, name)


def test_recorded_in_the_catalog(spark, tmp_path, name, results):
    create_ledger(spark, name, str(tmp_path / "ledger"))
    assert record_medal_count(results, ROTATED_PAIRS, table=name)
    assert spark.table(name).count() == 3
