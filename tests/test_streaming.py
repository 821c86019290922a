"""Streams: equal to the batch, restarts, sinks, the console."""

import json
import math
from pathlib import Path

import pytest

from podium.functions.codec import decode_json
from podium.operators import enrich
from podium.operators.enrich import avg_stats
from podium.plans import consume_topic, enrich_stream, publish_table
from podium.schemas import ENRICHED_AVG, EVENT_RESULTS, with_names
from podium.sinks import write_topic
from podium.sources import read_topic
from podium.streaming import (
    fan_out,
    latest_snapshot,
    to_console,
    to_table,
    to_topic,
    write_console,
)

RES = "athlete_id int, sport string, medal string, country_noc string"
BIO = "athlete_id int, sex string, country_noc string, height double, weight double"
RES_FIELDS = ["athlete_id", "sport", "medal"]
SPARK_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def bio(spark):
    rows = [
        (i, "MF"[i % 2], f"B{i % 3}", math.nan if i == 7 else 150.0 + i, 50.0 + i)
        for i in range(20)
    ]
    return spark.createDataFrame(rows, BIO)


def results(spark, start, end):
    """A third of the rows belong to athlete 0."""
    rows = [
        (0 if i % 3 == 0 else i % 25, f"s{i % 2}", ["Gold", None][i % 2], f"E{i % 4}")
        for i in range(start, end)
    ]
    return spark.createDataFrame(rows, RES).coalesce(1)


def publish(spark, feed, *ranges):
    for start, end in ranges:
        publish_table(results(spark, start, end), feed, fmt="text")


def rows(df):
    return sorted(str(tuple(r)) for r in df.drop("timestamp", "epoch_id").collect())


def run(spark, feed, bio, sinks, checkpoint, **options):
    query = enrich_stream(
        read_topic(spark, feed, fmt="text", max_per_trigger=1),
        bio,
        sinks,
        checkpoint,
        available_now=True,
        **options,
    )
    query.awaitTermination()
    return query


@pytest.mark.parametrize("join", ["broadcast", "shuffle", "auto"])
@pytest.mark.parametrize("country_from", ["event", "bio"])
def test_stream_equals_batch(spark, tmp_path, bio, join, country_from):
    feed, table = str(tmp_path / "feed"), str(tmp_path / "table")
    publish(spark, feed, (0, 100), (100, 250), (250, 300))
    before = spark.conf.get(SPARK_BROADCAST)
    spark.conf.set(SPARK_BROADCAST, "-1")
    try:
        query = run(
            spark, feed, bio, [to_table(table)], str(tmp_path / "c"),
            join=join, country_from=country_from,
        )
    finally:
        spark.conf.set(SPARK_BROADCAST, before)
    batch = avg_stats(results(spark, 0, 300), bio, country_from, drop_missing=True)
    assert len(query.recentProgress) >= 3
    assert rows(latest_snapshot(spark, table)) == rows(batch)


def test_counting_on_a_stream_needs_no_state_of_its_own(spark, tmp_path, bio):
    feed = str(tmp_path / "feed")
    publish(spark, feed, (0, 3000))
    query = run(spark, feed, bio, [to_table(str(tmp_path / "t"))], str(tmp_path / "c"), join="shuffle")
    assert [len(p.stateOperators) for p in query.recentProgress][0] == 1


def test_every_epoch_is_kept_or_only_the_last(spark, tmp_path, bio):
    feed, every, last = (str(tmp_path / p) for p in ("feed", "every", "last"))
    publish(spark, feed, (0, 10), (10, 200))
    sinks = [to_table(every), to_table(last, "replace")]
    run(spark, feed, bio, sinks, str(tmp_path / "c"))
    epochs = spark.read.parquet(every)
    assert sorted(r[0] for r in epochs.select("epoch_id").distinct().collect()) == [0, 1]
    assert epochs.filter("epoch_id = 0").count() < epochs.filter("epoch_id = 1").count()
    assert rows(latest_snapshot(spark, last)) == rows(latest_snapshot(spark, every))
    assert [p.name for p in (tmp_path / "last").glob("epoch_id=*")] == ["epoch_id=1"]
    # All groups carry the time of their epoch, changed or not.
    times = epochs.groupBy("epoch_id").agg({"timestamp": "count"}).count()
    assert times == epochs.select("epoch_id", "timestamp").distinct().count() == 2


def test_epoch_that_runs_again_replaces_itself(spark, tmp_path):
    table = str(tmp_path / "t")
    sink = to_table(table)
    sink(spark.range(3), 0)
    sink(spark.range(5), 1)
    sink(spark.range(4), 1)
    assert spark.read.parquet(table).count() == 7
    assert latest_snapshot(spark, table).count() == 4


def test_a_used_table_with_a_new_checkpoint_is_refused(spark, tmp_path):
    for snapshot in ("append", "replace"):
        sink = to_table(str(tmp_path / snapshot), snapshot)
        sink(spark.range(3), 0)
        sink(spark.range(2), 0)  # the first epoch may run again
        sink(spark.range(5), 1)
        with pytest.raises(ValueError, match="another checkpoint"):
            sink(spark.range(9), 0)
        assert latest_snapshot(spark, str(tmp_path / snapshot)).count() == 5


def test_an_epoch_that_broke_off_is_not_the_last(spark, tmp_path):
    table = tmp_path / "t"
    to_table(str(table))(spark.range(3), 7)
    to_table(str(table))(spark.range(5), 8)
    (table / "epoch_id=8" / "_SUCCESS").unlink()
    assert latest_snapshot(spark, str(table)).count() == 3
    with pytest.raises(ValueError, match="no complete epoch"):
        latest_snapshot(spark, str(tmp_path / "nothing"))


def test_a_table_is_readable_while_it_is_replaced(spark, tmp_path):
    table = str(tmp_path / "t")
    to_table(table, "replace")(spark.range(3), 0)
    seen = []

    def write(batch, epoch_id):
        to_table(table, "replace")(batch, epoch_id)
        seen.append(latest_snapshot(spark, table).count())

    failing = spark.range(4).selectExpr("id", "assert_true(id < 2) as ok")
    with pytest.raises(Exception):
        write(failing, 1)
    assert latest_snapshot(spark, table).count() == 3
    write(spark.range(5), 1)
    assert seen == [5]


def test_epochs_can_be_told_apart_in_a_topic(spark, tmp_path):
    topic = str(tmp_path / "topic")
    sink = to_topic(topic, fmt="text", epoch_column="epoch_id", compression="gzip")
    sink(spark.range(2), 4)
    sink(spark.range(3), 5)
    got = [json.loads(r.value) for r in spark.read.text(topic).collect()]
    assert sorted((g["epoch_id"], g["id"]) for g in got) == [(4, 0), (4, 1), (5, 0), (5, 1), (5, 2)]
    assert list(Path(topic).glob("*.gz"))


def test_restart_goes_on_and_runs_nothing_without_new_messages(spark, tmp_path, bio):
    feed, table, checkpoint = (str(tmp_path / p) for p in ("feed", "table", "c"))
    publish(spark, feed, (0, 100))
    run(spark, feed, bio, [to_table(table)], checkpoint)
    idle = run(spark, feed, bio, [to_table(table)], checkpoint)
    assert not [p for p in idle.recentProgress if p.numInputRows]
    assert spark.read.parquet(table).select("epoch_id").distinct().count() == 1
    publish(spark, feed, (100, 300))
    run(spark, feed, bio, [to_table(table)], checkpoint)
    batch = avg_stats(results(spark, 0, 300), bio, "bio", drop_missing=True)
    assert rows(latest_snapshot(spark, table)) == rows(batch)


def test_broken_messages_drop_out_of_the_enrichment(spark, tmp_path, bio):
    feed, table = str(tmp_path / "feed"), str(tmp_path / "table")
    publish(spark, feed, (0, 50))
    spark.createDataFrame([("not json",), ("{}",)], "value string").write.mode("append").text(feed)
    run(spark, feed, bio, [to_table(table)], str(tmp_path / "c"))
    batch = avg_stats(results(spark, 0, 50), bio, "bio", drop_missing=True)
    assert rows(latest_snapshot(spark, table)) == rows(batch)


def test_messages_encoded_twice(spark, tmp_path, bio):
    feed, table = str(tmp_path / "feed"), str(tmp_path / "table")
    value = '"{\\"athlete_id\\":2,\\"sport\\":\\"golf\\",\\"medal\\":\\"Gold\\"}"'
    spark.createDataFrame([(value,)], "value string").write.text(feed)
    run(spark, feed, bio, [to_table(table)], str(tmp_path / "c"), unwrap=True)
    assert rows(latest_snapshot(spark, table)) == ["('golf', 'Gold', 'M', 'B2', 152.0, 52.0)"]


def test_publishing_twice_doubles_the_messages(spark, tmp_path):
    feed = str(tmp_path / "feed")
    publish(spark, feed, (0, 10))
    publish(spark, feed, (0, 10))
    assert spark.read.text(feed).count() == 20


def test_files_added_to_the_biographies_later_are_not_seen(spark, tmp_path, bio):
    feed, table, where = (str(tmp_path / p) for p in ("feed", "table", "bio"))
    bio.filter("athlete_id < 5").write.parquet(where)
    static = spark.read.parquet(where)
    bio.filter("athlete_id >= 5").write.mode("append").parquet(where)
    publish(spark, feed, (0, 50))
    run(spark, feed, static, [to_table(table)], str(tmp_path / "c"))
    early = avg_stats(results(spark, 0, 50), bio.filter("athlete_id < 5"), "bio", True)
    assert rows(latest_snapshot(spark, table)) == rows(early)


def test_stream_broadcasts_measured_files_only(spark, tmp_path, bio):
    feed, where = str(tmp_path / "feed"), str(tmp_path / "bio")
    publish(spark, feed, (0, 5))
    bio.write.parquet(where)
    stream = read_topic(spark, feed, fmt="text").selectExpr(
        "cast(value as int) athlete_id", "value sport", "value medal", "value country_noc"
    )

    def plan(static, **options):
        return avg_stats(stream, static, **options)._jdf.queryExecution().analyzed().toString()

    assert "strategy=broadcast" in plan(spark.read.parquet(where))
    assert "strategy=broadcast" not in plan(spark.read.parquet(where), broadcast_bytes=10)
    assert "strategy=broadcast" not in plan(bio)
    assert "MapInArrow" in plan(bio)


@pytest.mark.parametrize("join", ["broadcast", "shuffle"])
def test_sums_of_biographies_in_files_are_written_once(spark, tmp_path, bio, join, monkeypatch):
    feed, where, table = (str(tmp_path / p) for p in ("feed", "bio", "table"))
    publish(spark, feed, (0, 50), (50, 100))
    bio.write.parquet(where)
    written = []

    def counting(totals, path):
        written.append(path)
        return write(totals, path)

    write = enrich._bucketed
    monkeypatch.setattr(enrich, "_bucketed", counting)
    static = spark.read.parquet(where)
    run(spark, feed, static, [to_table(table)], str(tmp_path / "c"), join=join)
    assert written == [str(tmp_path / "c" / "static")]
    batch = avg_stats(results(spark, 0, 100), bio, "bio", drop_missing=True)
    assert rows(latest_snapshot(spark, table)) == rows(batch)
    other = str(tmp_path / "other")
    run(spark, feed, bio, [to_table(other)], str(tmp_path / "c2"), join=join)
    assert len(written) == 1


def test_starting_again_leaves_one_copy_of_the_sums(spark, tmp_path, bio):
    feed, where, table, checkpoint = (str(tmp_path / p) for p in ("feed", "bio", "table", "c"))
    bio.write.parquet(where)
    for start in (0, 50):
        publish(spark, feed, (start, start + 50))
        static = spark.read.parquet(where)
        run(spark, feed, static, [to_table(table)], checkpoint, join="shuffle")
    batch = avg_stats(results(spark, 0, 100), bio, "bio", drop_missing=True)
    assert rows(latest_snapshot(spark, table)) == rows(batch)
    files = list((tmp_path / "c" / "static").glob("part-*.parquet"))
    assert sum(spark.read.parquet(str(f)).count() for f in files) == bio.filter(
        "height is not null and weight is not null and not isnan(height) and not isnan(weight)"
    ).select("athlete_id", "sex", "country_noc").distinct().count()


def test_no_epoch_shuffles_the_biographies(spark, tmp_path, bio):
    feed, where, table = (str(tmp_path / p) for p in ("feed", "bio", "table"))
    publish(spark, feed, (0, 50))
    bio.write.parquet(where)
    before = spark.conf.get(SPARK_BROADCAST)
    spark.conf.set(SPARK_BROADCAST, "-1")
    plans = []

    def look(batch, epoch_id):
        batch.count()

    try:
        query = enrich_stream(
            read_topic(spark, feed, fmt="text"),
            spark.read.parquet(where),
            [look],
            str(tmp_path / "c"),
            schema=results(spark, 0, 1).schema,
            available_now=True,
            join="shuffle",
        )
        query.awaitTermination()
        plans.append(query._jsq.streamingQuery().lastExecution().executedPlan().toString())
    finally:
        spark.conf.set(SPARK_BROADCAST, before)
    (plan,) = plans
    assert "SortMergeJoin" in plan
    # One exchange of the messages and one of the groups.
    assert plan.count("Exchange hashpartitioning") == 2


def test_only_lists_of_files_are_fixed(spark, tmp_path, bio):
    where = str(tmp_path / "bio")
    bio.write.parquet(where)
    files = spark.read.parquet(where)
    assert enrich.only_files(files) and enrich.only_files(files.filter("athlete_id > 1"))
    assert not enrich.only_files(bio)
    assert not enrich.only_files(files.unionByName(bio))


def test_a_static_side_that_is_no_file_is_not_measured(spark, tmp_path, bio, monkeypatch):
    def refuse(*args):
        raise AssertionError("measured for nothing")

    monkeypatch.setattr(enrich, "measured_bytes", refuse)
    feed = str(tmp_path / "feed")
    publish(spark, feed, (0, 5))
    run(spark, feed, bio, [to_table(str(tmp_path / "t"))], str(tmp_path / "c"))


def test_checkpoints_are_never_local_to_the_driver(spark, tmp_path, monkeypatch):
    from unittest.mock import MagicMock

    from podium import shared

    def session(**conf):
        spark = MagicMock()
        spark.conf.get.side_effect = lambda key, default=None: conf.get(key, default)
        return spark

    cluster = {"spark.master": "local-cluster[2,1,1024]"}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.checkpoint_for(session(**cluster), None, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.checkpoint_for(session(**{"spark.master": "yarn"}), None, "x")
    assert shared.checkpoint_for(session(**cluster), "/given", "x") == "/given"
    named = {**cluster, "spark.sql.streaming.checkpointLocation": "s3://c"}
    assert shared.checkpoint_for(session(**named), None, "x") is None
    folder = {**cluster, "spark.checkpoint.dir": "s3://d/"}
    assert shared.checkpoint_for(session(**folder), None, "x").startswith("s3://d/podium/x-")
    for master in ("local", "local[*]"):
        monkeypatch.setattr(shared.tempfile, "mkdtemp", lambda prefix: "/tmp/own")
        assert shared.shared_root(session(**{"spark.master": master})) == "/tmp/own"


@pytest.mark.parametrize("path", [None, "out"])
def test_a_consumer_without_checkpoint_keeps_it_in_the_shared_folder(
    spark, tmp_path, bio, path, monkeypatch
):
    feed, shared = str(tmp_path / "feed"), tmp_path / "shared"
    publish_table(avg_stats(results(spark, 0, 50), bio), feed, fmt="text")
    monkeypatch.setattr("podium.shared.shared_root", lambda session: str(shared))
    consume_topic(
        read_topic(spark, feed, fmt="text"), path=path and str(tmp_path / path)
    ).awaitTermination()
    assert len(list(shared.glob("podium/*/offsets"))) == 1


@pytest.mark.parametrize("fmt", ["text", "parquet"])
def test_consumer_keeps_broken_messages_as_nulls(spark, tmp_path, bio, fmt):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    stats = avg_stats(results(spark, 0, 50), bio)
    publish_table(stats, feed, fmt=fmt)
    broken = spark.createDataFrame([(None, "not json")], "key string, value string")
    write_topic(broken, feed, fmt=fmt)
    consume_topic(
        read_topic(spark, feed, fmt=fmt, max_per_trigger=1, fail_on_data_loss=False),
        path=out,
        checkpoint=str(tmp_path / "c"),
    ).awaitTermination()
    got = spark.read.parquet(out)
    assert got.filter("sport is null").count() == 1
    assert rows(got.filter("sport is not null")) == rows(stats)


def test_consumer_that_names_the_country_otherwise(spark, tmp_path, bio):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    publish_table(avg_stats(results(spark, 0, 50), bio), feed, fmt="text")
    consume_topic(
        read_topic(spark, feed, fmt="text"),
        schema=with_names(ENRICHED_AVG, {"country_noc": "noc_country"}),
        path=out,
        checkpoint=str(tmp_path / "c"),
    ).awaitTermination()
    assert spark.read.parquet(out).filter("noc_country is not null").count() == 0


def test_fan_out_feeds_the_consumer(spark, tmp_path, bio):
    feed, topic, table, out = (str(tmp_path / p) for p in ("feed", "topic", "table", "out"))
    publish(spark, feed, (0, 60), (60, 90))
    run(spark, feed, bio, [to_topic(topic, fmt="text"), to_table(table)], str(tmp_path / "c"))
    consume_topic(
        read_topic(spark, topic, fmt="text"), path=out, checkpoint=str(tmp_path / "c2")
    ).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(spark.read.parquet(table))


def test_fan_out_computes_a_micro_batch_once(spark, tmp_path):
    counter = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    batch = spark.range(100).mapInArrow(touch, "id long")
    fan_out(to_table(str(tmp_path / "a")), to_table(str(tmp_path / "b")))(batch, 0)
    assert counter.value == 100
    assert spark.read.parquet(str(tmp_path / "b")).count() == 100


def test_failing_sink_stops_the_query(spark, tmp_path, bio):
    feed = str(tmp_path / "feed")
    publish(spark, feed, (0, 10))

    def failing(batch, epoch_id):
        raise RuntimeError("sink is gone")

    with pytest.raises(Exception, match="sink is gone"):
        run(spark, feed, bio, [to_table(str(tmp_path / "t")), failing], str(tmp_path / "c"))


def test_failed_epoch_runs_again_after_a_restart(spark, tmp_path, bio):
    feed, table, checkpoint = (str(tmp_path / p) for p in ("feed", "table", "c"))
    publish(spark, feed, (0, 100))

    def failing(batch, epoch_id):
        raise RuntimeError("sink is gone")

    with pytest.raises(Exception, match="sink is gone"):
        run(spark, feed, bio, [to_table(table), failing], checkpoint)
    run(spark, feed, bio, [to_table(table)], checkpoint)
    assert spark.read.parquet(table).select("epoch_id").distinct().count() == 1
    batch = avg_stats(results(spark, 0, 100), bio, "bio", drop_missing=True)
    assert rows(latest_snapshot(spark, table)) == rows(batch)


def test_console_of_a_stateful_stream(spark, tmp_path, bio, capsys):
    feed = str(tmp_path / "feed")
    publish(spark, feed, (0, 100), (100, 200))
    run(spark, feed, bio, [], str(tmp_path / "c"), console=True, console_rows=1)
    out = capsys.readouterr().out
    assert "Batch: 0" in out and "Batch: 1" in out
    assert out.count("only showing top 1 row") == 2


def test_console_of_a_stateless_stream(spark, tmp_path, bio, capsys):
    feed = str(tmp_path / "feed")
    publish_table(avg_stats(results(spark, 0, 50), bio), feed, fmt="text")
    consume_topic(read_topic(spark, feed, fmt="text")).awaitTermination()
    out = capsys.readouterr().out
    assert "Batch: 0" in out and "avg_height" in out


def test_console_goes_on_until_it_is_stopped(spark, tmp_path, capsys):
    feed = str(tmp_path / "feed")
    publish(spark, feed, (0, 10))
    query = write_console(read_topic(spark, feed, fmt="text"), rows=2)
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert not query.isActive
    assert "Batch: 0" in capsys.readouterr().out


def test_console_shows_no_more_rows_than_asked(spark, capsys):
    to_console(rows=3)(spark.range(100), 4)
    out = capsys.readouterr().out
    assert "Batch: 4" in out and "only showing top 3 rows" in out


def test_two_queries_of_one_plan_at_the_same_time(spark, tmp_path, bio, capsys):
    feed, table = str(tmp_path / "feed"), str(tmp_path / "table")
    publish(spark, feed, (0, 100), (100, 200))
    stream = read_topic(spark, feed, fmt="text", max_per_trigger=1)
    stats = avg_stats(decode_json(stream, EVENT_RESULTS, RES_FIELDS), bio, "bio", True)
    console = write_console(stats, "complete", rows=2, checkpoint=str(tmp_path / "c1"))
    stored = (
        stats.writeStream.outputMode("complete")
        .foreachBatch(fan_out(to_table(table)))
        .option("checkpointLocation", str(tmp_path / "c2"))
        .start()
    )
    for query in (console, stored):
        query.processAllAvailable()
        query.stop()
    out = capsys.readouterr().out
    assert "Batch: 1" in out and "only showing top 2 rows" in out
    assert rows(latest_snapshot(spark, table)) == rows(
        avg_stats(results(spark, 0, 200), bio, "bio", drop_missing=True)
    )


def test_enrichment_without_a_sink_is_refused(spark, tmp_path, bio):
    feed = str(tmp_path / "feed")
    publish(spark, feed, (0, 10))
    with pytest.raises(ValueError):
        run(spark, feed, bio, [], str(tmp_path / "c"))


def test_unknown_snapshot_is_refused():
    with pytest.raises(ValueError):
        to_table("x", "other")


def test_declared_result_schema_is_the_default(spark, tmp_path, bio):
    feed, table = str(tmp_path / "feed"), str(tmp_path / "t")
    spark.createDataFrame([(1, "golf", 3000000000)], "athlete_id int, sport string, result_id long").selectExpr(
        "to_json(struct(*)) value"
    ).write.text(feed)
    run(spark, feed, bio, [to_table(table)], str(tmp_path / "c"))
    assert latest_snapshot(spark, table).count() == 1
    assert EVENT_RESULTS["result_id"].dataType.simpleString() == "int"
