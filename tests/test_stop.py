"""Streams that end between epochs, and what is counted of a feed."""

import json
import os
import signal
import threading
import time
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException

from podium import jobs
from podium.plans import consume_topic, enrich_stream
from podium.operators.enrich import avg_stats
from podium.sinks import write_topic
from podium.sources import pinned_schema, read_feed, read_topic
from podium.streaming import DataLoss, FeedWatch, Stop, latest_snapshot, to_table, to_topic, write_console
from tests.test_streaming import bio, publish, results, rows  # noqa: F401


def enriched(spark, feed, bio, sinks, c, stop, **options):
    return enrich_stream(
        read_topic(spark, feed, fmt="text", max_per_trigger=1), bio, sinks, c, stop=stop, **options
    )


@pytest.mark.parametrize("available_now", [True, False])
def test_a_stopped_stream_repeats_no_epoch(spark, tmp_path, bio, available_now):
    feed, topic, table, c = (str(tmp_path / p) for p in ("feed", "topic", "table", "c"))
    publish(spark, feed, *[(i * 20, i * 20 + 20) for i in range(5)])
    stop, seen = Stop(), []

    def during(batch, epoch_id):
        """Asked to stop in the middle of an epoch, which is finished."""
        seen.append(epoch_id)
        if epoch_id == 1:
            stop.request()
        batch.count()

    sinks = [during, to_topic(topic, fmt="text", epoch_column="e"), to_table(table)]
    query = enriched(spark, feed, bio, sinks, c, stop, available_now=available_now)
    assert stop.wait(query, spark)
    assert seen == [0, 1] and not query.isActive
    query = enriched(spark, feed, bio, sinks, c, None, available_now=True)
    query.awaitTermination()
    assert seen == [0, 1, 2, 3, 4]
    sent = [json.loads(r.value) for r in spark.read.text(topic).collect()]
    keys = [(m["e"], m["sport"], m.get("medal"), m["sex"], m["country_noc"]) for m in sent]
    assert len(keys) == len(set(keys)) and {k[0] for k in keys} == {0, 1, 2, 3, 4}
    assert rows(latest_snapshot(spark, table)) == rows(
        avg_stats(results(spark, 0, 100), bio, "bio", drop_missing=True)
    )


def test_an_idle_stream_is_stopped_by_a_file(spark, tmp_path, bio):
    feed, table, marker = (str(tmp_path / p) for p in ("feed", "table", "stop-now"))
    publish(spark, feed, (0, 20))
    stop = Stop(marker)
    query = enriched(spark, feed, bio, [to_table(table)], str(tmp_path / "c"), stop)
    query.processAllAvailable()
    assert not stop.requested(spark)
    open(marker, "w").close()
    assert not stop.wait(query, spark, poll=0.2) or not query.isActive
    assert not query.isActive and latest_snapshot(spark, table).count() > 0


def test_signals_ask_for_a_stop(spark):
    stop, before = Stop(), signal.getsignal(signal.SIGTERM)
    with stop.on_signals():
        os.kill(os.getpid(), signal.SIGTERM)
        time.sleep(0.1)
        assert stop.requested(spark)
    assert signal.getsignal(signal.SIGTERM) is before


def test_other_errors_are_raised(spark, tmp_path, bio):
    feed = str(tmp_path / "feed")
    publish(spark, feed, (0, 20))

    def fails(batch, epoch_id):
        raise OSError("sink is away")

    stop = Stop()
    query = enriched(spark, feed, bio, [fails], str(tmp_path / "c"), stop)
    with pytest.raises(StreamingQueryException, match="sink is away"):
        stop.wait(query, spark)


def test_a_query_that_ends_by_itself_was_not_stopped(spark, tmp_path, bio):
    feed, stop = str(tmp_path / "feed"), Stop()
    publish(spark, feed, (0, 20))
    table = str(tmp_path / "t")
    query = enriched(spark, feed, bio, [to_table(table)], str(tmp_path / "c"), stop, available_now=True)
    assert stop.wait(query, spark) is False


def test_a_consumer_of_files_stops_and_goes_on(spark, tmp_path):
    feed, out, c = (str(tmp_path / p) for p in ("feed", "out", "c"))
    for i in range(4):
        write_topic(spark.createDataFrame([(f'{{"sport": "s{i}"}}',)], "value string"), feed, fmt="text")
    stop = Stop()
    query = consume_topic(
        read_topic(spark, feed, fmt="text", max_per_trigger=1), path=out, checkpoint=c,
        available_now=False, stop=stop,
    )
    threading.Timer(1.0, stop.request).start()
    stop.wait(query, spark)
    consume_topic(read_topic(spark, feed, fmt="text"), path=out, checkpoint=c).awaitTermination()
    assert sorted(r.sport for r in spark.read.parquet(out).collect()) == ["s0", "s1", "s2", "s3"]


def test_a_console_is_gated(spark, tmp_path, capsys):
    feed, stop = str(tmp_path / "feed"), Stop()
    write_topic(spark.createDataFrame([("x",)], "value string"), feed, fmt="text")
    stop.request()
    query = write_console(
        read_topic(spark, feed, fmt="text"), available_now=True, checkpoint=str(tmp_path / "c"), stop=stop
    )
    assert stop.wait(query, spark)
    assert "Batch" not in capsys.readouterr().out


def test_a_job_stops_at_a_marker(spark, tmp_path, bio):
    feed, table, biographies = (str(tmp_path / p) for p in ("feed", "table", "bio"))
    publish(spark, feed, (0, 20), (20, 40))
    bio.write.parquet(biographies)
    marker = tmp_path / "stop"
    args = ["enrich", "--topic", feed, "--format", "text", "--bio", biographies,
            "--out-table", table, "--checkpoint", str(tmp_path / "c"), "--stop-file", str(marker)]
    marker.touch()
    assert jobs.main(args) == 0
    with pytest.raises(ValueError, match="no complete epoch"):
        latest_snapshot(spark, table)
    marker.unlink()
    jobs.main([*args, "--available-now"])
    assert rows(latest_snapshot(spark, table)) == rows(
        avg_stats(results(spark, 0, 40), bio, "bio", drop_missing=True)
    )


# --- what was read and what was gone --------------------------------------


def feed_of(spark, tmp_path, n):
    feed = tmp_path / "feed"
    for i in range(n):
        write_topic(spark.createDataFrame([(f"{i}-{k}",) for k in range(3)], "value string").coalesce(1),
                    str(feed), fmt="text")
        time.sleep(0.02)
    return feed


def losing(feed, at):
    """A sink that removes the newest files of the feed while an epoch is written."""

    def write(batch, epoch_id):
        batch.count()
        if epoch_id == 0:
            files = sorted(feed.glob("part-*"), key=lambda p: p.stat().st_mtime_ns)
            for file in files[len(files) - at :]:
                file.unlink()

    return write


def watched(spark, feed, c, fail_on_data_loss, lost):
    """A watch over a stream whose feed loses its newest files in the first epoch."""
    messages = read_topic(
        spark, str(feed), fmt="text", max_per_trigger=1, fail_on_data_loss=fail_on_data_loss
    )
    query = (
        messages.writeStream.foreachBatch(losing(feed, lost))
        .option("checkpointLocation", c).trigger(availableNow=True).start()
    )
    with FeedWatch(spark, query, c, fail_on_data_loss) as watch:
        query.awaitTermination()
    return watch


@pytest.mark.parametrize("lost", [0, 2])
def test_files_that_are_gone_are_counted(spark, tmp_path, lost):
    feed = feed_of(spark, tmp_path, 5)
    watch = watched(spark, feed, str(tmp_path / "c"), False, lost)
    assert len(watch.missing) == lost and watch.read == 3 * (5 - lost)
    assert watch.lost == 0


def test_without_the_option_a_gone_file_stops_the_query(spark, tmp_path):
    feed = feed_of(spark, tmp_path, 5)
    with pytest.raises(DataLoss, match="gone"):
        watched(spark, feed, str(tmp_path / "c"), True, 2)


def progress(batch, rows_, start, end):
    source = SimpleNamespace(startOffset=start, endOffset=end, numInputRows=rows_)
    return SimpleNamespace(batchId=batch, numInputRows=rows_, sources=[source])


def test_offsets_that_a_broker_no_longer_has(spark):
    watch = FeedWatch(spark, SimpleNamespace(id="q", recentProgress=[]))
    watch.add(progress(0, 10, None, '{"t":{"0":10,"1":0}}'))
    watch.add(progress(1, 25, '{"t":{"0":10,"1":0}}', '{"t":{"0":30,"1":12,"2":4}}'))
    watch.add(progress(1, 25, '{"t":{"0":10,"1":0}}', '{"t":{"0":30,"1":12,"2":4}}'))
    assert (watch.read, watch.lost, watch.missing) == (35, 7, [])


# --- schemas kept ---------------------------------------------------------


def test_a_schema_is_inferred_once(spark, tmp_path):
    feed, c = str(tmp_path / "feed"), str(tmp_path / "c")
    spark.createDataFrame([(1, "x")], "id long, name string").write.json(feed)
    first = pinned_schema(spark, feed, "json", c)
    wider = spark.createDataFrame([(2, "y", 3.5)], "id long, name string, more double")
    wider.write.mode("append").json(feed)
    assert pinned_schema(spark, feed, "json", c) == first
    assert pinned_schema(spark, feed, "json", str(tmp_path / "other")).names == ["id", "more", "name"]
    again = read_feed(spark, feed, "json", c)
    assert again.isStreaming and again.columns == ["id", "name"]


def test_a_restart_after_a_wider_file_keeps_the_schema(spark, tmp_path):
    feed, out, c = (str(tmp_path / p) for p in ("feed", "out", "c"))

    def run():
        read_feed(spark, feed, "parquet", c, max_per_trigger=1).writeStream.format("parquet").option(
            "checkpointLocation", c
        ).trigger(availableNow=True).start(out).awaitTermination()

    spark.createDataFrame([(1, "x")], "id long, name string").write.parquet(feed)
    run()
    wider = spark.createDataFrame([(2.5, 2, "y")], "more double, id long, name string")
    wider.write.mode("append").parquet(feed)
    run()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, "x"), (2, "y")]
