"""

The test tables stand in for the two tables of the pipelines: ``orders`` for
event results and ``customer`` for biographies, with nulls and NaN put in.
Averages may be NaN; those queries give null in place of NaN and say so in a
boolean column.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from podium.functions.codec import decode_json, encode_json
from podium.operators.clean import drop_duplicate_rows, drop_missing, normalize_text
from podium.operators.enrich import avg_stats
from podium.operators.ledger import (
    ROTATED_PAIRS,
    append_count,
    count_pairs,
    count_where,
    create_ledger,
    is_fresh,
    recent_entry,
)
from podium.plans.enrichment import (
    consume_epochs,
    consume_topic,
    enrich_epochs,
    enrich_stream,
    last_epoch,
    publish_table,
)
from podium.plans.medallion import BIO, RESULTS, bronze_to_silver, landing_to_bronze, run_medallion
from podium.schemas import ENRICHED_AVG, with_names
from podium.shared import working_dir
from podium.sinks import write_layer, write_topic
from podium.sources import read_feed, read_topic
from podium.streaming.fanout import latest_snapshot, to_table, to_topic

try:
    import corpus_pipeline
    from podium.llm.queries import QUERIES as LLM_QUERIES
    from podium.llm.queries import SQL as LLM_SQL
except ModuleNotFoundError as missing:  # the subpackage and its pipeline may be left out
    if missing.name not in ("corpus_pipeline", "podium.llm", "podium.llm.queries"):
        raise
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        LLM_SQL = LLM_SQL | {"pipeline": corpus_pipeline.ORACLE_SQL}

RES_COLUMNS = [
    "o_custkey as athlete_id",
    "lower(o_orderpriority) as sport",
    "case o_orderkey % 4 when 0 then 'Gold' when 1 then 'Silver' when 2 then 'Bronze' end as medal",
    "concat('N', cast(o_orderkey % 25 as varchar(3))) as country_noc",
    "o_orderkey as result_id",
]
BIO_COLUMNS = [
    "c_custkey as athlete_id",
    "c_name as name",
    "case when c_custkey % 2 = 0 then 'M' else 'F' end as sex",
    "concat('N', cast(c_nationkey as varchar(3))) as country_noc",
    "case when c_custkey % 17 = 0 then null"
    " when c_custkey % 19 = 0 then cast('NaN' as double)"
    " else cast(150 + c_custkey % 60 as double) end as height",
    "case when c_custkey % 23 = 0 then null"
    " else cast(45 + c_custkey % 71 as double) end as weight",
]
# Biographies whose measures are amounts of money, in cents.
CENTS_COLUMNS = [
    "c_custkey as athlete_id",
    "c_mktsegment as sex",
    "c_acctbal as height",
    "-c_acctbal as weight",
]

# Files of a feed that make an epoch; a feed has four times as many.
EPOCH_FILES = 2

MEDALS = ["Gold", "Silver", "Bronze"]
KEYS = ["sport", "medal", "sex", "country_noc"]


# --- inputs ---------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _res(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(*RES_COLUMNS)


def _bio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr(*BIO_COLUMNS)


def _nan_flagged(stats: DataFrame) -> DataFrame:
    """Averages with NaN as null, and whether they were NaN."""
    columns = [F.col(k) for k in KEYS]
    for name in ("height", "weight"):
        avg = F.col(f"avg_{name}")
        columns.append(F.when(~F.isnan(avg), avg).alias(f"avg_{name}"))
        columns.append(F.isnan(avg).alias(f"nan_{name}"))
    return stats.select(columns)


def _twice(messages: DataFrame) -> DataFrame:
    """Messages encoded once more, as text in JSON."""
    escaped = F.replace(
        F.replace(F.col("value"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')
    )
    return messages.withColumn("value", F.concat(F.lit('"'), escaped, F.lit('"')))


def _published_results(
    spark: SparkSession, sf_dir: str, twice_encoded: bool = False
) -> tuple[str, int]:
    """Publish the results to a feed; the feed and how many files make an epoch."""
    res = _res(spark, sf_dir).repartition(4 * EPOCH_FILES)
    feed = working_dir(spark, "feed")
    if twice_encoded:
        write_topic(_twice(encode_json(res)), feed, fmt="text")
    else:
        publish_table(res, feed, fmt="text")
    return feed, EPOCH_FILES


def _enriched(
    spark: SparkSession, sf_dir: str, sinks: list, twice_encoded: bool = False, **options
) -> None:
    """Run the enrichment stream over the published results, in several epochs."""
    feed, files = _published_results(spark, sf_dir, twice_encoded)
    enrich_stream(
        read_topic(spark, feed, fmt="text", max_per_trigger=files),
        _bio(spark, sf_dir),
        sinks,
        working_dir(spark, "checkpoint"),
        schema=_res(spark, sf_dir).schema,
        available_now=True,
        **options,
    ).awaitTermination()


# --- averages -------------------------------------------------------------


def gold_avg_stats(spark, sf_dir):
    stats = avg_stats(_res(spark, sf_dir), _bio(spark, sf_dir), country_from="event")
    return _nan_flagged(stats)


def gold_avg_stats_shuffled(spark, sf_dir):
    stats = avg_stats(
        _res(spark, sf_dir), _bio(spark, sf_dir), country_from="event", join="shuffle"
    )
    return _nan_flagged(stats)


def gold_avg_stats_cents(spark, sf_dir):
    bio = _table(spark, sf_dir, "customer").selectExpr(*CENTS_COLUMNS)
    return avg_stats(_res(spark, sf_dir), bio, country_from="event", scale=2).drop("timestamp")


def enrich_batch(spark, sf_dir):
    stats = avg_stats(
        _res(spark, sf_dir), _bio(spark, sf_dir), country_from="bio", drop_missing=True
    )
    return stats.drop("timestamp")


def enrich_stream_query(spark, sf_dir):
    table = working_dir(spark, "enriched")
    _enriched(spark, sf_dir, [to_table(table)])
    return latest_snapshot(spark, table).drop("timestamp")


def enrich_stream_shuffled(spark, sf_dir):
    table = working_dir(spark, "enriched")
    _enriched(spark, sf_dir, [to_table(table)], join="shuffle")
    return latest_snapshot(spark, table).drop("timestamp")


def enrich_stream_unfiltered(spark, sf_dir):
    table = working_dir(spark, "enriched")
    _enriched(spark, sf_dir, [to_table(table)], country_from="event", drop_missing=False)
    return _nan_flagged(latest_snapshot(spark, table))


def enrich_stream_unwrapped(spark, sf_dir):
    """The feed encoded twice, as some publishers leave it."""
    table = working_dir(spark, "enriched")
    _enriched(spark, sf_dir, [to_table(table)], twice_encoded=True, unwrap=True)
    return latest_snapshot(spark, table).drop("timestamp")


def enrich_stream_epochs(spark, sf_dir):
    """Each epoch a batch that reads the biographies anew; the sums so far in a table."""
    table, checkpoint = working_dir(spark, "enriched"), working_dir(spark, "checkpoint")
    feed, files = _published_results(spark, sf_dir)
    enrich_epochs(
        read_topic(spark, feed, fmt="text", max_per_trigger=files),
        lambda: _bio(spark, sf_dir),
        [to_table(table)],
        checkpoint,
        schema=_res(spark, sf_dir).schema,
        available_now=True,
    ).awaitTermination()
    return latest_snapshot(spark, table).drop("timestamp")


def fan_out_once(spark, sf_dir):
    """A failure between two sinks in the last epoch, a restart, and no row sent twice.

    Each group of the last epoch with the number of its messages there.
    """
    feed, files = _published_results(spark, sf_dir)
    topic, table, checkpoint = (working_dir(spark, p) for p in ("topic", "table", "checkpoint"))
    failures = []

    def fails_once(batch: DataFrame, epoch_id: int) -> None:
        if epoch_id == 3 and not failures:
            failures.append(epoch_id)
            raise OSError("a failure between two sinks")

    def run() -> None:
        sink = to_topic(topic, fmt="text", epoch_column="epoch_id", log=f"{topic}/_epochs")
        enrich_stream(
            read_topic(spark, feed, fmt="text", max_per_trigger=files),
            _bio(spark, sf_dir),
            [sink, fails_once, to_table(table)],
            checkpoint,
            schema=_res(spark, sf_dir).schema,
            available_now=True,
        ).awaitTermination()

    try:
        run()
    except StreamingQueryException:
        if not failures:
            raise
        run()
    schema = StructType([*ENRICHED_AVG.fields, StructField("epoch_id", LongType())])
    sent = decode_json(spark.read.text(topic), schema).filter("epoch_id = 3")
    averages = [F.first(f"avg_{m}").alias(f"avg_{m}") for m in ("height", "weight")]
    return sent.groupBy(*KEYS).agg(*averages, F.count("*").alias("copies"))


def consume_last_epoch(spark, sf_dir):
    """The last whole result of a topic that has one epoch twice and one broken off."""
    topic, path = working_dir(spark, "topic"), working_dir(spark, "consumed")
    sink = to_topic(topic, fmt="text", epoch_column="epoch_id", rows_column="epoch_rows")
    _enriched(spark, sf_dir, [sink])
    numbers = [StructField(n, LongType()) for n in ("epoch_id", "epoch_rows")]
    sent = decode_json(spark.read.text(topic), StructType([*ENRICHED_AVG.fields, *numbers]))
    last = kept_messages(sent.filter("epoch_id = 3"))
    write_topic(encode_json(last), topic, fmt="text")
    broken = last.withColumn("epoch_id", F.lit(4).cast("long")).filter("medal = 'Gold'")
    write_topic(encode_json(broken), topic, fmt="text")
    consume_epochs(
        read_topic(spark, topic, fmt="text", max_per_trigger=3),
        path,
        working_dir(spark, "checkpoint"),
    ).awaitTermination()
    return last_epoch(spark, path).drop("timestamp")


def kept_messages(messages: DataFrame) -> DataFrame:
    """Messages written apart, so that they can be appended to where they were read."""
    path = working_dir(messages.sparkSession, "messages")
    messages.write.parquet(path)
    return messages.sparkSession.read.schema(messages.schema).parquet(path)


def stream_pinned_schema(spark, sf_dir):
    """A feed of JSON without a schema: inferred once, and kept when wider files come."""
    feed, path, checkpoint = (working_dir(spark, p) for p in ("feed", "rows", "checkpoint"))
    res = _res(spark, sf_dir)

    def run() -> None:
        rows = read_feed(spark, feed, "json", checkpoint, max_per_trigger=2)
        query = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start(path).awaitTermination()

    res.filter("result_id % 2 = 0").repartition(4).write.json(feed)
    run()
    wider = res.filter("result_id % 2 = 1").withColumn("added", F.lit("later"))
    wider.repartition(4).write.mode("append").json(feed)
    run()
    return spark.read.parquet(path).select(res.columns)


def fan_out_snapshots(spark, sf_dir):
    """The last epoch of each sink, that of the topic read back from its messages."""
    topic, every, last = (working_dir(spark, p) for p in ("topic", "every", "last"))
    _enriched(
        spark,
        sf_dir,
        [
            to_topic(topic, fmt="text", epoch_column="epoch_id"),
            to_table(every),
            to_table(last, "replace"),
        ],
    )
    schema = StructType([*ENRICHED_AVG.fields, StructField("epoch_id", LongType())])
    sent = decode_json(spark.read.text(topic), schema)
    newest = F.max("epoch_id").over(Window.partitionBy(*KEYS))
    # Groups only grow from epoch to epoch, so the last epoch has all of them.
    read = sent.withColumn("newest", newest).filter("epoch_id = newest").drop("epoch_id", "newest")
    parts = {
        "topic": read,
        "append": latest_snapshot(spark, every),
        "replace": latest_snapshot(spark, last),
    }
    named = [df.withColumn("snapshot", F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, named).drop("timestamp")


# --- cleaning and layers --------------------------------------------------


def drop_missing_query(spark, sf_dir):
    return drop_missing(_bio(spark, sf_dir))


def silver_normalize(spark, sf_dir):
    root = working_dir(spark, "layers")
    write_layer(_table(spark, sf_dir, "part"), root, "bronze", "part")
    return bronze_to_silver(spark, root, ["part"])["part"]


def text_normalize(spark, sf_dir):
    return normalize_text(_table(spark, sf_dir, "documents"))


def silver_dedupe(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("text", "lang")
    return drop_duplicate_rows(normalize_text(documents))


def csv_to_bronze(spark, sf_dir):
    landing, root = working_dir(spark, "landing"), working_dir(spark, "layers")
    part = _table(spark, sf_dir, "part")
    part.write.csv(f"{landing}/part.csv", header=True)
    bronze = landing_to_bronze(spark, landing, root, ["part"])["part"]
    # Inference gives the narrowest type that holds the keys.
    return bronze.withColumn("p_partkey", F.col("p_partkey").cast("long"))


def medallion_end_to_end(spark, sf_dir):
    landing, root = working_dir(spark, "landing"), working_dir(spark, "layers")
    _bio(spark, sf_dir).write.csv(f"{landing}/{BIO}.csv", header=True)
    _res(spark, sf_dir).write.csv(f"{landing}/{RESULTS}.csv", header=True)
    return _nan_flagged(run_medallion(spark, landing, root))


# --- messages -------------------------------------------------------------


def json_roundtrip(spark, sf_dir):
    res = _res(spark, sf_dir)
    return decode_json(encode_json(res), res.schema)


def json_roundtrip_binary(spark, sf_dir):
    """Messages as a broker hands them out: a key, and bytes."""
    res = _res(spark, sf_dir)
    messages = encode_json(res).withColumn("value", F.col("value").cast("binary"))
    return decode_json(messages, res.schema, keep=["key"])


def json_roundtrip_escaped(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return decode_json(encode_json(events, micros), events.schema, options=micros)


def json_unwrap(spark, sf_dir):
    res = _res(spark, sf_dir)
    return decode_json(_twice(encode_json(res)), res.schema, unwrap=True)


def json_unwrap_lossy(spark, sf_dir):
    """Messages with JSON text inside do not survive unwrapping."""
    events = _table(spark, sf_dir, "events").select("event_id", "props")
    back = decode_json(encode_json(events), events.schema, unwrap=True)
    return back.agg(
        F.count("*").alias("messages"), F.count_if(F.col("event_id").isNull()).alias("lost")
    )


def _consumed(spark: SparkSession, stats: DataFrame, schema: StructType) -> DataFrame:
    """Publish averages and read them again by ``schema``."""
    feed, table = working_dir(spark, "feed"), working_dir(spark, "consumed")
    publish_table(stats, feed, fmt="text")
    consume_topic(
        read_topic(spark, feed, fmt="text", max_per_trigger=50),
        schema=schema,
        path=table,
        checkpoint=working_dir(spark, "checkpoint"),
    ).awaitTermination()
    return spark.read.parquet(table)


def publish_consume(spark, sf_dir):
    stats = avg_stats(_res(spark, sf_dir), _bio(spark, sf_dir), country_from="event")
    return _nan_flagged(_consumed(spark, stats, ENRICHED_AVG))


def publish_consume_renamed(spark, sf_dir):
    """A consumer that calls the country otherwise finds null there."""
    stats = avg_stats(
        _res(spark, sf_dir), _bio(spark, sf_dir), country_from="bio", drop_missing=True
    )
    schema = with_names(ENRICHED_AVG, {"country_noc": "noc_country"})
    return _consumed(spark, stats, schema).drop("timestamp")


# --- ledger ---------------------------------------------------------------


def medal_counts(spark, sf_dir):
    return count_pairs(_res(spark, sf_dir), "medal", [(m, m) for m in MEDALS])


def medal_count_gold(spark, sf_dir):
    return count_where(_res(spark, sf_dir), "medal", "Gold")


def ledger_rotated(spark, sf_dir):
    """Entries, and whether each has a time that is not before the end of the count."""
    ledger = working_dir(spark, "ledger")
    counted = append_count(
        count_pairs(_res(spark, sf_dir), "medal", ROTATED_PAIRS), path=ledger
    )
    if not is_fresh(spark.read.parquet(ledger)):
        raise ValueError("the ledger is stale right after an entry")
    return spark.read.parquet(ledger).select(
        "medal_type", "count", (F.col("created_at") >= F.lit(counted)).alias("timed_after_count")
    )


def ledger_default_time(spark, sf_dir):
    """A ledger of the catalog, made twice; entries are inserted without a time."""
    name, path = f"podium_ledger_{uuid.uuid4().hex}", working_dir(spark, "ledger")
    create_ledger(spark, name, path)
    create_ledger(spark, name, path)
    counted = append_count(
        count_pairs(_res(spark, sf_dir), "medal", ROTATED_PAIRS), table=name, path=path
    )
    if not is_fresh(spark.table(name)):
        raise ValueError("the ledger is stale right after an entry")
    spark.sql(f"drop table {name}")  # its files stay
    return spark.read.parquet(path).select(
        "medal_type",
        "count",
        F.col("created_at").isNotNull().alias("has_time"),
        (F.col("created_at") >= F.lit(counted)).alias("timed_after_count"),
    )


def ledger_fresh(spark, sf_dir):
    """Events as ledger entries, with the time of the last as the clock."""
    entries = _table(spark, sf_dir, "events").select(F.col("ts").alias("created_at"))
    now = entries.agg(F.max("created_at")).scalar()
    return recent_entry(entries, now=now)


# --- contract -------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Average height and weight by group, on the smallest tables."""
    return gold_avg_stats(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "gold_avg_stats": gold_avg_stats,
        "gold_avg_stats_shuffled": gold_avg_stats_shuffled,
        "gold_avg_stats_cents": gold_avg_stats_cents,
        "enrich_batch": enrich_batch,
        "enrich_stream": enrich_stream_query,
        "enrich_stream_shuffled": enrich_stream_shuffled,
        "enrich_stream_unfiltered": enrich_stream_unfiltered,
        "enrich_stream_unwrapped": enrich_stream_unwrapped,
        "enrich_stream_epochs": enrich_stream_epochs,
        "fan_out_snapshots": fan_out_snapshots,
        "fan_out_once": fan_out_once,
        "drop_missing": drop_missing_query,
        "silver_normalize": silver_normalize,
        "text_normalize": text_normalize,
        "silver_dedupe": silver_dedupe,
        "csv_to_bronze": csv_to_bronze,
        "medallion_end_to_end": medallion_end_to_end,
        "json_roundtrip": json_roundtrip,
        "json_roundtrip_binary": json_roundtrip_binary,
        "json_roundtrip_escaped": json_roundtrip_escaped,
        "json_unwrap": json_unwrap,
        "json_unwrap_lossy": json_unwrap_lossy,
        "publish_consume": publish_consume,
        "publish_consume_renamed": publish_consume_renamed,
        "consume_last_epoch": consume_last_epoch,
        "stream_pinned_schema": stream_pinned_schema,
        "medal_counts": medal_counts,
        "medal_count_gold": medal_count_gold,
        "ledger_rotated": ledger_rotated,
        "ledger_default_time": ledger_default_time,
        "ledger_fresh": ledger_fresh,
    } | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    views = (
        f"with res as (select {', '.join(RES_COLUMNS)} from orders), "
        f"bio as (select {', '.join(BIO_COLUMNS)} from customer) "
    )
    flagged = ", ".join(
        f"case when isnan(avg({m})) then null else avg({m}) end as avg_{m}, "
        f"coalesce(isnan(avg({m})), false) as nan_{m}"
        for m in ("height", "weight")
    )
    gold = (
        views + f"select sport, medal, sex, res.country_noc as country_noc, {flagged} "
        "from res join bio using (athlete_id) group by sport, medal, sex, res.country_noc"
    )
    medallion = (
        views + "select trim(sport, ' ') as sport, lower(medal) as medal, lower(sex) as sex, "
        f"lower(res.country_noc) as country_noc, {flagged} "
        "from res join bio using (athlete_id) group by 1, 2, 3, 4"
    )
    cents = ", ".join(
        f"cast(sum(cast({m} as decimal(18, 2))) as double) / count({m}) as avg_{m}"
        for m in ("height", "weight")
    )
    present = (
        "height is not null and not isnan(height) and weight is not null and not isnan(weight)"
    )
    enriched = (
        "select sport, medal, sex, bio.country_noc as country_noc, "
        "avg(height) as avg_height, avg(weight) as avg_weight "
        f"from res join bio using (athlete_id) where {present} "
        "group by sport, medal, sex, bio.country_noc"
    )
    cleaned_part = ", ".join(
        f"trim(lower({c}), ' ') as {c}" for c in ("p_name", "p_brand", "p_type")
    )
    return {
        "gold_avg_stats": gold,
        "gold_avg_stats_shuffled": gold,
        "gold_avg_stats_cents": (
            f"with res as (select {', '.join(RES_COLUMNS)} from orders), "
            f"bio as (select {', '.join(CENTS_COLUMNS)} from customer) "
            f"select sport, medal, sex, country_noc, {cents} "
            "from res join bio using (athlete_id) group by sport, medal, sex, country_noc"
        ),
        "enrich_batch": views + enriched,
        "enrich_stream": views + enriched,
        "enrich_stream_shuffled": views + enriched,
        "enrich_stream_unfiltered": gold,
        "enrich_stream_unwrapped": views + enriched,
        "enrich_stream_epochs": views + enriched,
        "fan_out_once": f"{views}, stats as ({enriched}) select *, 1 as copies from stats",
        "consume_last_epoch": views + enriched,
        "stream_pinned_schema": f"{views} select * from res",
        "fan_out_snapshots": (
            f"{views}, stats as ({enriched}) "
            "select *, 'topic' as snapshot from stats "
            "union all select *, 'append' as snapshot from stats "
            "union all select *, 'replace' as snapshot from stats"
        ),
        "drop_missing": f"{views} select * from bio where {present}",
        "silver_normalize": (
            f"select distinct p_partkey, {cleaned_part}, p_size, p_retailprice from part"
        ),
        "text_normalize": (
            "select doc_id, trim(lower(text), ' ') as text, trim(lower(lang), ' ') as lang, "
            "trim(lower(source), ' ') as source, n_chars from documents"
        ),
        "silver_dedupe": (
            "select distinct trim(lower(text), ' ') as text, trim(lower(lang), ' ') as lang "
            "from documents"
        ),
        "csv_to_bronze": "select * from part",
        "medallion_end_to_end": medallion,
        "json_roundtrip": f"{views} select * from res",
        "json_roundtrip_binary": f"{views} select cast(null as varchar) as key, * from res",
        "json_roundtrip_escaped": "select * from events",
        "json_unwrap": f"{views} select * from res",
        "json_unwrap_lossy": (
            "select count(*) as messages, "
            "count(*) filter (where props like '%\"%') as lost from events"
        ),
        "publish_consume": gold,
        "publish_consume_renamed": (
            f"{views}, stats as ({enriched}) "
            "select sport, medal, sex, cast(null as varchar) as noc_country, "
            "avg_height, avg_weight from stats"
        ),
        "medal_counts": views
        + " union all ".join(
            f"select '{m}' as medal_type, count(*) as \"count\" from res where medal = '{m}'"
            for m in MEDALS
        ),
        "medal_count_gold": f"{views} select count(*) as \"count\" from res where medal = 'Gold'",
        "ledger_rotated": views
        + " union all ".join(
            f"select '{label}' as medal_type, count(*) as \"count\", true as timed_after_count "
            f"from res where medal = '{m}'"
            for label, m in ROTATED_PAIRS
        ),
        "ledger_default_time": views
        + " union all ".join(
            f"select '{label}' as medal_type, count(*) as \"count\", true as has_time, "
            f"true as timed_after_count from res where medal = '{m}'"
            for label, m in ROTATED_PAIRS
        ),
        "ledger_fresh": (
            "select 1 as fresh, ts as created_at from events "
            "where ts > (select max(ts) from events) - interval 30 second "
            "order by ts desc limit 1"
        ),
    } | LLM_SQL
