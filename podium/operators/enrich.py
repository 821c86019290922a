"""Average height and weight by sport, medal, sex and country.

The averages are over result rows: an athlete with three results counts three
times. Results and biographies meet on ``athlete_id``, and both sides are
brought down before they meet:

* a biography row turns into sums and counts per athlete, sex and country, so
  repeated biographies of one athlete are never paired with each result row;
* when the biographies are too large to broadcast, the sums of athletes with very
  many results still are not: their results stay where they are, so an athlete
  with a third of all results sends nothing into the shuffle. The other results
  are shuffled once, as they are.

``avg`` is put together again as sum over count after the join.
"""

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.operators.clean import as_measure, field, quoted
from podium.operators.clean import drop_missing as only_measured
from podium.shared import removed_at_exit, working_dir

KEY = "athlete_id"
GROUP = ["sport", "medal", "sex", "country_noc"]
MEASURES = ["height", "weight"]
BROADCAST_BYTES = 64 * 1024 * 1024

# What a hashed row costs beside its values.
ROW_OVERHEAD_BYTES = 64

# An athlete is hot above this share of the results, or above what one shuffle
# partition gets on average if that is less, down to the least share; so at most
# ten thousand are. The sketches that find them miss none above twice that share.
HOT_SHARE = 0.001
LEAST_HOT_SHARE = 0.0001
HOT_SKETCHES = 1024

# Digits of a measure that is summed exactly, and of the number of its results:
# their product fits in Spark's 38.
EXACT_DIGITS = 19
COUNT_DIGITS = 18

# Counts a task of a stream holds before it passes them on.
HELD_ROWS = 200_000


def avg_stats(
    results: DataFrame,
    bio: DataFrame,
    country_from: str = "event",
    drop_missing: bool = False,
    join: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
    scale: int | None = None,
    static_dir: str | None = None,
) -> DataFrame:
    """Join results to biographies and average the measures by group.

    ``results`` may be a batch or a stream; ``bio`` is always a batch.

    ``country_from``: ``"event"`` groups by the country of the result row,
    ``"bio"`` by the country of the biography.

    ``drop_missing``: leave out biographies whose height or weight is null or
    NaN. Otherwise nulls are skipped and one NaN makes its group NaN.

    ``join``: ``"broadcast"`` sends the biographies to every task, and fails
    when they measure more than ``broadcast_bytes``;
    ``"shuffle"`` looks for hot athletes (one aggregate over their ids),
    broadcasts their sums if those are small enough and shuffles the rest of
    both sides; ``"auto"`` measures the biographies (one aggregate over the
    columns used) and broadcasts up to ``broadcast_bytes``. On a stream
    ``"auto"`` broadcasts only files, whose list is fixed when they are loaded; a
    database table is read anew in each epoch and may outgrow the measurement, so
    it is not measured. Sums of biographies in files are written once when a
    stream starts, to ``static_dir`` or else to the shared folder, in buckets by
    athlete: no epoch adds them up or shuffles them again.

    ``scale``: round the measures to so many digits after the point (0 to 18) and
    sum them as decimals, which makes the averages the same to the bit whatever
    the order of rows. NaN then counts as missing. A measure of more than 19
    digits, those after the point among them, is an error, and so are sums of
    more than 38.
    """
    joined = _joined(
        results, bio, country_from, drop_missing, join, broadcast_bytes, scale, static_dir
    )
    return joined.groupBy(*GROUP).agg(
        *[_average(name, scale).alias(f"avg_{name}") for name in MEASURES],
        F.current_timestamp().alias("timestamp"),
    )


def sum_stats(
    results: DataFrame,
    bio: DataFrame,
    country_from: str = "event",
    drop_missing: bool = False,
    join: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Sum and count of each measure by group, of batches; as ``avg_stats`` otherwise.

    Those of several batches can be added up: ``add_sums``, and ``average_sums`` in the end.
    """
    joined = _joined(results, bio, country_from, drop_missing, join, broadcast_bytes)
    return joined.groupBy(*GROUP).agg(
        *[
            F.sum(F.col("n") * F.col(f"{what}_{name}")).alias(f"{what}_{name}")
            for name in MEASURES
            for what in ("sum", "count")
        ]
    )


def add_sums(sums: DataFrame) -> DataFrame:
    """One row a group of sums that may have several."""
    columns = [f"{what}_{name}" for name in MEASURES for what in ("sum", "count")]
    return sums.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in columns])


def average_sums(sums: DataFrame) -> DataFrame:
    """What ``avg_stats`` gives, from sums with one row a group."""
    return sums.select(
        *GROUP,
        *[F.try_divide(f"sum_{name}", f"count_{name}").alias(f"avg_{name}") for name in MEASURES],
        F.current_timestamp().alias("timestamp"),
    )


def _joined(
    results: DataFrame,
    bio: DataFrame,
    country_from: str,
    drop_missing: bool,
    join: str,
    broadcast_bytes: int,
    scale: int | None = None,
    static_dir: str | None = None,
) -> DataFrame:
    """Results, or counts ``n`` of equal ones, with their athlete's sums and counts."""
    if country_from not in ("event", "bio"):
        raise ValueError("country_from is 'event' or 'bio'")
    if join not in ("auto", "broadcast", "shuffle"):
        raise ValueError("join is 'auto', 'broadcast' or 'shuffle'")
    if scale is not None and not 0 <= scale < EXACT_DIGITS:
        raise ValueError(f"scale is 0 to {EXACT_DIGITS - 1}")

    result_columns = [KEY, "sport", "medal"]
    bio_columns = [KEY, "sex"]
    (result_columns if country_from == "event" else bio_columns).append("country_noc")

    results, bio = _same_keys(_named(results, result_columns), _named(bio, bio_columns, MEASURES))
    results = results.filter(F.col(KEY).isNotNull())
    bio = bio.filter(F.col(KEY).isNotNull())
    if drop_missing:
        bio = only_measured(bio, MEASURES)
    fixed = not results.isStreaming or only_files(bio)
    totals = _totals(bio, bio_columns, scale)
    if results.isStreaming and fixed:
        totals = _bucketed(totals, static_dir or working_dir(totals.sparkSession, "totals"))
    if join == "broadcast" or (join == "auto" and fixed):
        join = _measured_join(join, totals, broadcast_bytes)

    if join == "broadcast":
        return _each_once(results).join(F.broadcast(totals), KEY)
    if results.isStreaming:
        return _count_in_tasks(results).join(totals, KEY)
    return _join_hot_apart(results, totals, broadcast_bytes)


def _named(df: DataFrame, *names: list[str]) -> DataFrame:
    """These columns, called so whatever their case."""
    columns = [name for part in names for name in part]
    return df.select(*(quoted(field(df, name).name).alias(name) for name in columns))


def only_files(df: DataFrame) -> bool:
    """Whether every table that ``df`` reads is a list of files, fixed when it was loaded."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            return False
        if leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
            return False
    return True


def _same_keys(results: DataFrame, bio: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids left as text by inference, as the type they have on the other side.

    Text that is no such id gives null and so matches nothing.
    """
    left, right = results.schema[KEY].dataType, bio.schema[KEY].dataType
    if left != right and isinstance(left, T.StringType):
        results = results.withColumn(KEY, F.col(KEY).try_cast(right))
    elif left != right and isinstance(right, T.StringType):
        bio = bio.withColumn(KEY, F.col(KEY).try_cast(left))
    return results, bio


def _totals(bio: DataFrame, columns: list[str], scale: int | None) -> DataFrame:
    """Sum and count of each measure per athlete, sex and, if used, country."""
    sums = []
    for name in MEASURES:
        value = as_measure(bio, name)
        if scale is not None:
            value = F.when(~F.isnan(value), value)
            value = _fitting(value, f"decimal({EXACT_DIGITS},{scale})", name)
        sums += [F.sum(value).alias(f"sum_{name}"), F.count(value).alias(f"count_{name}")]
    return bio.groupBy(*columns).agg(*sums)


def _fitting(value: Column, kind: str, name: str) -> Column:
    """``value`` as decimal; an error, and never null, where it has more digits."""
    too_long = F.raise_error(F.lit(f"{name} has more digits than {kind} holds"))
    return F.when(value.isNotNull(), F.coalesce(value.try_cast(kind), too_long))


def _average(name: str, scale: int | None) -> Column:
    n, total, count = F.col("n"), F.col(f"sum_{name}"), F.sum(F.col("n") * F.col(f"count_{name}"))
    if scale is None:
        return F.try_divide(F.sum(n * total), count)
    each = _fitting(total, f"decimal({EXACT_DIGITS},{scale})", f"sum of {name}")
    summed = F.try_sum(_fitting(n, f"decimal({COUNT_DIGITS},0)", "count") * each)
    too_long = F.raise_error(F.lit(f"sum of {name} has more than 38 digits"))
    whole = F.when(count > 0, F.coalesce(summed.cast("double"), too_long))
    return F.try_divide(whole, count)


def _each_once(results: DataFrame) -> DataFrame:
    return results.withColumn("n", F.lit(1).cast("long"))


def _join_hot_apart(results: DataFrame, totals: DataFrame, limit: int) -> DataFrame:
    """Join by shuffling; rows of hot athletes stay in place and meet their sums there.

    The sums are written first, since both joins read them and the broadcast has to
    be measured; they are removed when the program ends. Hot sums beyond ``limit`` bytes
    go the way of all others.
    """
    spark = results.sparkSession
    share = hot_share(int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_keys(results, share)
    if not hot:
        return _each_once(results).join(totals, KEY)
    path = working_dir(spark, "totals")
    removed_at_exit(spark, path)
    totals.write.parquet(path)
    totals = spark.read.schema(totals.schema).parquet(path)
    is_hot = F.col(KEY).isin(hot)
    hot_totals = totals.filter(is_hot)
    if measured_bytes(hot_totals, hot_totals.columns) > limit:
        return _each_once(results).join(totals, KEY)
    each = _each_once(results)
    return (
        each.filter(~is_hot)
        .join(totals.filter(~is_hot), KEY)
        .unionByName(each.filter(is_hot).join(F.broadcast(hot_totals), KEY))
    )


def hot_share(partitions: int) -> float:
    """Above which share of the rows an athlete is too much for a shuffle partition."""
    return max(LEAST_HOT_SHARE, min(HOT_SHARE, 1 / partitions))


def hot_keys(results: DataFrame, share: float = HOT_SHARE) -> list:
    """Athletes with more than ``share`` of the rows, at most ``1 / share``.

    Frequent-items sketches in one pass over one column. Tasks share a limited
    number of sketches, so that those of very many tasks do not meet in one.
    The null item stands for all rows.
    """
    most = round(1 / share)
    sketched = (
        results.filter(F.col(KEY).isNotNull())
        .groupBy((F.spark_partition_id() % HOT_SKETCHES).alias("sketch"))
        .agg(
            F.expr(f"approx_top_k({KEY}, {most}, {10 * most})").alias("items"),
            F.count("*").alias("rows"),
        )
    )
    everything = F.expr("array(named_struct('item', null, 'count', rows))")
    counted = (
        sketched.select(F.inline(F.concat("items", everything)))
        .groupBy("item")
        .agg(F.sum("count").alias("n"))
        .orderBy(F.col("n").desc())
        .limit(1 + most)
        .collect()
    )
    rows = sum(row.n for row in counted if row.item is None)
    return [row.item for row in counted if row.item is not None and row.n > share * rows]


def _count_in_tasks(results: DataFrame) -> DataFrame:
    """Equal rows of a stream as few rows with their number ``n``.

    A grouped count would be a second stateful aggregate, so each task counts
    its own rows: no state, no shuffle, and the same sums later on. A task holds
    a limited number of counts and passes them on when they do not shrink.
    """
    names = results.columns

    def count_each(batches):
        import pyarrow as pa

        def grouped(table, column, function):
            counts = table.group_by(names, use_threads=False).aggregate([(column, function)])
            return counts.select([*names, counts.column_names[-1]]).rename_columns([*names, "n"])

        held, size = [], 0
        for batch in batches:
            held.append(grouped(pa.Table.from_batches([batch]), [], "count_all"))
            size += held[-1].num_rows
            if size > HELD_ROWS:
                together = grouped(pa.concat_tables(held), "n", "sum")
                held, size = [together], together.num_rows
                if size > HELD_ROWS // 2:
                    yield from together.to_batches()
                    held, size = [], 0
        if held:
            yield from grouped(pa.concat_tables(held), "n", "sum").to_batches()

    schema = T.StructType([*results.schema.fields, T.StructField("n", T.LongType())])
    return results.mapInArrow(count_each, schema)


def _bucketed(totals: DataFrame, path: str) -> DataFrame:
    """The totals as a table in buckets sorted by athlete, in place of any at ``path``.

    As many buckets as the stream has shuffle partitions, so a join by athlete finds
    this side dealt and sorted. Table and files go when the program ends: a stream that
    is started again makes its own.
    """
    spark = totals.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"podium_totals_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    spark.sql(f"drop table if exists {name}")
    removed_at_exit(spark, path, name)
    (
        totals.repartition(buckets, KEY)
        .write.mode("overwrite")
        .bucketBy(buckets, KEY)
        .sortBy(KEY)
        .option("path", path)
        .saveAsTable(name)
    )
    return spark.table(name)


def _measured_join(join: str, totals: DataFrame, limit: int) -> str:
    size = measured_bytes(totals, totals.columns)
    if join == "broadcast" and size > limit:
        raise ValueError(f"biographies of {size} bytes are too large to broadcast")
    return "broadcast" if size <= limit else "shuffle"


def measured_bytes(df: DataFrame, columns: list[str], extra: int = 0) -> int:
    """Size of ``columns`` held in memory, plus ``extra`` bytes per row.

    One aggregate over the whole table; a single number comes back.
    """
    width = F.lit(ROW_OVERHEAD_BYTES + extra + 8 * len(columns))
    for name in columns:
        if isinstance(df.schema[name].dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(quoted(name)), F.lit(0))
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")).first()[0]
