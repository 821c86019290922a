"""Mixing sources to target weights, by prefix sums over hash-random order.

Every document has a random key, a hash of its id and text. Within a source the
documents are put in ranges of equal key width and sorted there; sums of whole
ranges give each range its start, and running sums inside it give each document
its own. A source's budget is then cut exactly where the running sum meets it:
full passes over the source first, then the beginning of one more.

Only ranges are ever sorted by one task, and they are as many as the largest
source asks for. Rows with equal id, text and source are counted before they are
shuffled and told apart only in the result.

A null or empty text has size 0 and gives nothing. A null source is a source,
the last in order. Repeated rows are repeated in the result; where the budget
ends among equal rows, some of them are taken. An empty table gives an empty
result. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import kept

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the random key.
KEY_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column) -> Column:
    """A 60-bit number from the id and the text of a document."""
    both = F.concat_ws(" ", F.coalesce(doc_id.cast("string"), F.lit("")), text)
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(
    totals: DataFrame, weights: tuple[float, ...], share: float, most: float
) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from ``source`` and ``source_size``.

    Sources by code point, null last, weigh ``weights`` in turn and divide
    ``share`` times all sizes; a target stops at ``most`` times its source's size
    and the excess goes to the others by weight. In order of the size at which a
    source is full for its weight, the full ones come first, so two running sums
    find the common level of the rest.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    listed = totals.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")).cast("double").alias("w"),
    ).withColumns({"cap": F.lit(float(most)) * F.col("source_size")})
    every = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto = by_level.rowsBetween(Window.unboundedPreceding, 0)
    levelled = listed.withColumns(
        {
            "total": F.lit(float(share)) * F.sum("source_size").over(every),
            "caps": F.sum("cap").over(upto),
            "rest": F.sum("w").over(every) - F.sum("w").over(upto),
        }
    ).withColumn("full", F.col("caps") + F.col("cap") / F.col("w") * F.col("rest") <= F.col("total"))
    used = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)
    free = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(every)
    target = F.when(F.col("full"), F.col("cap")).otherwise(
        (F.col("total") - used) / F.when(free > 0, free) * F.col("w")
    )
    return levelled.select("source", "source_size", target.alias("target"))


def mix_plan(
    docs: DataFrame,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    rows_in_range: int = 4_000,
) -> DataFrame:
    """One row for all equal documents, with what the mix takes of them.

    Columns: ``source``, ``doc_id``, ``key``, ``size``, ``copies``, ``source_size``,
    ``target``, ``passes`` (full passes over the source) and ``left``: the words
    that the last pass has left when it comes to these documents, which may be
    negative.
    """
    sized = kept(
        docs.select(
            "source",
            "doc_id",
            word_count(F.col("text")).alias("size"),
            random_key(F.col("doc_id"), F.col("text")).alias("key"),
        ),
        "sizes",
    )
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows")
    )
    largest = totals.agg(F.max("rows")).first()[0] or 0
    bits = max(0, (largest // rows_in_range).bit_length())
    ranged = sized.withColumn("range", F.shiftright("key", KEY_BITS - bits))
    targets = source_targets(totals.select("source", "source_size"), weights, share, most)

    alike = ranged.groupBy("source", "range", "key", "doc_id", "size").agg(
        F.count("*").alias("copies")
    )
    words = F.col("size") * F.col("copies")
    earlier = Window.partitionBy("source").orderBy("range")
    starts = (
        ranged.groupBy("source", "range")
        .agg(F.sum("size").alias("words"))
        .withColumn("start", F.sum("words").over(earlier) - F.col("words"))
        .select(F.col("source").alias("s"), F.col("range").alias("r"), "start")
        .join(targets, F.col("s").eqNullSafe(F.col("source")))
        .drop("source")
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
    budget = F.floor("target")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    return (
        alike.withColumn("before", F.sum(words).over(inside) - words)
        .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
        .withColumn("passes", passes.cast("long"))
        .select(
            "source",
            "doc_id",
            "key",
            "size",
            "copies",
            "source_size",
            "target",
            "passes",
            (
                budget
                - F.col("passes") * F.col("source_size")
                - F.col("start")
                - F.col("before")
            ).alias("left"),
        )
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    rows_in_range: int = 4_000,
) -> DataFrame:
    """Per row of ``docs``: its size, its source's size and target, and words taken."""
    plan = mix_plan(docs, weights, share, most, rows_in_range)
    each = plan.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    rest = F.col("left") - (F.col("nth") - 1) * F.col("size")
    last = F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return each.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + last).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    rows_in_range: int = 4_000,
) -> DataFrame:
    """The documents of the mix, whole, each as often as a pass reaches it.

    A document at which a budget ends is taken whole, so a source exceeds its
    target by less than one document. Columns are those of ``docs``.
    """
    plan = mix_plan(docs, weights, share, most, rows_in_range).select(
        F.col("source").alias("_podium_source"),
        F.col("doc_id").alias("_podium_doc_id"),
        F.col("key").alias("_podium_key"),
        F.col("copies").alias("_podium_copies"),
        F.col("passes").alias("_podium_passes"),
        # Of these equal rows, so many are reached by the last pass.
        F.when(F.col("left") <= 0, 0)
        .when(F.col("size") == 0, F.col("copies"))
        .otherwise(F.least(F.ceil(F.col("left") / F.col("size")), F.col("copies")))
        .alias("_podium_reached"),
    )
    reached = plan.filter("_podium_passes + _podium_reached > 0")
    joined = docs.withColumn("_podium_k", random_key(F.col("doc_id"), F.col("text"))).join(
        reached,
        F.col("_podium_k").eqNullSafe(F.col("_podium_key"))
        & F.col("doc_id").eqNullSafe(F.col("_podium_doc_id"))
        & F.col("source").eqNullSafe(F.col("_podium_source")),
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    passes, some = F.col("_podium_passes"), F.col("_podium_reached")
    parted = (some > 0) & (some < F.col("_podium_copies"))
    whole = joined.filter(~parted).select(
        *columns, (passes + F.when(some > 0, 1).otherwise(0)).alias("_podium_times")
    )
    # At most one group of equal rows of each source is taken in part.
    same = Window.partitionBy("_podium_source", "_podium_key").orderBy("_podium_doc_id")
    part = (
        joined.filter(parted)
        .withColumn("_podium_nth", F.row_number().over(same))
        .select(
            *columns,
            (passes + F.when(F.col("_podium_nth") <= some, 1).otherwise(0)).alias(
                "_podium_times"
            ),
        )
    )
    times = F.sequence(F.lit(1), F.col("_podium_times").cast("int"))
    return (
        whole.unionByName(part)
        .filter("_podium_times > 0")
        .withColumn("_podium_times", F.explode(times))
        .drop("_podium_times")
    )
