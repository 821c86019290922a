"""SimHash fingerprints of documents, and all pairs within a Hamming radius.

A text's terms are its runs of five words (the whole text, if it has fewer). Each
term is hashed to 128 bits, and for every bit the terms vote, each as often as it
occurs; the majorities are the fingerprint. Equal texts have equal fingerprints,
and the share of equal bits falls with the angle between the term counts.

Votes are counted four bits to a number: a 64-bit hash shifted by ``i`` and masked
leaves bits ``i``, ``i + 16``, ``i + 32`` and ``i + 48`` in lanes of 16 bits, so 16
sums count 64 bits. A lane holds 32,767 votes, the uppermost one by its sign; terms
are counted in blocks of fewer and the blocks added up.

Null and empty texts have one empty term. Tied votes give 0. A null id ranks
below all others, where the least 64-bit number stands for it. Repeated rows get
equal results; of rows with one id and different texts, the one of least SHA-256
is what comes before a neighbour. All of it is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import kept

SHINGLE = 5
BLOCK = 30_000
LANES = 0x0001_0001_0001_0001
#: Seeds of the two halves of a fingerprint.
HALVES = (0, 1)
LOWEST = -(1 << 63)


def _bits(parts: list[Column]) -> Column:
    """Or of columns, as a balanced tree."""
    while len(parts) > 1:
        parts = [reduce(Column.bitwiseOR, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def fingerprints(texts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys`` of each row and, for each of ``columns``, its ``<column>_high`` and ``_low``.

    ``keys`` tell rows apart. If ``texts`` is partitioned by some of them, nothing is
    shuffled: votes are counted where the text is.
    """
    texts_of = F.array(
        *(
            F.struct(F.lit(i).alias("which"), F.coalesce(F.col(c), F.lit("")).alias("text"))
            for i, c in enumerate(columns)
        )
    )
    words = F.split(F.trim(F.regexp_replace("t.text", r"[\x20\x09-\x0D]+", " ")), " ")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - SHINGLE, F.lit(0)))
    terms = (
        texts.select(*keys, F.explode(texts_of).alias("t"))
        .select(*keys, "t.which", words.alias("w"))
        .select(*keys, "which", "w", F.explode(starts).alias("i"))
    )
    term = [F.get("w", F.col("i") + k) for k in range(SHINGLE)]
    votes = [
        F.sum(F.shiftrightunsigned(f"h{seed}", i).bitwiseAND(F.lit(LANES))).alias(f"v{seed}_{i}")
        for seed in HALVES
        for i in range(16)
    ]
    blocks = (
        terms.select(
            *keys,
            "which",
            (F.col("i") / BLOCK).cast("int").alias("block"),
            *(F.xxhash64(F.lit(seed), *term).alias(f"h{seed}") for seed in HALVES),
        )
        .groupBy(*keys, "which", "block")
        .agg(F.count("*").alias("n"), *votes)
    )
    singles = [
        F.sum(F.shiftrightunsigned(f"v{seed}_{i}", 16 * k).bitwiseAND(F.lit(0xFFFF))).alias(
            f"b{seed}_{i + 16 * k}"
        )
        for seed in HALVES
        for i in range(16)
        for k in range(4)
    ]
    counted = blocks.groupBy(*keys, "which").agg(F.sum("n").alias("n"), *singles)

    def half(seed: int) -> Column:
        bit = [1 << j if j < 63 else LOWEST for j in range(64)]
        return _bits(
            [
                F.when(F.col(f"b{seed}_{j}") * 2 > F.col("n"), F.lit(bit[j])).otherwise(
                    F.lit(0).cast("long")
                )
                for j in range(64)
            ]
        )

    halves = counted.select(*keys, "which", half(0).alias("high"), half(1).alias("low"))
    return halves.groupBy(*keys).agg(
        *(
            F.max(F.when(F.col("which") == i, F.col(part))).alias(f"{c}_{part}")
            for i, c in enumerate(columns)
            for part in ("high", "low")
        )
    )


def fingerprint_text(high: str, low: str) -> Column:
    """A fingerprint as 32 hexadecimal digits."""
    return F.concat(*(F.lpad(F.lower(F.hex(h)), 16, "0") for h in (high, low)))


def distance(a_high: str, a_low: str, b_high: str, b_low: str) -> Column:
    """Hamming distance of two fingerprints."""
    return F.bit_count(F.col(a_high).bitwiseXOR(F.col(b_high))) + F.bit_count(
        F.col(a_low).bitwiseXOR(F.col(b_low))
    )


def near_fingerprints(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs of different fingerprints at most ``radius`` bits apart.

    ``prints`` has ``high`` and ``low``; the result has ``a_high``, ``a_low``,
    ``b_high``, ``b_low`` and ``bits``, each pair once. The 128 bits are cut into
    ``radius + 1`` blocks (``radius`` is odd), of which two such fingerprints share
    one: there is a table for each block, keyed by it, and a pair is taken from the
    first table that has both.
    """
    if radius % 2 == 0 or radius not in (1, 3, 7, 15):
        raise ValueError("the radius is 1, 3, 7 or 15")
    width = 128 // (radius + 1)
    mask = (1 << width) - 1 if width < 64 else -1

    def block(of: str, i: int) -> Column:
        at = i * width
        part = F.col(f"{of}high" if at < 64 else f"{of}low")
        return F.shiftrightunsigned(part, at % 64).bitwiseAND(F.lit(mask).cast("long"))

    n = radius + 1
    tables = (
        prints.select("high", "low")
        .distinct()
        .select(
            "high",
            "low",
            F.posexplode(F.array(*(block("", i) for i in range(n)))).alias("block", "value"),
        )
    )
    sides = [
        tables.select(
            "block", "value", F.col("high").alias(f"{s}_high"), F.col("low").alias(f"{s}_low")
        )
        for s in "ab"
    ]
    earlier = reduce(
        Column.__or__,
        [
            (F.col("block") > i) & (block("a_", i) == block("b_", i))
            for i in range(n - 1)
        ],
    )
    ordered = (F.col("a_high") < F.col("b_high")) | (
        (F.col("a_high") == F.col("b_high")) & (F.col("a_low") < F.col("b_low"))
    )
    bits = distance("a_high", "a_low", "b_high", "b_low")
    return (
        sides[0]
        .join(sides[1], ["block", "value"])
        .filter(ordered & (bits <= radius) & ~earlier)
        .select("a_high", "a_low", "b_high", "b_low", bits.alias("bits"))
    )


def next_ids(ids: DataFrame) -> DataFrame:
    """``id``, ``most`` and ``next_id``: the next lower id, or the highest for the lowest.

    ``ids`` has distinct ``id``s. They are sorted in ranges, written, and each range
    looks one id beyond its end.
    """
    ranged = kept(
        ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "ranges"
    )
    inside = Window.partitionBy("part").orderBy("id")
    ends = ranged.groupBy("part").agg(F.max("id").alias("top"))
    # One row for each range.
    in_order = Window.orderBy("part")
    ends = ends.select(
        F.col("part").alias("p"),
        F.coalesce(
            F.lag("top").over(in_order), F.max("top").over(Window.partitionBy())
        ).alias("below"),
    )
    return (
        ranged.withColumn("lower", F.lag("id").over(inside))
        .join(ends, F.col("part") == F.col("p"))
        .select("id", "most", F.coalesce("lower", "below").alias("next_id"))
    )


def compare_edited(docs: DataFrame, radius: int = 3) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    In the edited text the last third of the characters (rounded down) gives way to
    as many from the beginning of the next document in descending order of id;
    after the last comes the first. ``n_near`` counts the other fingerprints of the
    table within ``radius`` bits. Beside rows without id the least id there is counts as
    none.
    """
    nameless = docs.agg(F.count_if(F.col("doc_id").isNull())).first()[0]
    base = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST).cast("long")).alias("id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    length = F.char_length("text")
    ring = next_ids(
        base.groupBy("id").agg(F.max(F.floor(length / 3).cast("int")).alias("most"))
    )
    begins = (
        base.join(ring.select(F.col("id").alias("reader"), "most", "next_id"),
                  F.col("id") == F.col("next_id"))
        .groupBy("reader", "next_id")
        .agg(
            F.min(
                F.struct(
                    F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
                    F.substring(F.col("text"), F.lit(1), F.col("most")).alias("begin"),
                )
            ).alias("b")
        )
        .select("reader", "next_id", "b.begin")
    )
    third = F.floor(length / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), length - third),
        F.substring(F.col("begin"), F.lit(1), third),
    )
    rows = (
        base.join(begins, F.col("id") == F.col("reader"))
        .select("id", "next_id", "text", edited.alias("edited"), length.alias("n_chars"))
        .withColumns(
            {
                "row": F.monotonically_increasing_id(),
                "sha": F.unhex(F.sha2(F.col("text").cast("binary"), 256)),
                "edited_sha": F.unhex(F.sha2(F.col("edited").cast("binary"), 256)),
            }
        )
    )
    keys = ["id", "row", "next_id", "n_chars", "sha", "edited_sha"]
    prints = kept(fingerprints(rows, keys, ["text", "edited"]), "prints")

    own = prints.groupBy("id").agg(
        F.min(F.struct("sha", "text_high", "text_low")).alias("p")
    )
    following = own.select(
        F.col("id").alias("next"),
        F.col("p.text_high").alias("next_high"),
        F.col("p.text_low").alias("next_low"),
    )
    pairs = near_fingerprints(
        prints.select(F.col("text_high").alias("high"), F.col("text_low").alias("low")), radius
    )
    both = pairs.select(F.col("a_high").alias("h"), F.col("a_low").alias("l")).unionAll(
        pairs.select("b_high", "b_low")
    )
    near = both.groupBy("h", "l").agg(F.count("*").alias("n_near"))
    return (
        prints.join(following, F.col("next_id") == F.col("next"))
        .join(
            near, (F.col("text_high") == F.col("h")) & (F.col("text_low") == F.col("l")), "left"
        )
        .select(
            F.when(F.lit(not nameless) | (F.col("id") != LOWEST), F.col("id")).alias("doc_id"),
            F.col("n_chars").cast("long").alias("n_chars"),
            F.lower(F.hex("edited_sha")).alias("edited_sha256"),
            fingerprint_text("text_high", "text_low").alias("fingerprint"),
            fingerprint_text("edited_high", "edited_low").alias("edited_fingerprint"),
            (
                1 - distance("text_high", "text_low", "edited_high", "edited_low") / 128
            ).alias("near_edited"),
            (1 - distance("text_high", "text_low", "next_high", "next_low") / 128).alias(
                "near_next"
            ),
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
        )
    )
