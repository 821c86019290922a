"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.alignment import align_tokenizers
from podium.llm.common import kept, remainder
from podium.llm.context_tree import score_texts
from podium.llm.language import fit_language_model, predict_language
from podium.llm.mixing import KEY_BITS, mix_sources
from podium.llm.nearest import nearest_neighbours
from podium.llm.negatives import mine_negatives
from podium.llm.ngram_join import jaccard_components
from podium.llm.packing import pack_documents
from podium.llm.pieces import decode_ids, encode_texts
from podium.llm.simhash import compare_edited
from podium.llm.token_counts import count_tokens
from podium.llm.toxicity import fit_toxicity, score_toxicity
from podium.llm.warc import read_segments, reassemble, write_archives
from podium.shared import working_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = fit_toxicity(docs, labels.filter(~held_out))
    return score_toxicity(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op2_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_dir(spark, "archives")
    write_archives(_table(spark, sf_dir, "pages"), path)
    whole = reassemble(read_segments(spark, path)).select(
        F.substring_index("uri", ":", -1).try_cast("long").alias("page_id"),
        "record_id",
        F.col("kind").alias("record_type"),
        F.col("digest").alias("payload_digest"),
        F.col("refers_to").alias("origin"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )
    records = kept(whole, "records")
    origins = (
        records.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("origin"))
        .agg(F.first("page_id").alias("refers_to"), F.first("bytes").alias("origin_bytes"))
    )
    return records.join(origins, "origin", "left").select(
        "page_id",
        F.coalesce("bytes", "origin_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = fit_language_model(docs.filter(~held_out))
    return predict_language(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), BYTE_BPE, 1024)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(_table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), width=3, percent=90)


def op7_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_texts(docs, remainder(F.col("doc_id"), 10) == 0)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), BYTE_BPE, 1024)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(_table(spark, sf_dir, "documents"), PIECES)
    return decode_ids(encoded, PIECES).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(_table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc_reassembly": op2_warc_reassembly,
    "op3_language_id": op3_language_id,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_simhash": op5_simhash,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_context_tree_weighting": op7_context_tree_weighting,
    "op8_token_counts": op8_token_counts,
    "op9_source_mixing": op9_source_mixing,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_piece_encoding": op11_piece_encoding,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

_WARC_SQL = """
with paged as (
    select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), named as (
    select page_id, strlen(html) as payload_bytes,
        min(page_id) over (partition by hex) as first_id,
        array_to_string(list_transform(range(32), lambda i: substr(
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            cast(((('0x' || substr(hex, cast(5 * (i // 4) + 1 as integer), 5))::bigint
                >> cast(15 - 5 * (i % 4) as integer)) & 31) + 1 as integer), 1)), '')
            as payload_digest
    from paged
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
    case when page_id = first_id then 'response' else 'revisit' end as record_type,
    case when page_id <> first_id then first_id end as refers_to
from named
"""

_MIXING_SQL = f"""
with sized as (
    select doc_id, source,
        cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint)
            as size,
        cast('0x' || substr(md5(concat_ws(' ', coalesce(doc_id::varchar, ''), text)), 1,
            {KEY_BITS // 4}) as bigint) as key
    from documents
), totals as (
    select source, cast(sum(size) as bigint) as source_size from sized group by source
), listed as (
    select source, source_size, 2.0::double * source_size as cap, [3.0, 1.0, 2.0][
        ((row_number() over (order by source collate "C" nulls last) - 1) % 3) + 1
    ]::double as w
    from totals
), levelled as (
    select *, 1.5::double * sum(source_size) over () as total,
        sum(cap) over upto as caps, sum(w) over () - sum(w) over upto as rest
    from listed
    window upto as (order by cap / w, source nulls last rows unbounded preceding)
), filled as (
    select *, caps + cap / w * rest <= total as is_full from levelled
), targets as (
    select source, source_size, case when is_full then cap else
        (total - sum(case when is_full then cap else 0 end) over ())
        / nullif(sum(case when is_full then 0 else w end) over (), 0) * w end as target
    from filled
), placed as (
    select doc_id, source, size, sum(size) over (
        partition by source order by key, doc_id, size rows unbounded preceding
    ) - size as start from sized
), cut as (
    select p.*, source_size, target, case when source_size > 0
        then cast(floor(target) as bigint) // source_size else 0 end as passes
    from placed p join targets t on p.source is not distinct from t.source
)
select doc_id, source, size, source_size, target, cast(passes * size + greatest(0, least(size,
    cast(floor(target) as bigint) - passes * source_size - start)) as bigint) as taken
from cut
"""

_NEAREST_SQL = """
with usable as (
    select vec_id, cast(embedding as double[]) as v from embeddings
    where vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored as (
    select q.vec_id as query_id, r.vec_id,
        list_dot_product(q.v, r.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(r.v, r.v)))
            as score
    from usable q join usable r on q.vec_id <> r.vec_id where q.vec_id % 50 = 0
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
    from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
"""

_NEGATIVES_SQL = """
with usable as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, r.vec_id, r.label = a.label as same,
        cast(list_dot_product(a.v, r.v) as bigint) as score
    from usable a join usable r on a.vec_id <> r.vec_id where a.vec_id % 50 = 0
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, cast(row_number() over nearest as integer) as rank,
    n.vec_id as negative_id, positive_score, n.score as negative_score
from positives join scored n using (anchor_id)
where not n.same and 50 * positive_score <= 100 * n.score and 100 * n.score <= 95 * positive_score
window nearest as (partition by anchor_id, positive_id order by n.score desc, n.vec_id)
qualify row_number() over nearest <= 3
"""

#: For the others SQL has no equal: tests hold them against brute force.
SQL: dict[str, str] = {
    "op2_warc_reassembly": _WARC_SQL,
    "op9_source_mixing": _MIXING_SQL,
    "op10_nearest_neighbours": _NEAREST_SQL,
    "op13_hard_negatives": _NEGATIVES_SQL,
}
