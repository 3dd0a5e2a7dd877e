"""The operators applied to the test tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rfspark.llm import (
    bwt_dedup,
    exact_dedup,
    merge_dropout,
    packing,
    pii,
    pitman_yor,
    product_quantisation,
    ranked_search,
    sharding,
    simhash,
    string_kernel,
    warc,
    whitening,
)
from rfspark.llm.common import LOWER, UPPER, crc_bucket, table


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index = warc.build_index(warc.write(pages))
    asked = warc.keys_of(pages).distinct()
    records = warc.read(warc.look_up(asked, index))
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = sharding.shard(docs, 8, carry=[F.col("doc_id"), crc.alias("text_crc32")])
    return rows.select(
        "row.doc_id",
        "size",
        "row.text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_bucket(F.col("doc_id"), 7) == 2
    rows = pitman_yor.score(table(spark, sf_dir, "documents"), ~held_out)
    return rows.withColumnRenamed("id", "doc_id").withColumn("held_out", crc_bucket(F.col("doc_id"), 7) == 2)


def op4_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = string_kernel.fit(docs, labels.where(crc_bucket(F.col("doc_id"), 5) != 0))
    return string_kernel.scores(docs, machine).select(
        F.col("id").alias("doc_id"),
        (crc_bucket(F.col("id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return packing.pack(pieces)


def op6_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = product_quantisation.near_groups(table(spark, sf_dir, "embeddings"), cosine=0.93)
    return rows.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = pii.find(docs, pii.fit(docs))
    return rows.select(
        F.col("id").alias("doc_id"),
        *[f"n_{k}" for k in pii.KINDS],
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merge_dropout.round_trip(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), rate=0.1, seed=42)
    return rows.withColumnRenamed("id", "doc_id")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_groups(table(spark, sf_dir, "documents"), width=3, k=2, similarity=None)
    return rows.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.groups(table(spark, sf_dir, "documents"), digest_all=True)
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256")
    )


def op11_block_matrix_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32).withColumnRenamed("id", "vec_id")


def op12_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
    return rows.select(F.col("query").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op13_bwt_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bwt_dedup.remove(table(spark, sf_dir, "documents"), length=400, keep_text=False)
    return rows.withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_warc_capture_index": op1_warc_capture_index,
    "op2_histogram_sort": op2_histogram_sort,
    "op3_pitman_yor": op3_pitman_yor,
    "op4_string_kernel_toxicity": op4_string_kernel_toxicity,
    "op5_vector_packing": op5_vector_packing,
    "op6_product_quantisation": op6_product_quantisation,
    "op7_boosted_pii": op7_boosted_pii,
    "op8_merge_dropout": op8_merge_dropout,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_block_matrix_whitening": op11_block_matrix_whitening,
    "op12_block_max_search": op12_block_max_search,
    "op13_bwt_merge_dedup": op13_bwt_merge_dedup,
}

TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

ORACLE = {
    "op1_warc_capture_index": """
        with p as (select page_id, coalesce(html, '') as x from pages),
        q as (
            select page_id, strlen(x) as n, sha256(x) as d, min(page_id) over (partition by x) as first from p
        )
        select page_id, n as payload_bytes, d as payload_digest,
               case when n >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
               case when n >= 100 and page_id <> first then first end as refers_to
        from q
    """,
    "op10_exact_dedup": f"""
        with t as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as x from documents)
        select doc_id,
               max(doc_id) over (partition by x) as keep_id,
               count(*) over (partition by x) as group_size,
               doc_id = max(doc_id) over (partition by x) as kept,
               sha256(x) as text_sha256
        from t
    """,
    "op12_block_max_search": f"""
        with d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {TERMS}) as words
            from documents
        ),
        size as (select count(*) filter (len(words) > 0) as n_docs, sum(len(words))::bigint as n_terms from d),
        flat as (select doc_id, len(words) as n, unnest(words) as term from d),
        posting as (select doc_id, n, term, count(*) as tf from flat group by all),
        asked as (
            select distinct item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), {TERMS})) as term
            from benchmark
        ),
        weighed as (
            select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
            from posting, size group by term
        ),
        scored as (
            select item_id, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::bigint as score
            from asked join weighed using (term) join posting using (term), size
            group by item_id, doc_id
        ),
        ranked as (
            select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
            from scored where score > 0
        )
        select * from ranked where rank <= 50
    """,
}
