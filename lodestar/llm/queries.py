"""The operators' queries over the given tables, and SQL for those that have it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import (
    byte_bpe,
    dedup,
    fingerprint,
    line_dedup,
    packing,
    quality,
    secrets,
    spelling,
    suffix_tree,
    token_counts,
    token_links,
    topk,
    wrappers,
)
from lodestar.llm.common import read


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.link(read(spark, sf_dir, "documents"), width=2, percent=80)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(read(spark, sf_dir, "documents"), depth=None, support=2)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read(spark, sf_dir, "pages"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = packing.measured(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack_documents(docs, cluster_col="cluster", size_col="size")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(read(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(read(spark, sf_dir, "documents"), slip=97, min_chars=5, min_count=3, factor=2)


def op13_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_lm_scores": op4_lm_scores,
    "op5_main_text": op5_main_text,
    "op6_fingerprints": op6_fingerprints,
    "op7_secret_scan": op7_secret_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_top_k": op9_top_k,
    "op10_quality": op10_quality,
    "op11_line_dedup": op11_line_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_links": op13_token_links,
}

ORACLE_SQL = {
    "op2_near_duplicates": """
        with recursive words as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+') as w
            from documents
        ), shingles as (
            select doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w]
                else list_distinct(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) end) as s
            from words
        ), sizes as (
            select doc_id, count(s) as n from words left join shingles using (doc_id) group by doc_id
        ), pairs as (
            select a.doc_id as a, b.doc_id as b, count(*) as common
            from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all
        ), links as (
            select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * common >= 80 * (x.n + y.n - common)
        ), reached(doc_id, node) as (
            select doc_id, doc_id from documents
            union
            select r.doc_id, l.b from reached r join links l on l.a = r.node
        )
        select doc_id, n as n_shingles, min(node) as component_id, doc_id = min(node) as kept
        from reached join sizes using (doc_id) group by doc_id, n
    """,
    "op9_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
            where vec_id is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
        ), hits as (
            select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
            from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0
        )
        select query_id, rank, vec_id, score from (
            select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank from hits
        ) where rank <= 5
    """,
    "op11_line_dedup": """
        with lines as (
            select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
            from documents
        ), keyed as (
            select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from lines
        ), common as (
            select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10
        )
        select doc_id, count(*) as n_lines, count(c.key) as n_dropped,
            sha256(coalesce(string_agg(case when c.key is null then line end, chr(10) order by pos), '')) as kept_sha256
        from keyed left join common c using (key) group by doc_id
    """,
}
