"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm.bpe import decode_texts, encode_texts
from tiermill.llm.common import full_text
from tiermill.llm.embedding_dedup import similar_vectors
from tiermill.llm.exact_dedup import exact_copies
from tiermill.llm.filter_audit import filter_audit, text_failures
from tiermill.llm.kneser_ney import quality
from tiermill.llm.lexical_search import search
from tiermill.llm.licenses import license_notices
from tiermill.llm.maxent import text_scores
from tiermill.llm.mixing import mix_sources
from tiermill.llm.packing import pack_documents
from tiermill.llm.sharding import shard_rows
from tiermill.llm.simhash import near_copies
from tiermill.llm.substring_dedup import cut_repeats
from tiermill.sources.files import read_parquet

SHARDS = 40
VOCABULARY = corpus_pipeline.VOCABULARY


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.encode(full_text(), "UTF-8")
    digests = _documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(data) + 16).cast("bigint").alias("size"), F.crc32(data).alias("text_crc32")
    )
    return shard_rows(digests, SHARDS, keys=["doc_id"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), VOCABULARY)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_documents(spark, sf_dir), read_parquet(spark, f"{sf_dir}/labels.parquet"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(_documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(_documents(spark, sf_dir))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_scores(_documents(spark, sf_dir))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_texts(encode_texts(_documents(spark, sf_dir), VOCABULARY), VOCABULARY)
    return decoded.select(
        "doc_id",
        F.call_function("div", F.octet_length("ids"), F.lit(4)).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices(_documents(spark, sf_dir))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(read_parquet(spark, f"{sf_dir}/embeddings.parquet"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(_documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__n_removed").alias("n_removed"),
        F.col("__kept_sha256").alias("kept_sha256"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = text_failures(_documents(spark, sf_dir), read_parquet(spark, f"{sf_dir}/labels.parquet"))
    return filter_audit(failures.withColumnRenamed("source", "part"), "ABCDE", "part", ["good", "toxic"], "rows")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_documents(spark, sf_dir), read_parquet(spark, f"{sf_dir}/benchmark.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_packing": op2_packing,
        "op3_quality": op3_quality,
        "op4_simhash": op4_simhash,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_bpe": op7_bpe,
        "op8_license_scan": op8_license_scan,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_filter_audit": op11_filter_audit,
        "op12_mixing": op12_mixing,
        "op13_lexical_search": op13_lexical_search,
        "pipeline": corpus_pipeline.run,
    }


_WORDS = r"'[^\x20\x09-\x0D]+'"
_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB with the same results."""
    return {
        "op5_exact_dedup": """
            select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
                doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
            from documents window same as (partition by coalesce(text, ''))""",
        "op11_filter_audit": f"""
            with recursive orders(filter_order) as (
                select '' union all
                select filter_order || f from orders, unnest(['A', 'B', 'C', 'D', 'E']) as filters(f)
                where not contains(filter_order, f)),
            steps as (
                select filter_order, step, 1 << (ascii(filter_order[step]) - 65) as own,
                    coalesce(list_sum([1 << (ascii(f) - 65) for f in string_split(filter_order[:step - 1], '') if f <> '']), 0)::int
                        as earlier
                from orders, range(1, 6) as places(step) where length(filter_order) = 5),
            texts as (
                select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
                    regexp_extract_all(coalesce(text, ''), {_WORDS}) as words from documents),
            known as (
                select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
                from labels group by doc_id),
            judged as (
                select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
                    case when len(words) < 200 then 1 else 0 end
                    + case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end
                    + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 4 else 0 end
                    + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
                    + case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end as fails
                from texts left join known using (doc_id)),
            patterns as (
                select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
                from judged group by part, fails),
            counted as (
                select part, filter_order, step, own,
                    sum(case when fails & (earlier | own) = 0 then n else 0 end)::bigint as kept,
                    sum(case when fails & own > 0 and fails & earlier = 0 then n else 0 end)::bigint as removed,
                    sum(case when fails & own > 0 and fails & earlier > 0 then n else 0 end)::bigint as redundant,
                    sum(case when fails = own then n else 0 end)::bigint as unique_fails,
                    sum(case when fails & own > 0 and fails & earlier = 0 then good else 0 end)::bigint as good_lost,
                    sum(case when fails & own > 0 and fails & earlier = 0 then toxic else 0 end)::bigint as toxic_lost
                from patterns, steps group by all)
            select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
                (sum(removed) over (partition by part, own))::bigint as shapley
            from counted""",
        "op12_mixing": f"""
            with sized as (
                select doc_id, source, coalesce(len(regexp_extract_all(text, {_WORDS})), 0)::bigint as size,
                    md5(concat_ws(':', '0', doc_id, text))[:16] as place from documents),
            sources as (
                select source, sum(size)::bigint as source_size, 2 * sum(size)::bigint as cap,
                    row_number() over (order by encode(source) nulls last) - 1 as number
                from sized group by source),
            weighed as (select *, [5, 2, 1][number % 3 + 1] as weight from sources),
            levels as (
                select *, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over (by_cap
                    rows between unbounded preceding and 1 preceding), 0)::double)
                    / sum(weight) over (by_cap rows between current row and unbounded following) as level
                from weighed window by_cap as (order by cap::double / weight, number)),
            aims as (select source, source_size, least(cap::double, weight * max(level) over ()) as target from levels),
            wanted as (
                select *, floor(target + 0.5)::bigint // greatest(source_size, 1) as full_times,
                    floor(target + 0.5)::bigint % greatest(source_size, 1) as rest from aims)
            select doc_id, s.source, size, source_size, target, full_times * size + greatest(0, least(size, rest - coalesce(sum(size)
                over (partition by s.source order by place, doc_id, size rows between unbounded preceding and 1 preceding), 0)
                ))::bigint as taken
            from sized s join wanted w on s.source is not distinct from w.source""",
        "op13_lexical_search": f"""
            with documents_terms as (
                select number, doc_id, term, count(*) as tf from (
                    select number, doc_id, unnest(regexp_extract_all({_FOLDED}, {_TERMS})) as term
                    from (select *, row_number() over () as number from documents))
                group by all),
            lengths as (select number, sum(tf)::bigint as n from documents_terms group by number),
            totals as (select count(*)::bigint as docs, sum(n)::bigint as words from lengths),
            items as (
                select item_id, term, count(*) as repeats
                from (select item_id, unnest(regexp_extract_all({_FOLDED}, {_TERMS})) as term from benchmark) group by all),
            weights as (
                select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w
                from documents_terms, totals where term in (select term from items) group by term),
            scores as (
                select item_id, doc_id, number, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 *
                    (25 + (75 * n * docs) // words))))::bigint as score
                from items join weights using (term) join documents_terms using (term) join lengths using (number), totals
                group by all),
            ranked as (
                select item_id, doc_id, score,
                    row_number() over (partition by item_id order by score desc, doc_id) as rank
                from scores where score > 0)
            select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10""",
    }
